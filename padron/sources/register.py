"""Scan of an outside company register: named columns out, unreadable rows set aside."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.sources.staging import stage

#: What a register has to tell of each company; a file's own column names can be mapped to these.
REGISTER_COLUMNS = ("ID_EMPRESA", "NIF", "NOMBRE", "UTE")
_BROKEN = "_broken_line"

MALFORMED = "line does not fit the header"
NO_ID = "ID is missing"
BAD_ID = "ID is no whole number"


@dataclass(frozen=True)
class RegisterScan:
    """``rows``: REGISTER_COLUMNS. ``rejected``: reason, record, file of every other row of the files."""

    rows: DataFrame
    rejected: DataFrame

    def reasons(self) -> DataFrame:
        """``reason, n``: how many rows were set aside for what."""
        return self.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _read(spark: SparkSession, path: str, kind: str, separator: str) -> DataFrame:
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind != "csv":
        raise ValueError(f"a register is csv or parquet, not {kind}")
    reader = spark.read.option("header", True).option("sep", separator)
    # every column stays text, so that one odd cell does not turn its whole line unreadable
    header = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, _BROKEN]])
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _BROKEN)
    # a reader that leaves out columns does not see which lines have too many or too few cells
    return reader.option("columnPruning", False).option("enforceSchema", False).schema(schema).csv(path)


def scan_register(
    spark: SparkSession, path: str, kind: str = "csv", names: Mapping[str, str] | None = None, separator: str = ";"
) -> RegisterScan:
    """Read a register from CSV (with a header) or Parquet files.

    ``names`` maps a file's column names to REGISTER_COLUMNS; other columns are left out.
    A file without one of the columns is an error, told before any row is read. A line
    with more or fewer cells than the header, an empty ID and an ID that is no whole
    number put their row aside with the reason; empty cells elsewhere are missing values.
    """
    read = _read(spark, path, kind, separator)
    names = dict(names or {c: c for c in REGISTER_COLUMNS})
    absent = sorted(set(REGISTER_COLUMNS) - {own for file, own in names.items() if file in read.columns})
    if absent:
        raise ValueError(f"{path} has no column for {', '.join(absent)}; it has {', '.join(c for c in read.columns if c != _BROKEN)}")
    cells = {own: F.col(f"`{file}`").cast("string") for file, own in names.items()}
    broken = F.col(_BROKEN) if _BROKEN in read.columns else F.lit(None).cast("string")
    whole = F.to_json(F.struct(*[cells[c].alias(c) for c in REGISTER_COLUMNS]))
    # read once for both outcomes
    held = stage(
        read.select(
            *[cells[c].alias(c) for c in REGISTER_COLUMNS], broken.alias("_broken"), F.coalesce(broken, whole).alias("_record"), F.col("_metadata.file_path").alias("_file")
        ),
        "register-scan",
    )
    number = F.expr("try_cast(trim(ID_EMPRESA) AS bigint)")
    reason = (
        F.when(F.col("_broken").isNotNull(), MALFORMED)
        .when(F.trim(F.coalesce("ID_EMPRESA", F.lit(""))) == "", NO_ID)
        .when(number.isNull(), BAD_ID)
    )
    judged = held.withColumn("_reason", reason)
    rows = judged.filter("_reason IS NULL").select(number.alias("ID_EMPRESA"), *REGISTER_COLUMNS[1:])
    rejected = judged.filter("_reason IS NOT NULL").select(F.col("_reason").alias("reason"), F.col("_record").alias("record"), F.col("_file").alias("file"))
    return RegisterScan(rows, rejected)
