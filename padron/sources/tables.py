"""Readers for tender tables, lookups and word lists; sinks for results."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.functions.cells import list_cell
from padron.frames import union_all

PARTY_MARKS = ("WinningParty", "SMEAwardedIndicator")
TENDER_ID = "id"


def union_sources(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Union of several tables by name; a column one of them lacks is null there."""
    return union_all([df.withColumn("source", F.lit(name)) for name, df in frames.items()])


def read_sources(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    return union_sources({name: spark.read.parquet(path) for name, path in paths.items()})


def leaf_paths(schema: T.StructType, above: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    """Path of every non-struct field."""
    found: list[tuple[str, ...]] = []
    for field in schema.fields:
        here = (*above, field.name)
        found += leaf_paths(field.dataType, here) if isinstance(field.dataType, T.StructType) else [here]
    return found


def _at(path: Iterable[str]) -> Column:
    return F.col(".".join(f"`{part}`" for part in path))


def flatten_columns(df: DataFrame) -> DataFrame:
    """Nested columns -> flat columns named by their dotted path (empty levels left out)."""
    return df.select(*[_at(p).alias(".".join(part for part in p if part)) for p in leaf_paths(df.schema)])


def select_columns(
    df: DataFrame, keep: Callable[[str], bool], rename: Mapping[str, str] | None = None
) -> DataFrame:
    """Columns whose flat name passes ``keep``, named by ``rename`` or else by their last segment."""
    chosen = [c for c in df.columns if keep(c)]
    names = [(rename or {}).get(c, c.split(".")[-1]) for c in chosen]
    twice = [name for name, n in Counter(name.lower() for name in names).items() if n > 1]
    if twice:
        raise ValueError(f"several columns would be called {twice}; rename them")
    return df.select(*[F.col(f"`{c}`").alias(name) for c, name in zip(chosen, names)])


def is_party_column(name: str) -> bool:
    return name == TENDER_ID or any(mark in name for mark in PARTY_MARKS)


def composite_key(parts: Iterable[Column], separator: str = "/") -> Column:
    """Key text of several levels; a missing level is written as "nan" so positions stay fixed."""
    return F.concat_ws(separator, *[F.coalesce(p.cast("string"), F.lit("nan")) for p in parts])


def tender_lists(df: DataFrame, levels: Iterable[str]) -> DataFrame:
    """Raw tender table -> ``identifier``, ``id_tender`` and one string list per party field."""
    keyed = df.withColumn("identifier", composite_key([F.col(c) for c in levels]))
    flat = flatten_columns(keyed)
    party = select_columns(flat, lambda c: c == "identifier" or is_party_column(c), {TENDER_ID: "id_tender"})
    lists = []
    for field in party.drop("identifier").schema.fields:
        is_array = isinstance(field.dataType, T.ArrayType)
        cell = F.col(field.name) if is_array else F.col(field.name).cast("string")
        lists.append(list_cell(cell, is_array, lower=field.name != "id_tender").alias(field.name))
    # generated columns: a filter on them is not pushed below, where it would parse every cell again
    return party.select("identifier", F.inline(F.array(F.struct(*lists))))


def read_lookup(spark: SparkSession, path: str, columns: Iterable[str], separator: str = ";") -> DataFrame:
    """Delimited lookup with a header; every column stays text, so codes keep their zeros."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.option("sep", separator).option("header", True).schema(schema).csv(path)


def read_words(spark: SparkSession, path: str, column: str = "term") -> DataFrame:
    """One term per line, white space at its end removed."""
    return spark.read.text(path).select(F.regexp_replace("value", r"(?U)\s+$", "").alias(column))


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_terms(terms: DataFrame, path: str, column: str = "term") -> None:
    """Sorted terms, one per line: files in name order continue each other."""
    terms.select(F.col(column).alias("value")).orderBy("value").write.mode("overwrite").text(path)
