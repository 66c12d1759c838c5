"""From list-valued tenders to one cleaned row per (tender, winning company)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.functions.cells import bind, flag_from_text, pad
from padron.functions.tax_id import normalise_id, valid_or_null
from padron.functions.text import clean_name, name_key, squash_space, strip_embedded_id
from padron.sources.staging import stage


def filter_keyed(df: DataFrame, keys: Sequence[str] = ("ID", "Name")) -> DataFrame:
    """Tenders whose first ID and first name are known."""
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.get(F.col(key), 0).isNotNull()
    return df.filter(cond)


def _known_size(c: Column) -> Column:
    return bind(c, lambda a: F.when(F.coalesce(F.get(a, 0), F.lit("")) != "", F.size(a)))


def filter_aligned(df: DataFrame, lists: Sequence[str]) -> DataFrame:
    """Tenders whose known lists all have the same length."""
    sizes = F.array_compact(F.array(*[_known_size(F.col(c)) for c in lists]))
    return df.filter(F.size(F.array_distinct(sizes)) == 1)


def pad_lists(df: DataFrame, lists: Sequence[str], like: str = "ID") -> DataFrame:
    n = F.size(like)
    return df.withColumns({c: pad(F.col(c), n) for c in lists})


def explode_lists(df: DataFrame, lists: Sequence[str]) -> DataFrame:
    """One row per position of parallel lists; ``pos`` keeps the position."""
    rest = [c for c in df.columns if c not in lists]
    zipped = df.select(*rest, F.posexplode(F.arrays_zip(*[F.col(c) for c in lists])).alias("pos", "_item"))
    return zipped.select(*rest, "pos", *[F.col("_item")[c].alias(c) for c in lists])


def tender_mentions(tenders: DataFrame, party: Sequence[str], strict: bool = False) -> DataFrame:
    """Tender lists -> mentions.

    A tender has one ``id_tender``, repeated for each of its winners. ``strict`` treats
    it as one more list to align, which keeps only tenders with a single winner.
    """
    kept = filter_keyed(tenders)
    lists = list(party)
    if strict:
        kept = pad_lists(filter_aligned(kept, ["id_tender", *lists]), ["id_tender", *lists])
        return explode_lists(kept, ["id_tender", *lists])
    kept = filter_aligned(kept, lists).withColumn("id_tender", F.get("id_tender", 0))
    return explode_lists(pad_lists(kept, lists), lists)


def decode_flag(df: DataFrame, column: str = "SMEAwardedIndicator") -> DataFrame:
    return df.withColumn(column, flag_from_text(F.col(column)))


def squash_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in keep]
    return df.withColumns({c: squash_space(F.col(c)) for c in text})


def clean_mentions(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Validate ``ID``, standardise ``Name``, add ``Name_proc`` (no legal form) and ``Name_norm`` (key).

    Row by row, so it holds on any partitioning and on a stream. ``keep`` names text
    columns to leave as they are.
    """
    return (
        squash_columns(df, keep)
        .withColumn("ID", normalise_id(F.col("ID")))
        .withColumn("ID", valid_or_null(F.col("ID")))
        .withColumn("Name", strip_embedded_id(F.col("Name"), F.col("ID")))
        .withColumn("Name", clean_name(F.col("Name")))
        .withColumn("Name_proc", clean_name(F.col("Name"), remove_type=True))
        .withColumn("Name_norm", name_key(F.col("Name_proc")))
    )


def clean_mentions_once(df: DataFrame) -> DataFrame:
    """``clean_mentions`` worked out once per distinct (ID, Name) and joined back.

    Some sixty patterns run over each name, so this pays where names repeat. An empty
    ID or name cleans to null like a missing one, which lets both share a key.
    """
    raw = {"raw_id": F.coalesce("ID", F.lit("")), "raw_name": F.coalesce("Name", F.lit(""))}
    keyed = df.withColumns(raw)
    pairs = keyed.select(*raw).distinct()
    named = pairs.withColumns({"ID": F.col("raw_id"), "Name": F.col("raw_name")})
    cleaned = stage(clean_mentions(named, keep=list(raw)), "cleaned")
    rest = squash_columns(keyed.drop("ID", "Name"), keep=list(raw))
    return rest.join(cleaned, list(raw)).drop(*raw)
