"""Resolve conflicting (ID, name) pairs into one golden record per ID.

Three aggregates, no window and no join: grouping by ID settles IDs seen under
several names; the IDs left over carry exactly one name, so grouping those by name
settles names seen under several IDs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.operators.survivorship import ranked

KEYS = ["ID", "Name_norm"]


def mention_groups(mentions: DataFrame, order: str = "ord", weight: str | None = None) -> DataFrame:
    """One row per (ID, Name_norm) with its mention count and first ordinal; null keys drop out."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    return (
        mentions.filter(F.col("ID").isNotNull() & F.col("Name_norm").isNotNull())
        .groupBy(*KEYS)
        .agg(n.alias("count"), F.min(order).alias("first"))
    )


def rejected_mentions(mentions: DataFrame) -> DataFrame:
    """Mentions the grouping leaves out: no valid ID, or no name left after cleaning."""
    return mentions.filter(F.col("ID").isNull() | F.col("Name_norm").isNull())


def mention_items(mentions: DataFrame, column: str, order: str = "ord") -> DataFrame:
    """All values of a column per (ID, Name_norm), one row each with its input position."""
    kept = mentions.filter(F.col("ID").isNotNull() & F.col("Name_norm").isNotNull())
    return kept.select(*KEYS, order, column)


def regroup_items(items: DataFrame, keys: list[str], column: str, order: list[str]) -> DataFrame:
    """Items under coarser keys, one row each: the list of a key is its rows sorted by ``order``."""
    return items.select(*keys, *[c for c in order if c not in keys], column)


def _collapse(groups: DataFrame, repeated: str, chosen: str) -> DataFrame:
    """``first`` is carried where the groups have it."""
    return groups.groupBy(repeated).agg(
        F.count(F.lit(1)).alias("n_groups"),
        F.min(ranked(F.col("count"), F.col(chosen)))["value"].alias(chosen),
        F.sum("count").alias("count"),
        *[F.min(c).alias(c) for c in groups.columns if c == "first"],
    )


def unify_repeated(groups: DataFrame, repeated: str, chosen: str) -> DataFrame:
    """Collapse groups sharing ``repeated``; ``chosen`` becomes its count-weighted mode."""
    return _collapse(groups, repeated, chosen).filter("n_groups > 1")


def flag_repeated(groups: DataFrame) -> DataFrame:
    """Adds whether the ID, and the name, occur in more than one group."""
    out = groups
    for key, flag in (("ID", "id_repeated"), ("Name_norm", "name_repeated")):
        counts = groups.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        flags = counts.select(key, (F.col("_n") > 1).alias(flag))
        out = out.join(flags, key)
    return out


def unique_pairs(groups: DataFrame) -> DataFrame:
    """Groups whose ID has one name and whose name has one ID, in all the data."""
    one_name = _collapse(groups, "ID", "Name_norm").filter("n_groups = 1").drop("n_groups")
    one_id = _collapse(groups, "Name_norm", "ID").filter("n_groups = 1").select(*KEYS)
    return one_name.join(one_id, KEYS, "left_semi").select(*KEYS, "count", "first")


def id_summary(groups: DataFrame) -> DataFrame:
    """One row per ID: number of names, winning name, mentions, first ordinal."""
    return _collapse(groups, "ID", "Name_norm")


def golden_records(ids: DataFrame) -> DataFrame:
    """Golden ``ID, Name_norm, count, n_groups, settled`` from ``id_summary``."""
    by_id = ids.filter("n_groups > 1").withColumn("settled", F.lit("id"))
    by_name = _collapse(ids.filter("n_groups = 1").drop("n_groups"), "Name_norm", "ID").withColumn(
        "settled", F.when(F.col("n_groups") > 1, F.lit("name")).otherwise(F.lit("alone"))
    )
    columns = ["ID", "Name_norm", "count", "n_groups", "settled", "first"]
    return by_id.select(*columns).unionByName(by_name.select(*columns))


def replaced_ids(ids: DataFrame) -> DataFrame:
    """``ID -> golden_id`` for IDs absorbed by another one; every other ID is its own golden ID."""
    single = ids.filter("n_groups = 1").select(*KEYS, "count")
    by_name = _collapse(single, "Name_norm", "ID").filter("n_groups > 1")
    winners = by_name.select("Name_norm", F.col("ID").alias("golden_id"))
    matched = single.select(*KEYS).join(winners, "Name_norm")
    return matched.filter("ID <> golden_id").select("ID", "golden_id")


def attach_golden_id(df: DataFrame, replaced: DataFrame) -> DataFrame:
    joined = df.join(replaced, "ID", "left")
    return joined.withColumn("golden_id", F.coalesce("golden_id", "ID"))


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in ``order`` (which must be unique per key)."""
    rest = [c for c in df.columns if c not in (key, order)]
    row = F.min(F.struct(F.col(order).alias(order), *[F.col(c) for c in rest]))
    return df.groupBy(key).agg(row.alias("_row")).select(key, *[F.col(f"_row.{c}") for c in (order, *rest)])
