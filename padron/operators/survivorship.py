"""Choose one value per entity. Every rule is a min/max/sum, so it combines before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions.text import leading_segment


def by_length(c: Column) -> Column:
    """Orders longest first, then alphabetically, under ``min``."""
    return F.struct((-F.length(c)).alias("len"), c.alias("value"))


def ranked(weight: Column, c: Column) -> Column:
    """Orders heaviest, then longest, then alphabetically first, under ``min``; null values drop out."""
    return F.when(c.isNotNull(), F.struct((-weight).alias("w"), (-F.length(c)).alias("len"), c.alias("value")))


def mode_value(
    df: DataFrame, keys: Sequence[str], value: str, weight: str | None = None, skip_empty: bool = False
) -> DataFrame:
    """Most frequent value per key; ties go to the longest, then the alphabetically first."""
    v = F.col(value)
    if skip_empty:
        df = df.withColumn(value, F.when(v != "", v))
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.groupBy(*keys, value).agg(n.alias("_w"))
    return counted.groupBy(*keys).agg(F.min(ranked(F.col("_w"), v))["value"].alias(value))


def first_seen_mode(df: DataFrame, keys: Sequence[str], value: str, order: Column, weight: str | None = None) -> DataFrame:
    """Most frequent value per key and its share; ties go to the one seen first."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.groupBy(*keys, value).agg(n.alias("_n"), F.min(order).alias("_first"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col("_first").alias("first"), F.col(value).alias("value")))
    return (
        counted.groupBy(*keys)
        .agg(best.alias("_best"), F.sum("_n").alias("_total"))
        .select(*keys, F.col("_best.value").alias(value), (-F.col("_best.n") / F.col("_total")).alias("share"))
    )


def value_frequency(df: DataFrame, value: str) -> DataFrame:
    return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("freq"))


def weighted_mode(df: DataFrame, keys: Sequence[str], value: str, order: Column) -> DataFrame:
    """Value with the best ratio of its share inside the entity to its share among all uses.

    Score = local share / (global count / sum of the global counts of the entity's values).
    """
    local = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"), F.min(order).alias("_first"))
    overall = df.groupBy(value).agg(F.count(F.lit(1)).alias("_all"))
    both = local.join(overall, value)
    best = F.min(
        F.struct(
            (-(F.col("_n") / F.col("_all"))).alias("r"),
            F.col("_first").alias("first"),
            F.col(value).alias("value"),
            F.col("_n").alias("n"),
            F.col("_all").alias("all"),
        )
    )
    score = (F.col("_b.n") / F.col("_t")) / (F.col("_b.all") / F.col("_s"))
    return (
        both.groupBy(*keys)
        .agg(best.alias("_b"), F.sum("_n").alias("_t"), F.sum("_all").alias("_s"))
        .select(*keys, F.col("_b.value").alias(value), score.alias("score"))
    )


def flag_consensus(c: Column) -> Column:
    """Aggregate: true only when every value is true; null counts as false."""
    return F.bool_and(F.coalesce(c, F.lit(False)))


def flag_consensus_list(c: Column) -> Column:
    """The same over one array; an empty array gives false."""
    return (F.size(c) > 0) & F.forall(c, lambda x: F.coalesce(x, F.lit(False)))


def unanimous(c: Column) -> Column:
    """Aggregate: the only non-null value, or null when there are several."""
    return F.when(F.min(c) == F.max(c), F.max(c))


def unanimous_code(c: Column) -> Column:
    """Unanimous value up to its first dot; the vote is taken on the untrimmed values."""
    return leading_segment(unanimous(c), ".")
