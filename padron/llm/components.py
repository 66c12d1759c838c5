"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.sources.staging import stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("low", "high"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links(a, b)`` that is not its component's smallest.

    Minima combine before the shuffle and the joins back are plain, so a node with very
    many links is split by adaptive skew joins. Every round is written to the shared
    folder. Loops and null ends are ignored; an empty table gives no rows.
    """
    edges = stage(
        links.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
        .distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).union(edges.select("high", "low"))
        nearest = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low"))
        large = both.filter("v > u").join(nearest, "u").select("low", F.col("v").alias("high")).distinct()
        smallest = large.groupBy("high").agg(F.min("low").alias("least"))
        small = (
            large.join(smallest, "high")
            .filter("low <> least")
            .select(F.col("least").alias("low"), F.col("low").alias("high"))
            .union(smallest.select(F.col("least").alias("low"), "high"))
            .distinct()
        )
        edges = stage(small, "edges")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component"))
