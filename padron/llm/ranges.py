"""Number the rows of a table in a total order without gathering them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.sources.staging import stage

_LOCAL_BITS = 33  # of monotonically_increasing_id: the row's number within its partition


def in_order(rows: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``rows`` range-partitioned and sorted by ``keys``, written, with ``_part`` and ``_at``.

    Ranges follow each other as ``_part`` grows, and ``_at`` counts the rows of a range
    from 0. The keys have to be unique together, so that every range can be cut anywhere.
    """
    sorted_rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    held = stage(sorted_rows.withColumn("_mono", F.monotonically_increasing_id()), label)
    return held.select(
        "*",
        F.shiftright("_mono", _LOCAL_BITS).alias("_part"),
        F.col("_mono").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_at"),
    ).drop("_mono")
