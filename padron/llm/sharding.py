"""Shards by a consistent-hash ring with virtual nodes and bounded loads, law ``rows``.

Every shard has NODES virtual nodes on a ring of CELLS cells; a row's cell is a hash of
its doc_id, and the first node at or after the cell is its own shard. No shard takes more
than its share of all rows (shares differ by one at most). Rows that find their own shard
full continue clockwise to the next node whose shard has room; the shares add up to the
number of rows, so everyone finds room and every shard ends exactly full.

Which rows overflow is settled from counts for each arc between two nodes, a table of
fixed size. Rows are numbered within their arc by range partitions, so neither a shard
nor an arc nor a repeated doc_id is ever gathered in one task.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.ranges import in_order
from padron.sources.staging import stage

SHARDS = 24
NODES = 256
CELLS = 1 << 16
LAW = "rows"


def ring(shards: int, nodes: int = NODES) -> list[tuple[int, int]]:
    """(cell, shard) of the virtual nodes in clockwise order. A cell that several nodes hit
    keeps the first shard's, so more shards never move a node."""
    held: dict[int, int] = {}
    for shard in range(shards):
        for k in range(nodes):
            cell = int.from_bytes(hashlib.sha256(f"{shard}:{k}".encode()).digest()[:8], "big") % CELLS
            held.setdefault(cell, shard)
    return sorted(held.items())


def shares(rows: int, shards: int) -> list[int]:
    """Rows of each shard, at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def pieces(counts: Sequence[int], owners: Sequence[int], room: Sequence[int]) -> list[list[tuple[int, int]]]:
    """For each arc the (shard, rows) its rows go to, in order.

    Own rows come first; then the overflow of each arc, in clockwise order, takes the
    room left at the nodes that follow. ``room`` adds up to at least all counts.
    """
    room = list(room)
    out, rest = [], []
    for n, own in zip(counts, owners, strict=True):
        taken = min(n, room[own])
        room[own] -= taken
        out.append([(own, taken)] if taken else [])
        rest.append(n - taken)
    for arc, left in enumerate(rest):
        node = arc
        while left:
            node = (node + 1) % len(owners)
            taken = min(left, room[owners[node]])
            if taken:
                room[owners[node]] -= taken
                left -= taken
                out[arc].append((owners[node], taken))
    return out


def _segments(runs: Sequence[tuple[int, int, int, int]], plan: Sequence[Sequence[tuple[int, int]]], shards: int) -> list[dict]:
    """Runs (arc, part, first row, rows) cut where a piece of their arc ends, with shard and first slot."""
    by_arc = defaultdict(list)
    for arc, part, first, n in sorted(runs, key=lambda r: (r[1], r[2])):
        by_arc[arc].append([part, first, n])
    used, out = [0] * shards, []
    for arc, own in enumerate(plan):
        waiting = iter(by_arc[arc])
        part, first, n = next(waiting, (0, 0, 0))
        for shard, left in own:
            while left:
                if not n:
                    part, first, n = next(waiting)
                taken = min(left, n)
                out.append({"arc": arc, "_part": part, "lo": first, "hi": first + taken, "shard": shard, "base": used[shard] - first})
                used[shard] += taken
                first, n, left = first + taken, n - taken, left - taken
    return out


def _small(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A table of driver rows as an expression of the plan, without a Python worker."""
    text = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(text))


def _owners(spark: SparkSession, nodes: Sequence[tuple[int, int]]) -> DataFrame:
    """cell, arc for every cell. The arc of a node ends at its cell; what follows the last node belongs to the first."""
    rows, start = [], 0
    for arc, (cell, _) in enumerate(nodes):
        rows.append({"arc": arc, "start": start, "end": cell})
        start = cell + 1
    if start < CELLS:
        rows.append({"arc": 0, "start": start, "end": CELLS - 1})
    arcs = _small(spark, rows, "arc: int, start: int, end: int")
    return arcs.select("arc", F.explode(F.sequence("start", "end")).alias("cell"))


def place(rows: DataFrame, shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``; ``rows`` has doc_id and a unique long ``_row`` and is cheap to read twice."""
    spark = rows.sparkSession
    circle = ring(shards, nodes)
    cell = F.pmod(F.xxhash64("doc_id"), F.lit(CELLS)).cast("int")
    # fixed size: one row for each cell
    keyed = rows.withColumn("cell", cell).join(F.broadcast(_owners(spark, circle)), "cell")
    # cells after the last node belong to arc 0 but come last in the order: their runs follow those at its start
    held = in_order(keyed, ["cell", "doc_id", "_row"], "ring")
    # at most one row for each arc and one for each range
    runs = held.groupBy("arc", "_part", (F.col("cell") > circle[-1][0]).alias("wrapped")).agg(F.min("_at").alias("first"), F.count(F.lit(1)).alias("n"))
    found = [(r.arc, r["_part"], r.first, r.n) for r in runs.select("arc", "_part", F.col("first"), "n").collect()]
    counts = [0] * len(circle)
    for arc, _, _, n in found:
        counts[arc] += n
    owners = [shard for _, shard in circle]
    plan = pieces(counts, owners, shares(sum(counts), shards))
    cut = _small(spark, _segments(found, plan, shards), "arc: int, _part: bigint, lo: bigint, hi: bigint, shard: int, base: bigint")
    within = (F.col("_at") >= F.col("lo")) & (F.col("_at") < F.col("hi"))
    # as many rows as arcs, ranges and overflows together
    placed = held.join(F.broadcast(cut.withColumnsRenamed({"arc": "c_arc", "_part": "c_part"})), (F.col("arc") == F.col("c_arc")) & (F.col("_part") == F.col("c_part")) & within)
    return placed.select(*rows.columns, "shard", (F.col("base") + F.col("_at")).alias("slot"))


def shard_documents(documents: DataFrame, shards: int = SHARDS, nodes: int = NODES) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``documents``.

    A null text counts as empty; a null doc_id has a cell of its own; rows with equal
    doc_ids and repeated rows start at one cell and are placed like any others, one by
    one. Slots count the rows of a shard from 0 without gaps. Other columns are ignored;
    an empty table gives no rows. ``grown_shard`` is null, as the law is ``rows``.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
    )
    placed = place(stage(narrow, "rows"), shards, nodes)
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(documents: DataFrame, path: str, shards: int = SHARDS, nodes: int = NODES) -> None:
    """Write one folder ``shard=<n>`` for each shard that has rows, as Parquet: ``slot`` and the whole row as ``document``.

    The corpus is written once more to the shared folder, so that rows keep the number
    they were placed by. Files of a shard hold ranges of its slots in order.
    """
    held = stage(documents.select(F.struct("*").alias("document"), F.monotonically_increasing_id().alias("_row")), "documents")
    placed = place(held.select(F.col("document.doc_id").cast("long").alias("doc_id"), "_row"), shards, nodes)
    whole = held.join(placed.select("_row", "shard", "slot"), "_row").select("shard", "slot", "document")
    whole.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
