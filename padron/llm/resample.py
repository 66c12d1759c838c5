"""Importance resampling towards a target distribution of hashed word n-grams.

1. Two counts of all runs of one to three words by bucket: of the corpus and the target.
   They become one array of integer gains.
2. The corpus is read once more and scored by that array; scores are written.
3. The cutoff of the draw is found by bisection: count jobs over the written scores, then
   over the doc_ids tied at the cutoff. Each job counts below several thresholds at once,
   which answers several questions of a plain bisection. Nothing is collected or sorted.
4. Only the drawn rows are range-partitioned to get their ranks.

The checksum of "a b" follows from those of "a" and " b" by a linear map of the length,
so that n-grams are never put together as text.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.ranges import in_order
from padron.llm.words import PUNCTUATION, Words, chunks, per_row
from padron.sources.staging import stage

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
#: Thresholds of one count job: four steps of a plain bisection.
THRESHOLDS = 15

# --- checksums -------------------------------------------------------------------------

#: Words up to this many bytes are summed together, byte by byte; longer ones one by one.
_SHORT = 64
_POLYNOMIAL = 0xEDB88320


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


_TABLE = _byte_table()


def _by_tables(tables: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return tables[0][sums & 0xFF] ^ tables[1][(sums >> 8) & 0xFF] ^ tables[2][(sums >> 16) & 0xFF] ^ tables[3][sums >> 24]


def _shift_tables(levels: int = 40) -> np.ndarray:
    """For each k, four tables of 256 that give a checksum's change by 2**k appended bytes."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    images = (bits >> 8) ^ _TABLE[bits & 0xFF]  # of each single bit, after one zero byte
    out = np.zeros((levels, 4, 256), np.uint32)
    values = np.arange(256)
    for k in range(levels):
        for part in range(4):
            for bit in range(8):
                out[k, part][values >> bit & 1 == 1] ^= images[8 * part + bit]
        images = _by_tables(out[k], images)
    return out


_SHIFT = _shift_tables()


def appended(sums: np.ndarray, lengths: np.ndarray, others: np.ndarray) -> np.ndarray:
    """crc32 of each text followed by another, from both checksums and the other's length in bytes."""
    out = sums.copy()
    for k in range(int(lengths.max()).bit_length() if len(lengths) else 0):
        at = np.flatnonzero(lengths >> k & 1)
        out[at] = _by_tables(_SHIFT[k], out[at])
    return out ^ others


def word_sums(words: Words) -> np.ndarray:
    """crc32 of each word's bytes."""
    lengths = words.ends - words.starts
    out = np.full(len(words), 0xFFFFFFFF, np.uint32)
    order = np.argsort(-np.where(lengths > _SHORT, 0, lengths), kind="stable")
    short = int((lengths <= _SHORT).sum())
    starts, sizes, register = words.starts[order], lengths[order], out[order]
    for place in range(int(sizes[0]) if short else 0):
        n = int(np.searchsorted(-sizes[:short], -place))  # those longer than place come first
        register[:n] = (register[:n] >> 8) ^ _TABLE[(register[:n] ^ words.data[starts[:n] + place]) & 0xFF]
    out[order] = register ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(lengths > _SHORT):
        out[i] = zlib.crc32(words.data[words.starts[i] : words.ends[i]])
    return out


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row, bucket) of all runs of one word, of two, and so on up to LONGEST."""
    if not len(words):
        return []
    single = word_sums(words)
    lengths = words.ends - words.starts + 1
    spaced = appended(np.full(len(words), zlib.crc32(b" "), np.uint32), lengths - 1, single)
    at, sums = np.arange(len(words)), single
    out = [(words.row, (sums % BUCKETS).astype(np.int64))]
    for size in range(2, LONGEST + 1):
        keep = at + size - 1 < len(words)
        keep[keep] = words.row[at[keep]] == words.row[at[keep] + size - 1]
        at = at[keep]
        last = at + size - 1
        sums = appended(sums[keep], lengths[last], spaced[last])
        out.append((words.row[at], (sums % BUCKETS).astype(np.int64)))
    return out


# --- counts and scores -----------------------------------------------------------------


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, _, data, bounds in chunks(batch):
            for _, bucket in features(Words(data, bounds, PUNCTUATION)):
                total += np.bincount(bucket, minlength=BUCKETS)
    held = np.flatnonzero(total)
    yield pa.record_batch([pa.array(held), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """How often each bucket occurs in all of ``texts(text)``: summed in each task, then over tasks."""
    counts = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(_counted, "bucket long, n long")
    found = counts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows at most
    out = np.zeros(BUCKETS, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the log ratio of target to source share of each bucket, smoothed by one."""
    total_s, total_t = float(source.sum()) + BUCKETS, float(target.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((t + 1.0) * total_s / ((s + 1.0) * total_t))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: int | None) -> int:
    """Whole thousandths of a Gumbel number drawn by the doc_id (null: as from an empty text)."""
    drawn = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


def _scored(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for start, end, data, bounds in chunks(batch):
                words = Words(data, bounds, PUNCTUATION)
                n, weight = np.zeros(end - start, np.int64), np.zeros(end - start, np.int64)
                for row, bucket in features(words):
                    n += per_row(words.rows, row)
                    weight += per_row(words.rows, row, gain[bucket]).astype(np.int64)  # whole numbers, far below 2**53
                own = ids.slice(start, end - start)
                noise = np.array([gumbel(d) for d in own.to_pylist()], np.int64)
                yield pa.record_batch(
                    [own, pa.array(words.count.astype(np.int64)), pa.array(n), pa.array(weight), pa.array(weight + noise)],
                    ["doc_id", "n_words", "n_features", "weight", "score"],
                )

    return run


# --- the draw --------------------------------------------------------------------------


def kth(rows: DataFrame, key: Column, k: int) -> tuple[int, int, int]:
    """(the k-th smallest key, rows below it, rows at or below it) by bisection over whole numbers.

    ``k`` is between 1 and the number of rows; no key is null.
    """
    least, most, count = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    low, high, below, within = least - 1, most, 0, count
    while high - low > 1:
        steps = min(THRESHOLDS, high - low - 1)
        tried = sorted({low + (high - low) * (i + 1) // (steps + 1) for i in range(steps)} - {low, high})
        found = rows.agg(*[F.count_if(key <= F.lit(t).cast("long")).alias(f"n{i}") for i, t in enumerate(tried)]).first()
        for t, n in zip(tried, found, strict=True):
            if n >= k:
                high, within = t, n
                break
            low, below = t, n
    return high, below, within


def leading(rows: DataFrame, keys: Sequence[Column], k: int) -> Column:
    """What holds for exactly the first ``k`` rows in the order of the keys, which are unique together."""
    if k <= 0:
        return F.lit(False)
    key, rest = keys[0], keys[1:]
    limit, below, within = kth(rows, key, k)
    cut = F.lit(limit).cast("long")
    if within == k:
        return key <= cut
    return (key < cut) | ((key == cut) & leading(rows.filter(key == cut), rest, k - below))


def resample(documents: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every row of ``documents(doc_id, text)``.

    ``percent`` of the documents with at least ``least_words`` words are drawn, the highest
    scores first; ties go to the smaller doc_id, a missing one first. Rows with equal
    doc_id and score are told apart by their place in the table, so the number drawn is
    exact. Null and wordless texts have no features and weight 0. Other columns of both
    tables are ignored. An empty target pulls towards rare buckets; an empty corpus gives
    an empty table.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gain = gains(bucket_counts(texts), bucket_counts(target))
    kind = "doc_id long, n_words long, n_features long, weight long, score long"
    scored = stage(texts.mapInArrow(_scored(gain), kind).withColumn("_row", F.monotonically_increasing_id()), "scores")
    able = F.col("n_words") >= least_words
    eligible = scored.filter(able)
    keys = [-F.col("score"), F.coalesce("doc_id", F.lit(-(2**63))), F.col("_row")]
    drawn = able & leading(eligible, keys, percent * eligible.count() // 100)

    first = scored.filter(drawn).withColumn("_down", -F.col("score"))
    ordered = in_order(first, ["_down", "doc_id", "_row"], "drawn")
    before, rows = 0, [(-1, 0)]
    for part, n in sorted(map(tuple, ordered.groupBy("_part").count().collect())):  # one row for each range
        rows.append((part, before))
        before += n
    offsets = documents.sparkSession.createDataFrame(rows, "_part long, before long")
    rank = (F.col("before") + F.col("_at") + 1).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = ordered.join(F.broadcast(offsets), "_part").select(*columns, rank)
    return ranked.unionByName(scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
