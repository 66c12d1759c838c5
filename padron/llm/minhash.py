"""Near-duplicate documents by HyperMinHash sketches.

A document's set is its distinct 5-word shingles (64-bit hashes of lower-cased words).
One hash per shingle chooses one of 256 buckets and gives the bucket's minimum; of that
minimum a register keeps the number of leading zeros and ten mantissa bits. Buckets
without a shingle borrow the register of a pseudo-random filled bucket, which keeps the
chance of equal registers at the Jaccard similarity for short documents too.

1. Equal sets collapse to their smallest doc_id, so copies are never paired.
2. Four registers form a band. Forty bands miss a pair of similarity 0.75 with
   probability (1 - 0.75**4) ** 40 = 2.5e-7.
3. Each band value has a hub, its smallest document. A document is first checked with the
   hub it shares most bands with.
4. Buckets that still hold several components get a new hub: the document with the fewest
   shingles that no other document there has. Every member is compared with it.
5. Then pairs of a bucket that are still in two components are checked, if they can be
   similar: two documents share at most what both share with the hub, and of the rest
   only shingles that some other document has. Members already connected need no more
   checks, so a large group of near copies costs a few checks for each member, and no
   link between components is lost.
6. The checks of 3 and 5 first pass the collision-corrected register estimate. All compare
   the full shingle sets, exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.llm.components import components
from padron.llm.words import POSITION, Words, chunks, mix
from padron.sources.staging import stage

SHINGLE = 5
BUCKETS = 256
MANTISSA_BITS = 10
BANDS, ROWS = 40, 4
SIMILARITY_PERCENT = 75
#: Bits of the filter for ids whose sets are needed (8 MB).
FILTER_BITS = 1 << 26
_SLOT = "_id_slot"
#: Sets below this size have too few independent registers to be judged by them.
ESTIMATE_FROM = 64
#: Five standard deviations of the share of 256 equal registers at 0.75.
ESTIMATE_MARGIN = 0.135
#: Registers of different minima agree when zeros (about 1 in 3) and mantissa agree.
COLLISION = 1 / 3 / 2**MANTISSA_BITS

_ATTEMPTS = 512
_BORROW = np.random.default_rng(77).integers(0, BUCKETS, (_ATTEMPTS, BUCKETS))

SKETCH = "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>"
SETS = "doc_id long, grams array<long>, registers array<short>"
KEYS = ["n_shingles", "k1", "k2"]


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles, sorted by row and hash."""
    hashes = words.hashes()
    at, found = words.windows(hashes, SHINGLE)
    row = words.row[at]
    for size in range(1, SHINGLE):  # fewer words: the whole sequence is the one shingle
        short = np.flatnonzero(words.count == size)
        if len(short):
            whole = np.full(len(short), np.uint64(size))
            for k in range(size):
                whole += hashes[words.first[short] + k] * POSITION[k + 8]
            row, found = np.concatenate((row, short)), np.concatenate((found, mix(whole)))
    order = np.argsort(row, kind="stable")
    row, found = row[order], found[order]
    edges = np.searchsorted(row, np.arange(words.rows + 1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        found[a:b].sort()
    if not len(found):
        return row, found
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
    return row[new], found[new]


def registers(rows: int, row: np.ndarray, found: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (rows x BUCKETS) of sorted distinct hashes; rows without any are 0."""
    out = np.zeros((rows, BUCKETS), np.uint16)
    if not len(found):
        return out
    slot = row * BUCKETS + (found >> np.uint64(56)).astype(np.int64)
    least = np.ones(len(slot), bool)
    least[1:] = slot[1:] != slot[:-1]  # sorted: the first hash of a bucket is its minimum
    mantissa, exponent = np.frexp((found[least] << np.uint64(8)).astype(np.float64))
    code = (64 - exponent).astype(np.uint16) << np.uint16(MANTISSA_BITS)
    code |= np.minimum((mantissa * 2 - 1) * 2**MANTISSA_BITS, 2**MANTISSA_BITS - 1).astype(np.uint16)
    filled = np.zeros((rows, BUCKETS), bool)
    out.ravel()[slot[least]] = code
    filled.ravel()[slot[least]] = True
    own, any_filled = filled.copy(), filled.any(axis=1)
    at, bucket = np.nonzero(~filled & any_filled[:, None])
    for attempt in _BORROW:
        if not len(at):
            break
        source = attempt[bucket]
        hit = own[at, source]
        out[at[hit], bucket[hit]] = out[at[hit], source[hit]]
        at, bucket = at[~hit], bucket[~hit]
    step = 1
    while len(at):  # the rest takes the next filled bucket
        source = (bucket + step) % BUCKETS
        hit = own[at, source]
        out[at[hit], bucket[hit]] = out[at[hit], source[hit]]
        at, bucket, step = at[~hit], bucket[~hit], step + 1
    return out


def band_values(codes: np.ndarray) -> np.ndarray:
    parts = codes[:, : BANDS * ROWS].reshape(len(codes), BANDS, ROWS).astype(np.uint64)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * POSITION[20], parts.shape[:2]).copy()
    for k in range(ROWS):
        total += (parts[:, :, k] + np.uint64(1)) * POSITION[24 + k]
    return mix(total)


def _lists(values: np.ndarray, width: int, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, width, dtype=np.int32), pa.array(values.ravel(), kind))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("doc_id"))
        for start, end, data, bounds in chunks(batch):
            words = Words(data, bounds)
            row, found = shingles(words)
            edges = np.searchsorted(row, np.arange(words.rows + 1))
            totals = [np.concatenate(([np.uint64(0)], np.cumsum(h, dtype=np.uint64))) for h in (mix(found), mix(found ^ POSITION[40]))]
            k1, k2 = (t[edges[1:]] - t[edges[:-1]] for t in totals)
            codes = registers(words.rows, row, found)
            yield pa.record_batch(
                [
                    ids.slice(start, end - start),
                    pa.array(np.diff(edges)),
                    pa.array(k1.view(np.int64)),
                    pa.array(k2.view(np.int64)),
                    _lists(band_values(codes).view(np.int64), BANDS, pa.int64()),
                ],
                ["doc_id", "n_shingles", "k1", "k2", "bands"],
            )


def _slot() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))


def _bitmap(ids: DataFrame):
    """Broadcast bitmap of FILTER_BITS hashed ids, which have no null. Its size is fixed:
    where it fills up it passes more ids than it should, and never misses one."""
    words = ids.select(_slot().alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return ids.sparkSession.sparkContext.broadcast(bits)


def _in_bitmap(bits: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
    slot = batch.column(batch.schema.get_field_index(_SLOT)).fill_null(0).to_numpy(zero_copy_only=False)
    return (bits[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) > 0


def _sets(wanted) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_in_bitmap(wanted.value, batch)))
            for start, end, data, bounds in chunks(batch):
                words = Words(data, bounds)
                row, found = shingles(words)
                edges = np.searchsorted(row, np.arange(words.rows + 1)).astype(np.int32)
                grams = pa.ListArray.from_arrays(edges, pa.array(found.view(np.int64)))
                codes = _lists(registers(words.rows, row, found).view(np.int16), BUCKETS, pa.int16())
                yield pa.record_batch([batch.column(0).slice(start, end - start), grams, codes], ["doc_id", "grams", "registers"])

    return run


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, grams, registers of at least the documents whose id is in ``ids``; no text is shuffled."""
    texts = docs.filter("doc_id IS NOT NULL").withColumn(_SLOT, _slot())
    return stage(texts.mapInArrow(_sets(_bitmap(ids)), SETS), "sets")


def _estimate(a: Column, b: Column) -> Column:
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return (same / BUCKETS - COLLISION) / (1 - COLLISION)


def _sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """doc_id, grams, registers of at least the documents whose id is in ``ids``, which has no null.

    The texts stay where they are: a bitmap of FILTER_BITS hashed ids goes to every task.
    Its size is fixed; where it fills up, more sets than needed are made, none is missed.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS))
    words = ids.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.uint64)
    bits[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    wanted = docs.sparkSession.sparkContext.broadcast(bits)
    texts = docs.filter("doc_id IS NOT NULL").withColumn("slot", slot)
    return stage(texts.mapInArrow(_sets(wanted), SETS), "sets")


def _compared(pairs: DataFrame, sets: DataFrame, estimated: bool = True) -> DataFrame:
    """a, b, n (shared shingles), linked for pairs; with ``estimated`` only for those whose
    sizes and registers allow the similarity."""
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("grams").alias(f"g_{c}"), F.col("registers").alias(f"r_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    n_a, n_b = F.size("g_a"), F.size("g_b")
    if estimated:
        close = _estimate(F.col("r_a"), F.col("r_b")) >= SIMILARITY_PERCENT / 100 - ESTIMATE_MARGIN
        sizes = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * SIMILARITY_PERCENT
        both = both.filter(sizes & ((F.least(n_a, n_b) < ESTIMATE_FROM) | close))
    counted = both.select("a", "b", n_a.alias("n_a"), n_b.alias("n_b"), F.size(F.array_intersect("g_a", "g_b")).alias("n"))
    return counted.withColumn("linked", F.col("n") * 100 >= (F.col("n_a") + F.col("n_b") - F.col("n")) * SIMILARITY_PERCENT)


def _linked(compared: DataFrame) -> DataFrame:
    return compared.filter("linked").select("a", "b")


def _mixed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (with component ``c``) of the buckets that hold several components."""
    labelled = _labelled(members, labels, "doc_id", "c")
    several = labelled.groupBy("band").agg(F.min("c").alias("c0"), F.max("c").alias("c1")).filter("c0 <> c1")
    return labelled.join(several.select("band"), "band", "left_semi")


def _labelled(df: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    found = labels.select(F.col("node").alias(node), F.col("component").alias(name))
    return df.join(found, node, "left").withColumn(name, F.coalesce(name, node))


def link_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``documents(doc_id, text, ...)``.

    Null and wordless texts have an empty set and stay alone. Rows with equal doc_id are
    one node. A row without doc_id is never linked: its component_id is null and it is
    kept. Other columns are ignored. An empty table gives an empty table.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = stage(docs.mapInArrow(_sketch, SKETCH), "sketches")
    known = rows.filter("doc_id IS NOT NULL AND n_shingles > 0")
    classes = stage(known.groupBy(*KEYS).agg(F.min("doc_id").alias("node")), "classes")
    sketches = known.join(classes.withColumnRenamed("node", "doc_id"), ["doc_id", *KEYS], "left_semi")
    sketches = stage(sketches.select("doc_id", "n_shingles", "bands"), "representatives")

    bands = sketches.select("doc_id", "n_shingles", F.explode("bands").alias("band"))
    hubs = bands.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stage(bands.join(hubs, "band").select("band", "doc_id", "n_shingles", "hub"), "members")

    shared = members.filter("hub < doc_id").groupBy("doc_id", "hub").agg(F.count(F.lit(1)).alias("bands"))
    pairs = shared.groupBy(F.col("doc_id").alias("b")).agg(F.max_by("hub", F.struct("bands", -F.col("hub"))).alias("a"))
    pairs = stage(pairs.select("a", "b"), "nearest")
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    labels = components(_linked(_compared(pairs, _sets_of(docs, ends))))

    mixed = stage(_mixed(members.drop("hub"), labels), "mixed")
    sets = _sets_of(docs, mixed.select("doc_id").distinct())
    owners = sets.select("doc_id", F.explode("grams").alias("gram")).groupBy("gram").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("n"))
    solo = owners.filter("n = 1").groupBy("doc_id").agg(F.count(F.lit(1)).alias("solo"))
    mixed = mixed.join(solo, "doc_id", "left").withColumn("common", F.col("n_shingles") - F.coalesce("solo", F.lit(0)))
    # a document that shares less than the limit with all others together has no link
    mixed = mixed.filter(F.col("common") * 100 >= F.col("n_shingles") * SIMILARITY_PERCENT).drop("solo")
    best = F.min_by("doc_id", F.struct(1 - F.col("common") / F.col("n_shingles"), "doc_id"))
    several = mixed.groupBy("band").agg(F.min("c").alias("c0"), F.max("c").alias("c1"), best.alias("hub")).filter("c0 <> c1")
    open_ = stage(mixed.drop("c").join(several.select("band", "hub"), "band"), "open")
    pairs = open_.filter("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    compared = stage(_compared(pairs, sets, estimated=False), "compared")
    labels = components(_links(labels).union(_linked(compared)))

    with_hub = compared.groupBy(F.col("a").alias("hub"), F.col("b").alias("doc_id")).agg(F.max("n").alias("n"))
    apart = _mixed(open_, labels).join(with_hub, ["hub", "doc_id"], "left").withColumn("n", F.coalesce("n", "common"))
    apart = stage(apart.select("band", "doc_id", "c", "n_shingles", "n", (F.col("common") - F.col("n")).alias("rest")), "apart")
    bands = apart.groupBy("doc_id").agg(F.collect_set("band").alias("bands"))  # BANDS of them at most
    apart = apart.join(bands, "doc_id")
    other = apart.select("band", *(F.col(c).alias(f"{c}_a") for c in ("doc_id", "c", "n_shingles", "n", "rest", "bands")))
    most = F.least("n", "n_a") + F.least("rest", "rest_a")
    similar = most * 100 >= (F.col("n_shingles") + F.col("n_shingles_a") - most) * SIMILARITY_PERCENT
    once = F.col("band") == F.array_min(F.array_intersect("bands", "bands_a"))  # in one of the bands they share
    pairs = apart.join(other, "band").filter((F.col("doc_id_a") < F.col("doc_id")) & (F.col("c") != F.col("c_a")) & similar & once)
    pairs = stage(pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id").alias("b")).distinct(), "last")
    labels = components(_links(labels).union(_linked(_compared(pairs, sets))))

    return (
        rows.select("doc_id", *KEYS)
        .join(classes, KEYS, "left")
        .join(labels, "node", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )


def _links(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("component").alias("a"), F.col("node").alias("b"))


def keep_one_of_each_group(documents: DataFrame) -> DataFrame:
    """Rows of ``documents`` without those linked to a smaller doc_id; columns unchanged.

    Most texts stay where they are: only rows that a bitmap of the dropped ids lets pass
    are joined with these ids.
    """
    dropped = stage(link_duplicates(documents).filter("NOT kept").select("doc_id").distinct(), "dropped")
    bits = _bitmap(dropped)

    def part(inside: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = pa.compute.is_valid(batch.column(batch.schema.get_field_index("doc_id"))).to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array((_in_bitmap(bits.value, batch) & known) == inside))

        return run

    marked = documents.withColumn(_SLOT, _slot())
    sure = marked.mapInArrow(part(False), marked.schema)
    rest = marked.mapInArrow(part(True), marked.schema).join(dropped, "doc_id", "left_anti")
    return sure.unionByName(rest).select(*documents.columns)
