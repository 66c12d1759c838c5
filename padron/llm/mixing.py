"""Mix sources to target weights with a multivariate-hypergeometric splitting tree.

Targets: every source's share of all words follows its weight, up to a limit of
``MAX_REPEATS`` times its own words; what lies above is shared out again by weight.

Draws: each source is put into a pseudo-random order and cut into blocks of
``BLOCK_WORDS`` words, or of as many as leave MOST_BLOCKS blocks in all. A source with target T takes floor(T / size) whole passes and, of
one more pass, the blocks up to the rest of T; the block quota of each source is exact.
A tree over the output shards splits these quotas: at every node the left half draws its
number of blocks without replacement from what the node holds, which is a multivariate
hypergeometric draw. Each shard so owns a range of each source's blocks, no block twice,
and orders its documents by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.words import SPACES, Words, chunks
from padron.sources.staging import stage

#: Weights of the sources in order of their names, repeating; null comes last.
WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 4096
#: Blocks grow with the corpus, so that exact draws stay within the generator's range.
MOST_BLOCKS = 400_000_000
SHARDS = 64
SEED = 11
#: Documents of a source are ordered within this many hash ranges, each by itself.
RANGES = 4096
#: A shard is written in this many runs of places.
SPREAD = 16
_ROW = "_mix_row"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [i for i, n in enumerate(batch.schema.names) if n != "text"]
        for start, end, data, bounds in chunks(batch):
            part = batch.slice(start, end - start)
            sizes = pa.array(Words(data, bounds, SPACES, lower=False).count.astype(np.int64))
            yield pa.record_batch([*(part.column(i) for i in rest), sizes], [*(batch.schema.names[i] for i in rest), "size"])


def sized(documents: DataFrame, *keep: str) -> DataFrame:
    """doc_id, source, tie, size (words; null text: 0) and long columns to ``keep``.

    ``tie`` orders rows that share the rest.
    """
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.xxhash64("text").alias("tie"),
        F.col("text").cast("string").alias("text"),
        *keep,
    )
    kept = "".join(f", {c} long" for c in keep)
    return docs.mapInArrow(_count, f"doc_id long, source string, tie long{kept}, size long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, weight, source_size, target for each source of ``sizes(source, size)``.

    Sources at their limit are those of the smallest size for their weight. With k of
    them the others share what is left by weight; k is the least number for which no
    other source passes its limit. Exact integers until the last division.
    """
    each = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int"))
    each = each.withColumn("weight", weight.cast("long"))
    order = [(F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    filled = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    total = F.sum("source_size").over(every)
    left = total - MAX_REPEATS * F.coalesce(F.sum("source_size").over(filled), F.lit(0))
    rest = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filled), F.lit(0))
    each = each.withColumn("left", left).withColumn("rest", rest)
    # the first source below its limit when the k before it are at theirs sets the level
    below = F.col("left") * F.col("weight") < MAX_REPEATS * F.col("source_size") * F.col("rest")
    level = F.min(F.when(below, F.struct((F.col("source_size") / F.col("weight")).alias("ratio"), (-F.col("rest")).alias("minus"), "left"))).over(every)
    each = each.withColumn("level", level)
    limit = (MAX_REPEATS * F.col("source_size")).cast("double")
    share = (F.col("level.left") * F.col("weight")).cast("double") / -F.col("level.minus")
    return each.select("source", "weight", "source_size", F.coalesce(F.least(limit, share), limit).alias("target"))


def split_tree(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows); columns sum to the quotas.

    Every node's draw depends on the seed and the node alone, so reruns agree.
    """
    out = np.zeros((shards, len(quotas)), np.int64)
    waiting = [(0, shards, np.asarray(quotas, np.int64))]
    while waiting:
        a, b, held = waiting.pop()
        if b - a == 1:
            out[a] = held
            continue
        middle = (a + b) // 2
        draws = int(held.sum()) * (middle - a) // (b - a)
        taken = _draw(held, draws, np.random.default_rng([seed, a, b]))
        waiting += [(a, middle, taken), (middle, b, held - taken)]
    return out


def _draw(held: np.ndarray, draws: int, rng: np.random.Generator) -> np.ndarray:
    """Multivariate hypergeometric draw, one source after the other; exact at any size."""
    out, left = np.zeros_like(held), int(held.sum())
    for i, n in enumerate(held.tolist()):
        left -= n
        k = _drawn(n, left, draws, rng)
        out[i] = k
        draws -= k
    return out


#: The generator takes counts below this.
_RANGE = 1_000_000_000


def _drawn(n: int, others: int, draws: int, rng: np.random.Generator) -> int:
    """How many of ``draws`` from n + others are of the n: a hypergeometric number."""
    if not n or not draws:
        return 0
    if n < _RANGE and others < _RANGE:
        return int(rng.hypergeometric(n, others, draws))
    # beyond the generator's range the distribution is summed up around its mode, as far as it weighs anything
    least, most = max(0, draws - others), min(n, draws)
    mode = min(max((draws + 1) * (n + 1) // (n + others + 2), least), most)
    share = n / (n + others)
    spread = (draws * share * (1 - share) * (n + others - draws) / max(n + others - 1, 1)) ** 0.5
    reach = int(12 * spread) + 50
    low, high = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log((n - k) / (k + 1)) + np.log((draws - k) / (others - draws + k + 1))
    chance = np.concatenate(([0.0], np.cumsum(steps)))
    chance = np.cumsum(np.exp(chance - chance.max()))
    return low + int(np.searchsorted(chance, rng.random() * chance[-1], "right"))


def _shard_ranges(shards: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: (r["source"] is None, r["source"] or ""))
        share = split_tree(np.array([r["blocks"] for r in rows], np.int64), shards) if rows else np.zeros((shards, 0), np.int64)
        yield pa.record_batch(
            [pa.array([r["source"] for r in rows], pa.string()), pa.array(np.cumsum(share, 0).T.tolist(), pa.list_(pa.int64()))],
            ["source", "upto"],
        )

    return split


def plan_mix(documents: DataFrame, *keep: str, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS, most_blocks: int = MOST_BLOCKS) -> DataFrame:
    """One row for each document: doc_id, source, tie, size, source_size, target, draws, and ``keep``.

    A document is in every whole pass of its source and, as far as the source's exact
    quota reaches, in one more; only the document at the quota's end is taken in part.
    """
    rows = stage(sized(documents, *keep), "sizes")
    sources = targets(rows, weights)
    passes = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0)
    sources = sources.withColumn("copies", passes).withColumn("quota", F.floor("target") - F.col("copies") * F.col("source_size"))
    every = F.sum(F.floor("target")).over(Window.partitionBy())  # one row for each source
    sources = sources.withColumn("block_words", F.greatest(F.lit(BLOCK_WORDS).cast("long"), F.ceil(every / F.lit(most_blocks))))
    sources = sources.withColumn("blocks", F.ceil(F.floor("target") / F.col("block_words")))
    sources = stage(sources, "sources")
    tree = sources.select("source", "blocks").repartition(1).mapInArrow(_shard_ranges(shards), "source string, upto array<long>")
    sources = sources.drop("blocks").join(tree, sources["source"].eqNullSafe(tree["source"])).drop(tree["source"])

    order = F.xxhash64("doc_id", "tie", F.lit(SEED))
    placed = rows.withColumn("order", order).withColumn("range", F.pmod("order", F.lit(RANGES)))
    ranges = placed.groupBy("source", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("source", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("source", "range").orderBy("order", "doc_id", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    same = [placed[c].eqNullSafe(ranges[c]) for c in ("source", "range")]
    placed = placed.join(ranges, same[0] & same[1]).drop(ranges["source"], ranges["range"])
    placed = placed.withColumn("offset", F.col("begin") + F.col("ahead"))
    placed = placed.join(sources, placed["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("quota") - F.col("offset")))
    return placed.select("doc_id", "source", "tie", "size", "source_size", "target", _draws(part).alias("draws"), *keep)


def _draws(part: Column) -> Column:
    """The copies of a document in the mix: array of (copy, words, shard, block, place).

    ``place`` is the order within the shard, which owns the block in which the copy begins.
    """
    block = lambda copy: F.floor((copy * F.col("source_size") + F.col("offset")) / F.col("block_words"))
    shard = lambda copy: F.least(F.size(F.filter("upto", lambda x: x <= block(copy))), F.size("upto") - 1)
    copies = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("copies")),
        lambda copy: F.struct(
            copy.alias("copy"),
            F.when(copy < F.col("copies"), F.col("size")).otherwise(part).alias("words"),
            shard(copy).alias("shard"),
            block(copy).alias("block"),
            F.xxhash64(copy, "doc_id", "tie", F.lit(SEED)).alias("place"),
        ),
    )
    return F.filter(copies, lambda d: d["words"] > 0)


def taken_words(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, draws for every row of ``documents``.

    ``draws`` has a row (copy, words, shard, block) for each copy of the document in the
    mix: the tree over the shards decides which shard owns the block that it begins in.

    Null and empty texts have size 0 and are never drawn; a source without words has
    target 0. A null source is a source. Repeated rows are mixed as rows of their own;
    rows equal in id and text may be taken in either order. An empty table gives none.
    """
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda s, d: s + d["words"])
    shown = F.transform("draws", lambda d: F.struct(d["copy"].alias("copy"), d["words"].alias("words"), d["shard"].alias("shard"), d["block"].alias("block")))
    return plan_mix(documents).select("doc_id", "size", "source_size", "target", taken.alias("taken"), shown.alias("draws"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, shards: int = SHARDS) -> DataFrame:
    """The mixed documents, one row for each copy, with the columns of ``documents``.

    The last document of a source's quota is cut after its last taken word, and its
    n_chars, where there is such a column, follows. Rows of a shard lie together, in the
    order of their place.
    """
    numbered = stage(documents.withColumn(_ROW, F.monotonically_increasing_id()), "documents")
    plan = plan_mix(numbered, _ROW, weights=weights, shards=shards)
    plan = plan.select(_ROW, F.col("size").alias("_mix_size"), F.explode("draws").alias("_mix_draw"))
    each = numbered.join(plan, _ROW)
    cut = F.col("_mix_draw.words") < F.col("_mix_size")
    words = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])", (F.col("_mix_draw.words") + 1).cast("int"))
    head = F.array_join(F.slice(words, F.lit(1), F.col("_mix_draw.words").cast("int")), "")
    each = each.withColumn("text", F.when(cut, head).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        each = each.withColumn("n_chars", F.when(cut, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    ordered = each.repartition("_mix_draw.shard", F.pmod("_mix_draw.place", F.lit(SPREAD))).sortWithinPartitions("_mix_draw.shard", "_mix_draw.place")
    return ordered.select(*documents.columns)
