"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (3 to 6, with word boundaries) and itself,
hashed into a table of vectors; unseen misspellings and inflections share n-grams with
seen words. Vectors of a window of words are averaged and put through a linear softmax;
a document is as toxic as its few most toxic windows. Vectors and softmax are trained
jointly in numpy, on a bounded sample of labelled documents.

For scoring, vectors and softmax fold into one number for each n-gram: the logit of an
average of vectors is the average of the logits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from padron.llm.words import POSITION, SPACES, Words, chunks, give_back, mix

GRAMS = (3, 4, 5, 6)
TABLE_BITS = 18
DIMENSION = 8
#: Bytes of text worked on at once; the n-grams take a hundred times as much.
CHUNK = 1 << 17
WINDOW, STRIDE = 1, 1
#: A document's logit is the mean over this many of its most toxic windows.
TOP = 3
#: Bound of the training sample: whole documents of the smallest hashes.
TRAINING_DOCUMENTS = 3000
EPOCHS, WARM_UP, RATES, DECAY = 100, 30, (20.0, 0.1, 0.2), 1e-4
#: Factor on averages, so that small vectors give large logits.
SHARPNESS = 16.0
#: An n-gram seen n times in the sample counts n / (n + SHRINK): one seen once is learned, but little.
SHRINK = 8.0
#: A document is held out when its checksum leaves HELD_OUT.
FOLDS, HELD_OUT = 5, 0


class Bags:
    """n-gram slots of words: flat ``slot`` with ``word`` telling whose they are."""

    def __init__(self, words: Words):
        text = words.data
        # code points of the words, each between two boundary marks
        length = words.ends - words.starts
        at = np.cumsum(length + 2) - (length + 2)
        flat = np.full(int((length + 2).sum()), 0x7F, np.uint8)
        place = np.repeat(at + 1 - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
        flat[place] = text[words.inside]
        heads = np.flatnonzero((flat & 0xC0) != 0x80)
        raw = flat[heads].astype(np.uint64)
        for k in (1, 2, 3):  # a code point is its lead byte and what continues it
            follows = np.minimum(heads + k, max(len(flat) - 1, 0))
            inner = (np.append(heads[1:], len(flat)) - heads) > k
            raw = np.where(inner, (raw << np.uint64(8)) | flat[follows], raw)
        letters = mix(raw)
        first = np.searchsorted(heads, at)
        n = np.diff(np.append(first, len(heads)))
        owner = np.repeat(np.arange(len(n)), n)
        slots, word = [], []
        for size in GRAMS:
            m = len(letters) - size + 1
            if m <= 0:
                continue
            begin = np.flatnonzero(owner[:m] == owner[size - 1 :])
            total = np.full(len(begin), np.uint64(size))
            for k in range(size):
                total += letters[begin + k] * POSITION[k]
            slots.append(mix(total) >> np.uint64(64 - TABLE_BITS))
            word.append(owner[begin])
        slots.append(mix(words.hashes()) >> np.uint64(64 - TABLE_BITS))
        word.append(np.arange(len(n)))
        self.slot, self.word = np.concatenate(slots).astype(np.int64), np.concatenate(word)
        self.size = np.bincount(self.word, minlength=len(n)).astype(np.float64)


def word_logits(words: Words, table: np.ndarray, bias: float) -> np.ndarray:
    if not len(words):
        return np.zeros(0)
    bags = Bags(words)
    return np.bincount(bags.word, table[bags.slot], len(words)) / bags.size + bias


def windows(count: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, begin and end word of the windows of rows with ``count`` words from ``first``.

    A row of at most WINDOW words is one window; the last window ends with the row.
    """
    steps = np.where(count > 0, 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE)), 0)
    row = np.repeat(np.arange(len(count)), steps)
    k = np.arange(len(row)) - np.repeat(np.cumsum(steps) - steps, steps)
    begin = np.maximum(0, np.minimum(k * STRIDE, count[row] - WINDOW)) + first[row]
    return row, begin, np.minimum(begin + WINDOW, first[row] + count[row])


def top_windows(row: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the TOP highest windows of each row, and how many of them the row has."""
    order = np.lexsort((-score, row))
    first = np.searchsorted(row[order], row[order])
    chosen = order[np.arange(len(order)) - first < TOP]
    return chosen, np.bincount(row[chosen], minlength=int(row.max()) + 1 if len(row) else 0)


def score_rows(words: Words, table: np.ndarray, bias: float) -> np.ndarray:
    """Probability of each row from the mean of its most toxic windows; without words that of the bias."""
    logits = word_logits(words, table, bias)
    row, begin, end = windows(words.count, words.first[:-1])
    sums = np.concatenate(([0.0], np.cumsum(logits)))
    score = (sums[end] - sums[begin]) / np.maximum(end - begin, 1)
    chosen, _ = top_windows(row, score)
    total, n = np.bincount(row[chosen], score[chosen], words.rows), np.bincount(row[chosen], minlength=words.rows)
    mean = np.where(n > 0, total / np.maximum(n, 1), min(bias, -1.0))
    return 1 / (1 + np.exp(-np.clip(mean, -60, 60)))


def train(texts: list[str], counts: list[bytes], toxic: list[int]) -> tuple[np.ndarray, float]:
    """Folded n-gram logits and the bias, from distinct words and their counts as ``_condense`` gives them.

    A window is a word here, so counts say all that the loss takes from a text. With one
    class only, every text gets its prior.
    """
    table = np.zeros(1 << TABLE_BITS)
    label = np.array(toxic, float)
    if not len(label) or label.min() == label.max():
        return table, 4.0 if len(label) and label[0] else -4.0
    batch = pa.record_batch([pa.array(texts, pa.string())], ["text"])
    documents = []  # ids of each document's distinct words
    seen: dict[int, int] = {}
    bag_slots, bag_words = [], []
    for _, _, data, bounds in chunks(batch, limit=CHUNK):
        words = Words(data, bounds)
        if not len(words):
            documents += [np.zeros(0, np.int64)] * words.rows
            continue
        hashes = words.hashes()
        keys, where, ids = np.unique(hashes, return_index=True, return_inverse=True)
        known = np.array([seen.get(h, -1) for h in keys.tolist()])
        new = np.flatnonzero(known < 0)
        known[new] = np.arange(len(new)) + len(seen)
        seen.update(zip(keys[new].tolist(), known[new].tolist(), strict=True))
        if len(new):
            bags = Bags(words)
            number = np.full(len(words), -1, np.int32)
            number[where[new]] = known[new]
            own = number[bags.word]
            bag_slots.append(bags.slot[own >= 0].astype(np.int32))
            bag_words.append(own[own >= 0])
        ids = known[ids]
        documents += [ids[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    if not bag_slots:
        return table, float(np.log(label.mean() / (1 - label.mean())))
    slots, word_of = np.concatenate(bag_slots), np.concatenate(bag_words)
    sizes = np.bincount(word_of, minlength=len(seen))
    tokens, n = np.concatenate(documents), np.frombuffer(b"".join(counts), "<i8")
    times = _gathered(slots, np.bincount(tokens, n, len(sizes)), word_of, 1 << TABLE_BITS)
    used = np.flatnonzero(times)
    place = np.zeros(1 << TABLE_BITS, np.int32)
    place[used] = np.arange(len(used))
    slots = place[slots]
    trust = times[used] / (times[used] + SHRINK)
    # no more than TOP of a document's equal words can be among its TOP windows; these weigh as much as all
    kept = np.minimum(n, TOP)
    count = np.bincount(np.repeat(np.arange(len(documents)), [len(d) for d in documents]), kept, len(documents)).astype(np.int64)
    folded, bias = _fit(label, trust, slots, word_of, sizes, np.repeat(tokens, kept), np.repeat(n / kept, kept), count)
    table[used] = folded
    return table, bias


def _gathered(to: np.ndarray, values: np.ndarray, source: np.ndarray, size: int, block: int = 1 << 20) -> np.ndarray:
    """Sums of ``values[source]`` by ``to``, a block at a time, as the n-grams of all words are many."""
    out = np.zeros(size)
    for at in range(0, len(to), block):
        out += np.bincount(to[at : at + block], values[source[at : at + block]], size)
    return out


def _fit(label, trust, slots, word_of, sizes, tokens, weight, count) -> tuple[np.ndarray, float]:
    """Full-batch gradient descent with momentum on vectors and softmax together; a document's loss is that of its windows.

    A window is one token; in the warm-up, when all windows of a document share its gradient
    by a soft maximum, it counts ``weight`` times. Then its TOP most toxic windows share it.
    """
    row = np.repeat(np.arange(len(count)), count)
    begin, end = np.arange(len(tokens)), np.arange(1, len(tokens) + 1)
    docs, first, steps = np.unique(row, return_index=True, return_counts=True)
    span, inverse = end - begin, 1 / sizes
    rng = np.random.default_rng(5)
    share = min(max(label.mean(), 0.01), 0.99)
    weights = [rng.normal(0, 0.1, (len(trust), DIMENSION)), rng.normal(0, 0.5, DIMENSION), np.array(np.log(share / (1 - share)))]
    moved = [np.zeros_like(w) for w in weights]
    for epoch in range(1, EPOCHS + 1):
        vectors, softmax, bias = weights
        word = _gathered(word_of, vectors @ softmax * trust, slots, len(sizes)) * inverse
        sums = np.concatenate(([0.0], np.cumsum(word[tokens])))
        score = (sums[end] - sums[begin]) / span * SHARPNESS + bias
        if epoch <= WARM_UP:
            spot = weight * np.exp((score - np.repeat(np.maximum.reduceat(score, first), steps)) * 0.5)
            spot /= np.repeat(np.add.reduceat(spot, first), steps)
        else:
            chosen, n = top_windows(row, score)
            spot = np.zeros(len(row))
            spot[chosen] = 1 / n[row[chosen]]
        pooled = np.add.reduceat(score * spot, first)
        miss = np.repeat((1 / (1 + np.exp(-np.clip(pooled, -60, 60))) - label[docs]) / len(docs), steps) * spot
        # back to tokens, words and n-grams
        each = miss / span * SHARPNESS
        delta = np.bincount(begin, each, len(tokens) + 1) - np.bincount(end, each, len(tokens) + 1)
        slot = _gathered(slots, np.bincount(tokens, np.cumsum(delta)[:-1], len(sizes)) * inverse, word_of, len(trust)) * trust
        grads = (slot[:, None] * softmax, slot @ vectors, miss.sum())
        for i, grad in enumerate(grads):
            moved[i] = 0.9 * moved[i] + grad
            weights[i] = weights[i] * (1 - DECAY) - RATES[i] * (1 - epoch / (EPOCHS + 1)) * moved[i]
    vectors, softmax, bias = weights
    return vectors @ softmax * trust * SHARPNESS, float(bias)


@lru_cache(maxsize=2)
def _unpacked(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed, np.float32).astype(np.float64)


def held_out() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == HELD_OUT


def learn(documents: DataFrame, labels: DataFrame) -> tuple[bytes, float]:
    """Train on at most TRAINING_DOCUMENTS labelled documents outside the held-out fold.

    Of several labels of a document the largest counts; null labels and ids don't.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_DOCUMENTS)
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen.withColumn("toxic", F.col("toxic").cast("int"))), "doc_id").select("doc_id", "toxic", "text")
    # of each text its distinct words travel
    sample = sample.mapInArrow(_condense, "doc_id long, toxic int, text string, counts binary")
    # the bounded sample fits one task, which hands back a model of fixed size
    model = sample.repartition(1).mapInArrow(_train, "logits binary, bias double").collect()
    return (bytes(model[0].logits), model[0].bias) if model else _packed(*train([], [], []))


def _packed(table: np.ndarray, bias: float) -> tuple[bytes, float]:
    return table.astype(np.float32).tobytes(), bias


def _condense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as their distinct words in order of first appearance, and how often each occurs."""
    for batch in batches:
        for start, end, data, bounds in chunks(batch, limit=CHUNK):
            words = Words(data, bounds)
            hashes = words.hashes()
            texts, counts = [], []
            for a, b in zip(words.first[:-1], words.first[1:], strict=True):
                _, where, n = np.unique(hashes[a:b], return_index=True, return_counts=True)
                order = np.argsort(where)
                spans = zip(words.starts[a + where[order]], words.ends[a + where[order]], strict=True)
                texts.append(b" ".join(words.data[i:j].tobytes() for i, j in spans))
                counts.append(n[order].astype("<i8").tobytes())
            part = batch.slice(start, end - start)
            yield pa.record_batch([part.column(0), part.column(1), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.binary())], ["doc_id", "toxic", "text", "counts"])


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r["doc_id"], r["text"], r["counts"], r["toxic"]) for b in batches for r in b.to_pylist())
    logits, bias = _packed(*train(*([r[k] for r in rows] for k in (1, 2, 3))))
    del rows
    give_back()
    yield pa.record_batch([pa.array([logits], pa.binary()), pa.array([bias])], ["logits", "bias"])


def _scorer(spark, model: tuple[bytes, float]):
    shared = spark.sparkContext.broadcast(model)

    def score(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        packed, bias = shared.value
        return score_rows(Words(data, bounds, SPACES), _unpacked(packed), bias)

    return score


def score_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``documents``.

    Null and empty texts score as nothing toxic. Without labels of both classes all
    texts get one score. held_out is null for a row without doc_id.
    """
    score = _scorer(documents.sparkSession, learn(documents, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, bounds in chunks(batch, limit=CHUNK):
                yield pa.record_batch([batch.column(0).slice(start, end - start), pa.array(score(data, bounds))], ["doc_id", "score"])

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of ``documents`` scored below 0.5; columns unchanged."""
    score = _scorer(documents.sparkSession, learn(documents, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, bounds in chunks(batch, limit=CHUNK):
                yield batch.slice(start, end - start).filter(pa.array(score(data, bounds) < 0.5))

    return documents.mapInArrow(run, documents.schema)
