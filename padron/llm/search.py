"""Ranked lexical search with hashed max-sketches.

1. Index, independent of queries and of other documents: every document's term counts are
   folded into slots by a hash of the term, each slot keeping the largest count. A
   term's impact grows with its count, so a slot's largest count stands for its largest
   impact, whatever the average length turns out to be. A document gets about eight
   slots for each distinct term.
2. Lookup: for a block of queries at once, each query term reads its slot, and the summed
   impacts are an upper bound of the document's score.
3. The documents of the highest bounds are scored exactly; the 20th best exact score is a
   query's threshold. Every document whose bound reaches a threshold is then scored
   exactly. A document that stays below all of them cannot be among the 20, so the result
   is that of scoring everything.

Texts are never shuffled. Documents to score go to the tasks as a bitmap of fixed size,
which may let more of them be scored, never fewer. Queries go to the tasks in blocks of
bounded size, one after the other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from padron.frames import union_all
from padron.llm.minhash import _SLOT, _bitmap, _in_bitmap, _slot
from padron.llm.words import PUNCTUATION, Words, chunks
from padron.sources.staging import stage

TOP = 20
#: Documents scored for each query to get its threshold; at least TOP.
FIRST = 2 * TOP
SLOTS_PER_TERM = 8
LEAST_SLOTS = 64
#: A slot holds counts below this; from here on the impact is taken to be as large as any.
MANY = 255
SUPREMUM = 1_000_000
#: Bytes of terms and weights of one block of queries. A longer query is a block of its own.
BLOCK_BYTES = 4 << 20
#: Documents looked up or scored at once.
ROWS = 128

SKETCH = "doc_id long, n long, slots binary"


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


# --- index -----------------------------------------------------------------------------


def _slots(hashes: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """Slot of each hash in a sketch of ``size`` slots, a power of two."""
    return ((hashes >> np.uint64(20)) & (np.asarray(size, np.uint64) - np.uint64(1))).astype(np.int64)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, end, data, bounds in chunks(batch):
            words = Words(data, bounds, PUNCTUATION)
            hashes = words.hashes()
            order = np.lexsort((hashes, words.row))
            row, found = words.row[order], hashes[order]
            new = np.ones(len(found), bool)
            new[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
            at = np.flatnonzero(new)
            count = np.minimum(np.diff(np.append(at, len(found))), MANY).astype(np.uint8)
            row, found = row[at], found[at]
            distinct = np.bincount(row, minlength=words.rows)
            wanted = np.maximum(distinct * SLOTS_PER_TERM, LEAST_SLOTS)
            size = 1 << np.ceil(np.log2(wanted)).astype(np.int64)
            ends = np.cumsum(size)
            flat = np.zeros(int(ends[-1]), np.uint8)
            np.maximum.at(flat, (ends - size)[row] + _slots(found, size[row]), count)
            offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64))
            sketches = pa.LargeBinaryArray.from_buffers(pa.large_binary(), words.rows, [None, offsets, pa.py_buffer(flat)])
            yield pa.record_batch([_column(batch, "doc_id").slice(start, end - start), pa.array(words.count.astype(np.int64)), sketches.cast(pa.binary())], ["doc_id", "n", "slots"])


def build_index(texts: DataFrame) -> DataFrame:
    """doc_id, n (terms), slots for every row of ``texts(doc_id, text)``."""
    return stage(texts.mapInArrow(_sketched, SKETCH), "sketches")


# --- queries ---------------------------------------------------------------------------


def _query_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, _, data, bounds in chunks(batch):
            words = Words(data, bounds, PUNCTUATION)
            raw = words.data.tobytes()
            found = [raw[a:b] for a, b in zip(words.starts, words.ends, strict=True)]
            yield pa.record_batch([_column(batch, "query").take(pa.array(words.row + start)), pa.array(found, pa.binary())], ["query", "term"])


class Block:
    """Terms of some queries, and for each query which of them it has how often."""

    def __init__(self, rows: list[tuple[int, bytes, int]]):
        names = sorted({bytes(term) for _, term, _ in rows})
        data = np.frombuffer(b"".join(names), np.uint8)
        bounds = np.concatenate(([0], np.cumsum([len(t) for t in names]))).astype(np.int64)
        hashes = Words(data, bounds, np.zeros(256, bool), lower=False).hashes() if names else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        self.hashes = hashes[order]
        self.starts, self.sizes, self.data = bounds[:-1][order], np.diff(bounds)[order], data
        number = dict(zip(names, place.tolist(), strict=True))
        own: dict[int, list[tuple[int, int]]] = {}
        for query, term, repeats in rows:
            own.setdefault(query, []).append((number[bytes(term)], repeats))
        self.queries = np.array(sorted(own), np.int64)
        self.terms = [np.array([t for t, _ in own[q]], np.int64) for q in sorted(own)]
        self.repeats = [np.array([n for _, n in own[q]], np.int64) for q in sorted(own)]
        self.weights = np.zeros(len(names), np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def found(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) of the words that are terms, compared byte by byte."""
        if not len(self) or not len(words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        hashes = words.hashes()
        term = np.minimum(np.searchsorted(self.hashes, hashes), len(self) - 1)
        word = np.flatnonzero((self.hashes[term] == hashes) & (self.sizes[term] == words.ends - words.starts))
        term = term[word]
        size = self.sizes[term]
        if not len(word):
            return word, term
        first = np.cumsum(size) - size
        step = np.arange(int(size.sum())) - np.repeat(first, size)
        same = words.data[np.repeat(words.starts[word], size) + step] == self.data[np.repeat(self.starts[term], size) + step]
        equal = np.logical_and.reduceat(same, first)
        return word[equal], term[equal]

    def scores(self, impact: np.ndarray) -> np.ndarray:
        """(rows x queries) summed weighted impacts."""
        weighted = np.ascontiguousarray((impact * self.weights).T)
        out = np.zeros((impact.shape[0], len(self.queries)), np.int64)
        for q, (terms, repeats) in enumerate(zip(self.terms, self.repeats, strict=True)):
            out[:, q] = repeats @ weighted[terms]
        return out


def length_norms(n: np.ndarray, documents: int, length: int) -> np.ndarray:
    # whole numbers of any size, as a corpus can have more than 2**53 terms
    return 100 - 25 + np.array([25 * k * documents // length for k in n.tolist()], np.int64)


def impacts(count: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """(rows x terms) impact of counts of terms; 0 where a term does not occur."""
    out = np.zeros(count.shape, np.int64)
    row, term = np.nonzero(count)
    tf = count[row, term].astype(np.int64)
    out[row, term] = (1_000_000_000 * tf) // (1000 * tf + 12 * norms[row])
    return out


def _exact(block: Block, documents: int, length: int, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    words = Words(data, bounds, PUNCTUATION)
    word, term = block.found(words)
    count = np.bincount(words.row[word] * len(block) + term, minlength=words.rows * len(block)).reshape(words.rows, len(block))
    return block.scores(impacts(count, length_norms(words.count, documents, length)))


def _bounds(block: Block, documents: int, length: int, batch: pa.RecordBatch) -> np.ndarray:
    """(rows x queries) upper bounds of the scores from the sketches of a batch."""
    slots = _column(batch, "slots").cast(pa.large_binary())
    _, ends, values = slots.buffers()
    edges = np.frombuffer(ends, np.int64)[slots.offset : slots.offset + len(slots) + 1]
    flat = np.frombuffer(values, np.uint8)
    count = np.zeros((len(slots), len(block)), np.uint8)
    sizes = np.diff(edges)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        count[rows] = flat[edges[rows][:, None] + _slots(block.hashes, int(size))[None, :]]
    norms = length_norms(_column(batch, "n").to_numpy(), documents, length)
    impact = impacts(count, norms)
    impact[count == MANY] = SUPREMUM
    return block.scores(impact)


class _Best:
    """The highest values of each query so far with their documents; equal values by doc_id."""

    def __init__(self, queries: int, size: int):
        self.size = size
        self.values = [np.zeros(0, np.int64)] * queries
        self.ids = [np.zeros(0, np.int64)] * queries

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for q in range(scores.shape[1]):
            own, held = scores[:, q], self.values[q]
            least = held[-1] if len(held) == self.size else 1
            at = np.flatnonzero(own >= least)
            if len(at):
                values, rows = np.concatenate((held, own[at])), np.concatenate((self.ids[q], ids[at]))
                order = np.lexsort((rows, -values))[: self.size]
                self.values[q], self.ids[q] = values[order], rows[order]

    def batch(self, queries: np.ndarray) -> pa.RecordBatch:
        query = np.repeat(queries, [len(v) for v in self.values]) if len(queries) else np.zeros(0, np.int64)
        both = [np.concatenate(x) if len(x) else np.zeros(0, np.int64) for x in (self.ids, self.values)]
        return pa.record_batch([pa.array(query, pa.int64()), pa.array(both[0], pa.int64()), pa.array(both[1], pa.int64())], ["query", "doc_id", "score"])


BEST = "query long, doc_id long, score long"


def _first(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query; each task has handed over ``k`` at most."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


class _Searcher:
    """One block of queries against all documents."""

    def __init__(self, texts: DataFrame, index: DataFrame, block: Block, documents: int, length: int):
        self.texts, self.index = texts, index
        self.documents, self.length = documents, length
        context = texts.sparkSession.sparkContext
        self.block = context.broadcast(block)
        for term, df in self._frequencies():
            block.weights[term] = math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
        self.n_queries = len(block.queries)
        self.block = context.broadcast(block)

    def _frequencies(self) -> list[tuple[int, int]]:
        """(term, documents that hold it) for every term of the block."""
        shared = self.block

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            total = np.zeros(len(block), np.int64)
            for batch in batches:
                for _, _, data, bounds in chunks(batch):
                    words = Words(data, bounds, PUNCTUATION)
                    word, term = block.found(words)
                    held = np.unique(words.row[word] * len(block) + term)
                    total += np.bincount(held % max(len(block), 1), minlength=len(block))
            yield pa.record_batch([pa.array(np.arange(len(block))), pa.array(total)], ["term", "df"])

        counted = self.texts.select("text").mapInArrow(run, "term long, df long")
        return [tuple(r) for r in counted.groupBy("term").agg(F.sum("df")).collect()]  # the terms of one block

    def highest_bounds(self) -> DataFrame:
        """query, doc_id, score: the FIRST highest bounds of each query."""
        shared, documents, length = self.block, self.documents, self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            best = _Best(len(block.queries), FIRST)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    best.add(_column(part, "doc_id").to_numpy(), _bounds(block, documents, length, part))
            yield best.batch(block.queries)

        return _first(self._indexed().mapInArrow(run, BEST), FIRST)

    def reaching(self, thresholds: np.ndarray) -> DataFrame:
        """doc_id of the documents whose bound reaches the threshold of some query."""
        shared, documents, length = self.block, self.documents, self.length

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    able = (_bounds(shared.value, documents, length, part) >= thresholds).any(axis=1)
                    yield pa.record_batch([_column(part, "doc_id").filter(pa.array(able))], ["doc_id"])

        return self._indexed().mapInArrow(run, "doc_id long")

    def _indexed(self) -> DataFrame:
        return self.index.filter("doc_id IS NOT NULL AND n > 0")

    def best(self, ids: DataFrame) -> DataFrame:
        """query, doc_id, score, rank: the TOP best exact scores above 0 of at least the documents in ``ids``."""
        shared, documents, length, wanted = self.block, self.documents, self.length, _bitmap(ids)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = shared.value
            best = _Best(len(block.queries), TOP)
            for batch in batches:
                batch = batch.filter(pa.array(_in_bitmap(wanted.value, batch)))
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    for start, end, data, bounds in chunks(part):
                        best.add(_column(part, "doc_id").slice(start, end - start).to_numpy(), _exact(block, documents, length, data, bounds))
            yield best.batch(block.queries)

        slotted = self.texts.filter("doc_id IS NOT NULL").withColumn(_SLOT, _slot())
        return _first(slotted.mapInArrow(run, BEST), TOP)

    def thresholds(self, found: DataFrame) -> np.ndarray:
        """The TOP-th best score of each query, 1 where fewer documents have been found."""
        held = {r.query: r.score for r in found.filter(F.col("rank") == TOP).collect()}  # one row for each query
        return np.array([held.get(int(q), 1) for q in self.block.value.queries], np.int64)

    def run(self) -> DataFrame:
        first = stage(self.best(self.highest_bounds().select("doc_id").distinct()), "first")
        return stage(self.best(stage(self.reaching(self.thresholds(first)), "reaching")), "best")


def _blocks(terms: DataFrame, limit: int) -> Iterator[Block]:
    """Blocks of whole queries that together hold all terms, each about ``limit`` bytes."""
    size = terms.agg(F.sum(F.length("term") + 24)).first()[0] or 0
    blocks = max(1, -(-size // limit))
    for block in range(blocks):
        part = terms.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block)
        yield Block([tuple(r) for r in part.select("query", "term", "repeats").collect()])


def rank_documents(documents: DataFrame, queries: DataFrame, item: Column | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the 20 best documents of every row of ``queries(item_id, text)``.

    A query row without terms has no result; repeated query rows have equal results. A
    document without doc_id counts in the statistics and is not ranked; rows with equal
    doc_ids are ranked one by one. Null texts have no terms. Other columns of both tables
    are ignored; an empty table on either side gives no rows.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = queries.select((F.col("item_id") if item is None else item).alias("item_id"), F.col("text").cast("string").alias("text"))
    asked = stage(asked.withColumn("query", F.monotonically_increasing_id()), "queries")
    terms = asked.mapInArrow(_query_terms, "query long, term binary").groupBy("query", "term").agg(F.count(F.lit(1)).alias("repeats"))
    terms = stage(terms, "query-terms")
    index = build_index(texts)
    n, length = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    found = [_Searcher(texts, index, block, n, length).run() for block in _blocks(terms, block_bytes) if length and len(block)]
    if not found:
        return asked.filter("false").select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    best = union_all(found)
    return best.join(asked.select("query", "item_id"), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
