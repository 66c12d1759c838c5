"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Items become windows of ten words, a shorter item one window. Windows are the patterns
of an automaton over normalised text: lower-cased words, each followed by one space.
A chunk of documents is normalised once and scanned once; pattern ends map back to
words, and words to byte and code point offsets of the original text.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm.words import PUNCTUATION, Words, chunks, per_row
from padron.sources.staging import stage

WINDOW = 10
#: Bytes of window text in one automaton. A larger benchmark is scanned in several blocks.
AUTOMATON_BYTES = 16 << 20

HITS = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, spans array<struct<start:long,end:long>>"


def normalised(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every word followed by a space, and where each word ends; rows start with a line break."""
    length = words.ends - words.starts + 1
    opens = words.count > 0
    firsts = words.first[:-1][opens]
    extra = np.zeros(len(length), np.int64)
    extra[firsts] = 1
    ends = np.cumsum(length + extra)
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    begin = ends - length
    out[begin[firsts] - 1] = 0x0A
    size = length - 1
    at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    out[at] = words.data[words.inside]
    return out, ends


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("item_id"))
        for start, end, data, bounds in chunks(batch):
            words = Words(data, bounds, PUNCTUATION)
            text, ends = normalised(words)
            text = text.tobytes()
            rows, found = [], []
            for row in range(end - start):
                a, n = int(words.first[row]), int(words.count[row])
                for k in range(max(0, n - WINDOW) + 1 if n else 0):
                    last = min(a + n, a + k + WINDOW) - 1
                    begin = ends[a + k] - (words.ends[a + k] - words.starts[a + k]) - 1
                    rows.append(start + row)
                    found.append(text[begin : ends[last]])
            yield pa.record_batch([ids.take(pa.array(rows, pa.int64())), pa.array(found, pa.binary())], ["item_id", "window"])


def _automaton(windows: dict[bytes, list[str]]) -> ahocorasick.Automaton:
    """Latin-1 views of UTF-8 bytes: one character for each byte, so offsets are byte offsets."""
    automaton = ahocorasick.Automaton()
    for window, items in windows.items():
        for lead in (" ", "\n"):
            automaton.add_word(lead + window.decode("latin-1"), (window.count(b" "), items))
    automaton.make_automaton()
    return automaton


_held: dict[str, ahocorasick.Automaton] = {}


class Scanner:
    """Ships the windows once and builds the automaton once in each Python worker."""

    def __init__(self, spark: SparkSession, windows: dict[bytes, list[str]]):
        self.shared = spark.sparkContext.broadcast(windows)
        self.name = hashlib.sha256(repr(sorted(windows.items())).encode()).hexdigest()

    def matches(self, words: Words) -> tuple[list[int], list[int], list[list[str]]]:
        """First word, last word and items of every occurrence of a window."""
        if self.name not in _held:
            _held.clear()
            _held[self.name] = _automaton(self.shared.value)
        text, ends = normalised(words)
        if not len(_held[self.name]):
            return [], [], []
        found = list(_held[self.name].iter(text.tobytes().decode("latin-1")))
        last = np.searchsorted(ends, [end + 1 for end, _ in found]).tolist()
        return [w - size + 1 for w, (_, (size, _)) in zip(last, found, strict=True)], last, [items for _, (_, items) in found]


def _hit(words: Words, first: list[int], last: list[int]) -> np.ndarray:
    delta = np.zeros(len(words) + 1, np.int64)
    np.add.at(delta, np.array(first, np.int64), 1)
    np.add.at(delta, np.array(last, np.int64) + 1, -1)
    return np.cumsum(delta[:-1]) > 0


def _report(ids: pa.Array, words: Words, first: list[int], last: list[int], names: list[list[str]]) -> pa.RecordBatch:
    hit = _hit(words, first, last)
    items: dict[int, set[str]] = defaultdict(set)
    for word, found in zip(first, names, strict=True):
        items[int(words.row[word])].update(found)
    digest = [hashlib.sha256(",".join(sorted(items.get(r, ()))).encode()).hexdigest() for r in range(words.rows)]
    return pa.record_batch(
        [
            ids,
            pa.array(words.count.astype(np.int64)),
            pa.array(per_row(words.rows, words.row, hit).astype(np.int64)),
            pa.array([len(items.get(r, ())) for r in range(words.rows)], pa.int64()),
            pa.array(digest),
            pa.array(_spans(words, hit), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ],
        ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "spans"],
    )


def _spans(words: Words, hit: np.ndarray) -> list[list[dict]]:
    """Runs of hit words of each row as code point offsets of the original text, end exclusive."""
    out: list[list[dict]] = [[] for _ in range(words.rows)]
    if not hit.any():
        return out
    heads = np.concatenate(([0], np.cumsum((words.data & 0xC0) != 0x80)))
    before, after = np.zeros(len(hit), bool), np.zeros(len(hit), bool)
    before[1:] = hit[:-1] & (words.row[1:] == words.row[:-1])
    after[:-1] = hit[1:] & (words.row[1:] == words.row[:-1])
    for a, b in zip(np.flatnonzero(hit & ~before), np.flatnonzero(hit & ~after), strict=True):
        row = int(words.row[a])
        base = heads[words.bounds[row]]
        out[row].append({"start": int(heads[words.starts[a]] - base), "end": int(heads[words.ends[b]] - base)})
    return out


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _automata(benchmark: DataFrame, limit: int) -> Iterator[Scanner]:
    """Scanners that together hold every window; one where the windows fit the limit."""
    items = benchmark.filter("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    windows = items.mapInArrow(_windows, "item_id string, window binary").distinct()
    size = windows.agg(F.sum(F.length("window") + F.length("item_id"))).first()[0] or 0
    blocks = max(1, -(-size // limit))
    if blocks > 1:
        windows = stage(windows, "windows")
    for block in range(blocks):
        part = windows.filter(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        found = defaultdict(list)
        for row in part.orderBy("window", "item_id").collect():
            found[bytes(row.window)].append(row.item_id)
        yield Scanner(benchmark.sparkSession, dict(found))


def find_contamination(documents: DataFrame, benchmark: DataFrame, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans for every row of ``documents``.

    Null texts have no words. Items without an id or without words match nothing; items
    with equal ids count once. An empty benchmark leaves every document clean. Other
    columns of either table are ignored.

    Windows reach the driver only in blocks whose text, summed up before, is about
    ``automaton_bytes``; usually there is one. Occurrences found by several automata are
    put together for each document before its words are counted.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scanners = _automata(benchmark, automaton_bytes)
    scanner, more = next(scanners), list(scanners)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, bounds in chunks(batch):
                words = Words(data, bounds, PUNCTUATION)
                yield _report(_column(batch, "doc_id").slice(start, end - start), words, *scanner.matches(words))

    report = texts.mapInArrow(scan, HITS) if not more else _together(texts, [scanner, *more])
    return report.withColumn("contaminated", F.col("n_hit") > 0)


def _together(texts: DataFrame, scanners: list[Scanner]) -> DataFrame:
    keyed = texts.withColumn("key", F.xxhash64("doc_id", "text"))

    def find(scanner: Scanner):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, _, data, bounds in chunks(batch):
                    words = Words(data, bounds, PUNCTUATION)
                    first, last, names = scanner.matches(words)
                    row = words.row[np.array(first, np.int64)]
                    base = words.first[row]
                    yield pa.record_batch(
                        [_column(batch, "key").take(pa.array(row + start)), pa.array(np.array(first, np.int64) - base), pa.array(np.array(last, np.int64) - base), pa.array(names, pa.list_(pa.string()))],
                        ["key", "first", "last", "items"],
                    )

        return scan

    schema = "key long, first long, last long, items array<string>"
    found = None
    for scanner in scanners:
        part = keyed.mapInArrow(find(scanner), schema)
        found = part if found is None else found.union(part)
    found = found.distinct().groupBy("key").agg(F.collect_list(F.struct("first", "last", "items")).alias("found"))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, data, bounds in chunks(batch):
                words = Words(data, bounds, PUNCTUATION)
                first, last, names = [], [], []
                for row, hits in enumerate(_column(batch, "found").slice(start, end - start).to_pylist()):
                    for hit in hits or ():
                        first.append(int(words.first[row]) + hit["first"])
                        last.append(int(words.first[row]) + hit["last"])
                        names.append(hit["items"])
                yield _report(_column(batch, "doc_id").slice(start, end - start), words, first, last, names)

    return keyed.join(found, "key", "left").mapInArrow(report, HITS)


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """Rows of ``documents`` without an occurrence of any window; columns unchanged."""

    def clean(scanner: Scanner):
        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start, end, data, bounds in chunks(batch):
                    words = Words(data, bounds, PUNCTUATION)
                    first, _, _ = scanner.matches(words)
                    keep = np.ones(end - start, bool)
                    keep[words.row[np.array(first, np.int64)]] = False
                    yield batch.slice(start, end - start).filter(pa.array(keep))

        return scan

    for scanner in _automata(benchmark, automaton_bytes):
        documents = documents.mapInArrow(clean(scanner), documents.schema)
    return documents
