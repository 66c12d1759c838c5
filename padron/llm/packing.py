"""Token ids packed into fixed-length rows by best-fit decreasing.

A task tokenises its documents, collects about ``GROUP_TOKENS`` of them, and packs: pieces
go, longest first, into the row with the least room that still holds them. Rows are found
by their room in a segment tree over capacities. A document longer than a row is split
without loss into pieces of a full row and a rest.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vocabulary file (one base64 token and its id a line); every executor has it installed.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed pattern of that vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
END_ID = 50256
ROW_TOKENS = 2048
GROUP_TOKENS = 4 << 20
PACKED = "n_tokens int, ids binary, cu_seqlens array<int>, doc_ids array<long>, pieces array<int>"


class Room:
    """Open rows by their room: a segment tree over 0..capacity that counts rows."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        node = room + self.leaves
        while node:
            self.tree[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Room and number of a row with the least room that is at least ``least``."""
        node = least + self.leaves
        if not self.tree[node]:
            while node > 1 and (node & 1 or not self.tree[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.tree[2 * node] else 2 * node + 1
        room = node - self.leaves
        while node:
            self.tree[node] -= 1
            node >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Items of each row; items are placed longest first, equal ones in their order."""
    rows: list[list[int]] = []
    room = Room(capacity)
    for item in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = room.take(lengths[item])
        if found is None:
            found = capacity, len(rows)
            rows.append([])
        left, row = found
        rows[row].append(item)
        if left > lengths[item]:
            room.add(left - lengths[item], row)
    return rows


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Token ids of a text, END_ID last."""
    import tiktoken

    lines = Path(path).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
    encoding = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: np.append(encoding.encode_to_numpy(text, disallowed_special=()), np.uint32(END_ID))


def _packed(ids: list[np.ndarray], names: list, capacity: int) -> pa.RecordBatch:
    """Rows of a group of documents."""
    pieces = [(d, k, k * capacity, min(len(x), (k + 1) * capacity)) for d, x in enumerate(ids) for k in range(-(-len(x) // capacity))]
    rows = best_fit([b - a for _, _, a, b in pieces], capacity)
    out = {name: [] for name in ("n_tokens", "ids", "cu_seqlens", "doc_ids", "pieces")}
    for row in rows:
        own = [pieces[i] for i in row]
        flat = np.concatenate([ids[d][a:b] for d, _, a, b in own])
        out["n_tokens"].append(len(flat))
        out["ids"].append(flat.astype("<u4" if flat.max() > 0xFFFF else "<u2").tobytes())
        out["cu_seqlens"].append(np.cumsum([0] + [b - a for _, _, a, b in own]).tolist())
        out["doc_ids"].append([names[d] for d, *_ in own])
        out["pieces"].append([k for _, k, _, _ in own])
    kinds = [pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32())]
    return pa.record_batch([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


def pack_documents(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = ROW_TOKENS, group: int = GROUP_TOKENS) -> DataFrame:
    """One row for each packed row of tokens: n_tokens, ids, cu_seqlens, doc_ids, pieces.

    ``ids`` are little-endian 16-bit numbers, 32-bit where a row holds a larger id.
    ``cu_seqlens`` are the bounds of its segments, at which positions start again;
    ``doc_ids`` and ``pieces`` tell whose piece each segment is. Null and empty texts are
    a lone end token. Repeated rows are packed as often as they occur; other columns are
    ignored; an empty table gives no rows. No shuffle: rows hold documents of one task.
    """

    return _texts(documents).mapInArrow(lambda batches: _rows(batches, tokenizer, capacity, group), PACKED)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))


def _rows(batches: Iterator[pa.RecordBatch], tokenizer: str, capacity: int, group: int) -> Iterator[pa.RecordBatch]:
    encode, ids, names, held = encoder(tokenizer), [], [], 0
    for batch in batches:
        for name, text in zip(*(batch.column(i) for i in (0, 1)), strict=True):
            ids.append(encode(text.as_py() or ""))
            names.append(name.as_py())
            held += len(ids[-1])
            if held >= group:
                yield _packed(ids, names, capacity)
                ids, names, held = [], [], 0
    if ids:
        yield _packed(ids, names, capacity)


#: A Parquet writer looks at its page's size after so many rows, at first and between looks.
#: By default it is 100, which holds 50 MB of matrices in a page, and as much again twice to compress it.
PAGE_CHECK = {"parquet.page.size.row.check.min": "1"}
MATRICES = "n_rows int, matrix binary, positions binary, cu_seqlens array<array<int>>, doc_ids array<long>, pieces array<int>"


def matrices(packed: DataFrame, rows: int = 64, capacity: int = ROW_TOKENS, pad: int = END_ID) -> DataFrame:
    """Blocks of up to ``rows`` packed rows: n_rows, matrix, positions, cu_seqlens, doc_ids, pieces.

    ``matrix`` and ``positions`` are row-major little-endian 32-bit (n_rows x capacity);
    positions count from 0 in every segment, padding is a segment of its own. ``doc_ids``
    and ``pieces`` tell whose piece each segment is, row after row.
    """
    return packed.mapInArrow(lambda batches: _stacked(batches, rows, capacity, pad), MATRICES)


def pack_matrices(documents: DataFrame, tokenizer: str = TOKENIZER, capacity: int = ROW_TOKENS, group: int = GROUP_TOKENS, rows: int = 64) -> DataFrame:
    """``matrices`` of ``pack_documents``, made where the rows are packed.

    A row holds a MB, so the session's Parquet writers are told to look at page sizes after
    each row; this changes where pages end, no rows.
    """
    for key, value in PAGE_CHECK.items():
        documents.sparkSession.conf.set(key, value)
    return _texts(documents).mapInArrow(lambda batches: _stacked(_rows(batches, tokenizer, capacity, group), rows, capacity, END_ID), MATRICES)


def _stacked(batches: Iterator[pa.RecordBatch], rows: int, capacity: int, pad: int) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.int64()), pa.list_(pa.int32())]
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows).to_pylist()
            matrix = np.full((len(part), capacity), pad, "<i4")
            places = np.zeros((len(part), capacity), "<i4")
            for i, r in enumerate(part):
                flat = read_ids(r["ids"], r["n_tokens"])
                matrix[i, : len(flat)] = flat
                places[i] = position_ids(r["cu_seqlens"], capacity)
            flat = lambda name: [x for r in part for x in r[name]]
            values = [len(part), matrix.tobytes(), places.tobytes(), [r["cu_seqlens"] for r in part], flat("doc_ids"), flat("pieces")]
            yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], ["n_rows", "matrix", "positions", "cu_seqlens", "doc_ids", "pieces"])


def read_ids(ids: bytes, n_tokens: int) -> np.ndarray:
    return np.frombuffer(ids, f"<u{len(ids) // n_tokens}").astype(np.int64)


def position_ids(cu_seqlens: list[int], capacity: int) -> np.ndarray:
    """Position of each token of a row, from 0 in every segment."""
    bounds = np.array([*cu_seqlens, capacity])
    bounds = bounds[np.append(True, np.diff(bounds) > 0)]
    return np.arange(capacity) - np.repeat(bounds[:-1], np.diff(bounds))
