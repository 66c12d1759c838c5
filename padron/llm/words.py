"""Word splitting over whole Arrow batches with numpy, for operators that run in tasks.

Texts are read as UTF-8 bytes straight from the Arrow buffers. Bytes above 0x7F never
separate words, so every byte class used here agrees with the code point class.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_BYTES = np.arange(256)
#: Separators of `[^\x20\x09-\x0D]+` words.
SPACES = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
#: Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` words, after lower-casing.
PUNCTUATION = (_BYTES < 0x30) | ((_BYTES > 0x39) & (_BYTES < 0x61)) | ((_BYTES > 0x7A) & (_BYTES < 0x80))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 0x20, _BYTES).astype(np.uint8)

_rng = np.random.default_rng(20_240_501)
_BYTE_CODE = _rng.integers(0, 2**64, 256, np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
POSITION = _rng.integers(0, 2**64, 64, np.uint64) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    h = (h ^ (h >> np.uint64(30))) * _MIX1
    h = (h ^ (h >> np.uint64(27))) * _MIX2
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(size: int) -> np.ndarray:
    out = np.full(size, _ODD)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    return _powers(max(64, 1 << max(n - 1, 1).bit_length()))


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(first row, end row, bytes, row bounds) over runs of rows with about ``limit`` bytes.

    A longer text makes a chunk of its own; nulls read as empty texts.
    """
    texts = batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    _, ends, values = texts.buffers()
    bounds = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1)
        yield row, end, data[bounds[row] : bounds[end]], bounds[row : end + 1] - bounds[row]
        row = end


class Words:
    """Words of the rows of one chunk: ``starts``, ``ends`` (bytes) and ``row``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, separators: np.ndarray = SPACES, lower: bool = True):
        self.data = LOWER[data] if lower else data
        self.bounds, self.rows = bounds, len(bounds) - 1
        inside = ~separators[self.data]
        n = len(inside)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        edges = bounds[(bounds > 0) & (bounds < n)]
        before[edges] = False
        after[edges - 1] = False
        self.inside = inside
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.row = np.searchsorted(bounds, self.starts, "right") - 1
        #: word index of the first word of each row, and one past the last row's words
        self.first = np.searchsorted(self.starts, bounds)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word's bytes."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        length = self.ends - self.starts
        at = np.cumsum(length) - length
        place = np.arange(int(length.sum())) - np.repeat(at, length)
        codes = _BYTE_CODE[self.data[self.inside]] * powers(int(length.max()) + 1)[place]
        return mix(np.add.reduceat(codes, at) + length.astype(np.uint64) * _ODD)

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of every run of ``size`` words within a row."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.row[:n] == self.row[size - 1 :])
        total = np.full(len(at), np.uint64(size))
        for k in range(size):
            total += hashes[at + k] * POSITION[k]
        return at, mix(total)


def code_points(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Code points in each of the byte ranges between ``bounds``."""
    head = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    return np.diff(head[bounds])


def per_row(rows: int, row: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    out = np.bincount(row, weight, rows)
    return out if weight is not None else out.astype(np.int64)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after a large task, next to others' tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)
