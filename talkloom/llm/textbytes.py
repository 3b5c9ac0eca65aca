"""Whole columns of text as one byte buffer: words, their hashes and five-word shingles in numpy.

Everything works on slices of an Arrow batch, so memory is bounded by a slice (or by
one document where that is longer), and no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
SHINGLE_WORDS = 5

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: a bijection that spreads every bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, U)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    out = _powers[0][:n], _powers[1][:n]
    if n > 8 * SLICE_BYTES:  # do not hold on to the tables of one very long text
        _powers[:] = [np.ones(1, U), np.ones(1, U)]
    return out


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch of about ``size`` text bytes: (rows, bytes, offsets). One row at least, never part of a row."""
    data, off = text_buffer(batch.column(text))
    at, rows = 0, batch.num_rows
    while at < rows:
        to = max(at + 1, int(np.searchsorted(off, off[at] + size, "right")) - 1)
        yield batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at]
        at = to


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts of a slice, A-Z lower-cased if asked.

    ``start``, ``end``: byte places; ``hash``: 64 bits per word; words of text k are
    ``bound[k]:bound[k + 1]``.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, lower: bool = True):
        self.data = data
        n = len(data)
        if n == 0:
            self.start = self.end = np.zeros(0, np.int64)
            self.hash = np.zeros(0, U)
            self.bound = np.zeros(len(off), np.int64)
            return
        space = _SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        before = edge[:-1].copy()
        before[1:] |= space[:-1]
        after = edge[1:].copy()
        after[:-1] |= space[1:]
        self.start = np.flatnonzero(before & ~space)
        self.end = np.flatnonzero(after & ~space) + 1
        self.bound = np.searchsorted(self.start, off)
        up, down = powers(n)
        self._total = np.zeros(n + 1, U)
        np.cumsum((_LOWER if lower else _SAME)[data].astype(U) * up + up, out=self._total[1:])
        self._down = down
        self.hash = self.span_hash(self.start, self.end)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64 bits per stretch of bytes; equal stretches anywhere have equal hashes."""
        if not len(start):
            return np.zeros(0, U)
        raw = (self._total[end] - self._total[start]) * self._down[np.minimum(start, len(self._down) - 1)]
        return mix(raw + (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    def count(self) -> np.ndarray:
        return np.diff(self.bound)

    def doc(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.bound) - 1), np.diff(self.bound))

    def word(self, i: int) -> bytes:
        return _LOWER[self.data[self.start[i] : self.end[i]]].tobytes()


_PLACES = [U((0xC2B2AE3D27D4EB4F * (2 * i + 3) + 0x165667B19E3779F9 * i) & 0xFFFFFFFFFFFFFFFF | 1) for i in range(SHINGLE_WORDS)]


def run_hash(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` (at most five) neighbouring words."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.full(n, length, U)
    for i in range(length):
        total += hashes[i : i + n] * _PLACES[i]
    return mix(total)


def shingle_sets(words: Words, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text: ``width`` (at most five) words, or the whole sequence of fewer."""
    runs = run_hash(words.hash, width)
    for a, b in zip(words.bound[:-1].tolist(), words.bound[1:].tolist()):
        if b - a >= width:
            yield np.unique(runs[a : b - width + 1])
        else:
            yield run_hash(words.hash[a:b], b - a) if b > a else np.zeros(0, U)
