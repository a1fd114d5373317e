"""Vectorised text kernels shared by the corpus operators.

Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``; these separators
are ASCII, so splitting the UTF-8 bytes splits the text exactly.  A batch is
handled as one byte array, cut into blocks of bounded size, and every word gets
a 64-bit hash, so no Python object is made per word.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 20

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_pow = np.ones(1, dtype=np.uint64)


#: rows of texts that a worker turns into its own objects at a time
SLICE = 1024


def sliced(run):
    """run over slices of SLICE rows of its batches; freed memory goes back to the system at the end of a task.

    A worker lives on between tasks, beside an executor's memory.
    """

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, SLICE):
                yield batch.slice(k, SLICE)

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(slices(batches))
        finally:
            release()

    return wrapped


def release() -> None:
    """Give freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def _powers(n: int) -> np.ndarray:
    global _pow
    if len(_pow) < n:
        grown = np.full(max(n, 2 * len(_pow), 1024), _BASE, dtype=np.uint64)
        grown[0] = 1
        _pow = np.multiply.accumulate(grown)
    return _pow


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) with about `size` bytes in each; one row is never cut."""
    raw, at = text_bytes(column)
    n, i = len(at) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + size, side="right")) - 1)
        j = min(j, n)
        yield i, j, raw[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the n + 1 word offsets of the rows."""
    solid = ~_SEPARATOR[raw]
    if not len(raw):
        zero = np.zeros(0, np.int64)
        return zero, zero, np.zeros(len(at), np.int64)
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    edge = at[:-1][at[:-1] < at[1:]]
    first[edge] = solid[edge]
    edge = at[1:][at[:-1] < at[1:]] - 1
    last[edge] = solid[edge]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def hash_words(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    if lower:
        raw = _LOWER[raw]
    length = ends - starts
    begin = np.cumsum(length) - length
    inside = np.arange(int(length.sum()), dtype=np.int64) - np.repeat(begin, length)
    source = inside + np.repeat(starts, length)
    value = _BYTE[raw[source]] * _powers(int(length.max()))[inside]
    return mix64(np.add.reduceat(value, begin) + length.astype(np.uint64))


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all n-word windows of a word sequence (row borders are the caller's)."""
    m = max(0, len(h) - n + 1)
    out = h[:m].copy()
    for k in range(1, n):
        out = mix64(out * U64(0xD6E8FEB86659FD93) + h[k : k + m])
    return out


def whole(h: np.ndarray) -> np.ndarray:
    """One hash for a sequence that is shorter than a window."""
    out = U64(len(h)) + np.zeros(1, np.uint64)
    for x in h:
        out = mix64(out * U64(0xD6E8FEB86659FD93) + x)
    return out


def shingle_sets(column: pa.Array, n: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Row by row the sorted distinct hashes of its n-word shingles.

    With fewer than n words the whole sequence is the one shingle; a text
    without words, and a null, has the empty set.
    """
    for _, _, raw, at in blocks(column):
        starts, ends, words = word_spans(raw, at)
        h = hash_words(raw, starts, ends, lower)
        grams = chain(h, n)
        for a, b in zip(words[:-1].tolist(), words[1:].tolist(), strict=True):
            if b - a >= n:
                yield np.unique(grams[a : b - n + 1])
            elif b > a:
                yield whole(h[a:b])
            else:
                yield h[:0]
