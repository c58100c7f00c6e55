"""Hashes of words and shingles, a whole Arrow batch at a time.

A word is a run of bytes other than space and the control characters 9 to 13; A-Z count as a-z.
Word hashes are 64 bits wide: a polynomial over random values of the bytes, mixed. They depend on
the bytes alone, so every task and every run agrees on them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The same words for Spark's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Bytes of text whose positions are held as 64-bit numbers at a time.
CHUNK = 1 << 19

_rng = np.random.default_rng(20)
_VALUE = _rng.integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[ord("A") : ord("Z") + 1] = _VALUE[ord("a") : ord("z") + 1]
_IN_WORD = np.ones(256, bool)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = False
_BASE = 0x9E3779B97F4A7C13  # congruent to 3 modulo 8
_UNBASE = pow(_BASE, -1, 1 << 64)
_FOLD = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    if base not in _powers or len(_powers[base]) < n:
        steps = np.full(max(n, CHUNK + 1), base, np.uint64)
        steps[0] = 1
        _powers[base] = np.cumprod(steps)
    return _powers[base][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(batch: pa.RecordBatch, limit: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about ``limit`` bytes, a row at least; memory of the batch is returned after the last."""
    step = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
    for k in range(0, batch.num_rows, step):
        yield batch.slice(k, step)
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the n + 1 bounds of its rows; null counts as empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = pc.fill_null(array, "").cast(pa.large_binary())
    bounds = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def word_bounds(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of every word, and the number of words of every row."""
    inside = _IN_WORD[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = bounds[1:][bounds[1:] > 0] - 1
    last[edges] = inside[edges]
    starts = np.flatnonzero(first)
    per_row = np.diff(np.searchsorted(starts, bounds))
    return starts, np.flatnonzero(last) + 1, per_row


def word_hashes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a text column, in order, and the number of words of every row."""
    data, bounds = text_bytes(column)
    starts, ends, per_row = word_bounds(data, bounds)
    hashes = np.empty(len(starts), np.uint64)
    k = 0
    while k < len(starts):
        begin = starts[k]
        stop = max(k + 1, int(np.searchsorted(ends, begin + CHUNK, "right")))
        piece = data[begin : ends[stop - 1]]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_VALUE[piece] * powers(_BASE, len(piece)), out=sums[1:])
        at = starts[k:stop] - begin
        hashes[k:stop] = (sums[ends[k:stop] - begin] - sums[at]) * powers(_UNBASE, len(piece))[at]
        k = stop
    return mix(hashes), per_row


def fold(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of ``width`` neighbours."""
    n = max(0, len(hashes) - width + 1)
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = (out + hashes[j : j + n]) * _FOLD
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_sets(column: pa.Array | pa.ChunkedArray, width: int):
    """For each row its distinct shingles, sorted.

    A row with fewer words than ``width`` has its whole sequence as one shingle; a row without
    words has none.
    """
    hashes, per_row = word_hashes(column)
    whole = fold(hashes, width)
    begin = 0
    for n in per_row.tolist():
        if n >= width:
            yield np.unique(whole[begin : begin + n - width + 1])
        else:
            yield fold(hashes[begin : begin + n], n) if n else hashes[:0]
        begin += n
