"""Vectorised hashing of Arrow text columns, for use inside tasks.

Texts of a batch are handled in groups of a few megabytes; every function works
on the UTF-8 bytes of a group and returns numpy arrays, so that cost per byte
stays flat and memory per task is bounded by the group (or the longest text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 20

_RNG = np.random.default_rng(20240607)
_BYTE_CODES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            out, size = np.ones(1, np.uint64), 1
            while size < n:  # doubling: p[i + size] = p[i] * base**size
                out = np.concatenate([out, out * np.uint64(pow(base, size, 1 << 64))])
                size *= 2
            _POWERS[k] = out
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values; a bijection."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Rolling:
    """Hashes of any substrings of one byte array, from prefix sums."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _powers(len(data) + 1)
        terms = _BYTE_CODES[data]
        terms *= power[: len(data)]
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self._sums[1:])

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of ``data[start:end]`` for arrays of bounds."""
        h = self._sums[end] - self._sums[start]
        h *= self._inverse[start]
        return mix(h + (end - start).astype(np.uint64))

    def windows(self, k: int) -> np.ndarray:
        """Mixed hash of every ``k`` bytes in a row."""
        n = len(self._sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        h = self._sums[k:] - self._sums[:n]
        h *= self._inverse[:n]
        return mix(h)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text or binary column; null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), at


def groups(column: pa.Array, group_bytes: int = GROUP_BYTES):
    """Yields (first row, last row + 1, bytes, offsets from 0) of row groups."""
    data, at = text_buffers(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(at, at[row] + group_bytes, "right")) - 1)
        yield row, end, data[at[row]: at[end]], at[row: end + 1] - at[row]
        row = end


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the blank-separated words, A-Z lower-cased, and words per text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(at) - 1, np.int64)
    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)  # a text starts or ends here
    edge[at] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    hashes = Rolling(_LOWER[data]).spans(starts, ends)
    bounds = np.searchsorted(starts, at)
    return hashes, np.diff(bounds)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k`` words in a row per text, repeats included, and how many.

    A text with fewer words, but not none, has one: its whole word sequence.
    """
    ends = np.cumsum(counts)
    starts = ends - counts
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.uint64), n
    owner = np.repeat(np.arange(len(counts)), n)
    first = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + starts[owner]
    length = np.minimum(counts, k)[owner]
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    out = length.astype(np.uint64)
    for j in range(k):
        out = np.where(j < length, mix(out + padded[first + j]), out)
    return out, n
