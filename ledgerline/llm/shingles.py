"""Vectorised word and shingle hashing over Arrow string columns.

Words are maximal runs without the ASCII white space bytes 0x09-0x0D and 0x20,
compared after lower-casing A-Z.  A word's 64-bit hash is a polynomial in its
bytes, taken for a whole slice of texts at once; a shingle's hash mixes the
hashes of its words with their places.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import slices

_rng = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE[_SPACE] = 0
_BYTE[65:91] = _BYTE[97:123]
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_POWERS = {"n": 0, "up": np.zeros(0, np.uint64), "down": np.zeros(0, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POWERS["n"] < n:
        n = max(n, 1 << 20)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[key] = np.multiply.accumulate(steps)
        _POWERS["n"] = n
    return _POWERS["up"], _POWERS["down"]


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for slices of a string column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for lo, hi in slices(np.diff(offsets).tolist()):
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word and the end) of a slice."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    gap = _SPACE[data]
    start = ~gap
    start[1:] &= gap[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    start[first] |= ~gap[first]
    at = np.flatnonzero(start)
    up, down = _powers(len(data))
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    sums = np.add.reduceat(_BYTE[data] * up[:len(data)], at)
    return mix(sums * down[at]), np.searchsorted(at, offsets)


def hash_shingles(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``width`` words, bounds by text); a shorter text is one shingle, an empty one none."""
    counts = np.diff(bounds)
    n = len(words)
    runs = np.maximum(counts - width + 1, (counts > 0).astype(np.int64))
    out_bounds = np.concatenate([[0], np.cumsum(runs)])
    full = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        full += (words[k:k + len(full)] + np.uint64(k + 1)) * _PLACE[k]
    full = mix(full ^ _PLACE[width])
    out = np.zeros(int(out_bounds[-1]), np.uint64)
    long = np.flatnonzero(counts >= width)
    if len(long):
        steps = runs[long]
        from .common import int_ranges

        out[int_ranges(out_bounds[long], steps)] = full[int_ranges(bounds[long], steps)]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        w = words[bounds[i]:bounds[i + 1]]
        total = np.uint64((np.sum((w + np.uint64(1)) * _PLACE[:len(w)], dtype=np.uint64)))
        out[out_bounds[i]] = mix(np.array([total ^ _PLACE[32 + len(w)]], np.uint64))[0]
    return out, out_bounds


def distinct_by_text(values: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
    """Sorted distinct values of each text."""
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo < 2:
            yield values[lo:hi]
            continue
        part = np.sort(values[lo:hi])
        keep = np.ones(len(part), bool)
        np.not_equal(part[1:], part[:-1], out=keep[1:])
        yield part[keep]
