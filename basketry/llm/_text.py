"""NumPy helpers over the byte buffers of Arrow text batches; each task works on a few megabytes at a time."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
#: bytes that are hashed at a time: their 64-bit sums stay in the cache
HASHED = 1 << 15
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_VALUES = {True: _LOWER.astype(np.uint64) + np.uint64(1), False: np.arange(1, 257, dtype=np.uint64)}
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, on unsigned 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes, or of one row."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, outside: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of bytes that are not ``outside`` (white space: space, tab to carriage return)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~outside[data]
    begins, finishes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    finishes[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    edge = offsets[:-1][full]
    begins[edge] = inside[edge]
    edge = offsets[1:][full] - 1
    finishes[edge] = inside[edge]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(offsets[1:], starts, "right")
    return starts, np.flatnonzero(finishes) + 1, rows


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers.get(name, ())) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[name] = np.multiply.accumulate(steps)
    return _powers[name]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word (A-Z lower-cased first): differences of a running polynomial sum."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + HASHED, "right")))
        lo, hi = int(starts[first]), int(ends[last - 1])
        part = _VALUES[lower].take(data[lo:hi])
        part *= _power("up", _BASE, len(part))[: len(part)]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part, out=sums[1:])
        a, b = starts[first:last] - lo, ends[first:last] - lo
        out[first:last] = mix(
            (sums[b] - sums[a]) * _power("down", _INVERSE, len(part))[a] + (b - a).astype(np.uint64)
        )
        first = last
    return out


def give_back() -> None:
    """Hand freed memory back to the system; a worker lives on between tasks, next to those of later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # a C library of another kind
        pass


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` for all i, one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
