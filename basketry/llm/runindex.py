"""A run-length index over byte strings in NumPy: run-compressed Burrows-Wheeler transform, sampled run ends, matching statistics.

The strings ("rows") are laid out one after the other, each closed by a terminator that sorts first; equal terminators
sort by place. Suffixes are ordered by prefix doubling, a rank pair and the place packed in one 64-bit integer, so a round is
one plain sort. Of the transform only runs are kept: symbol, length, and the text positions at both ends of each run (a
terminator is a run of its own). Blocks of text are bounded by the caller; nothing here is read from a file or kept.

Neighbours in suffix order need comparing only where two runs meet. Inside a run, the suffixes one symbol longer are neighbours
as well, so going forward through the text a match shortens by one with each byte until a sampled run end starts
a new one: the matching statistic at every position is a running maximum over the samples.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_PACKED = 21  # bits of a place up to which two ranks and the place share 64 bits


def _order(first: np.ndarray, second: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Places sorted by (first, second, place), and where a new pair begins in that order."""
    n = len(first)
    if bits <= _PACKED:
        key = np.sort((first << np.uint64(2 * bits)) | (second << np.uint64(bits)) | np.arange(n, dtype=np.uint64))
        order = (key & np.uint64((1 << bits) - 1)).astype(np.int64)
        key >>= np.uint64(bits)
        return order, np.append(True, key[1:] != key[:-1])
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    return order, np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))


def suffix_order(symbols: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Order of all suffixes. ``symbols``: 0 closes a row; ``left``: symbols up to the row's terminator."""
    n = len(symbols)
    bits = max(1, n.bit_length())
    used = np.bincount(symbols, minlength=1) > 0
    used[0] = True
    code = (np.cumsum(used) - 1).astype(np.uint64)[symbols]
    width = max(1, int(used.sum() - 1).bit_length())
    span = max(1, (2 * bits if bits <= _PACKED else 62) // width)
    key, alive = np.zeros(n, np.uint64), np.ones(n, bool)
    for j in range(span):
        c = np.zeros(n, np.uint64)
        if j < n:
            c[: n - j] = code[j:]
        c[~alive] = 0
        key = (key << np.uint64(width)) | c
        alive &= c > 0
    if bits <= _PACKED:
        low = np.uint64((1 << bits) - 1)
        order, begins = _order(key >> np.uint64(bits), key & low, bits)
    else:
        order, begins = _order(key, np.zeros(n, np.uint64), bits)
    longest = int(left.max(initial=0)) + 1
    places = np.arange(n)
    while span < longest and not begins.all():
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(begins).astype(np.uint64)
        second = np.where(left >= span, rank[np.minimum(places + span, n - 1)], np.uint64(0))
        order, begins = _order(rank, second, bits)
        span *= 2
    return order


@dataclass(frozen=True)
class RunIndex:
    """Runs of the transform: ``symbol``, ``length``, and the text positions ``first``, ``last`` at their ends."""

    symbol: np.ndarray
    length: np.ndarray
    first: np.ndarray
    last: np.ndarray


def layout(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All rows as symbols (byte + 1, 0 at each row's end), where each row begins, and the symbols left in its row."""
    lengths = np.array([len(r) for r in rows], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    text = np.frombuffer(b"\0".join(rows) + b"\0", np.uint8).astype(np.int64) + 1
    text[begins + lengths] = 0
    left = np.repeat(begins + lengths, lengths + 1) - np.arange(len(text))
    return text, begins, left


def build(symbols: np.ndarray, left: np.ndarray) -> RunIndex:
    order = suffix_order(symbols, left)
    before = symbols[order - 1]  # in front of a row stands the terminator of the one before
    heads = np.append(True, (before[1:] != before[:-1]) | (before[1:] == 0))
    at = np.flatnonzero(heads)
    ends = np.append(at[1:], len(order)) - 1
    return RunIndex(before[at], ends - at + 1, order[at], order[ends])


def _common(symbols: np.ndarray, left: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> np.ndarray:
    """Length that the suffixes at ``a`` and ``b`` have in common; 0 where it is under ``least``."""
    limit = np.minimum(left[a], left[b])
    out = np.zeros(len(a), np.int64)
    pairs = np.flatnonzero(limit >= least)
    if not len(pairs):
        return out
    data = np.append((symbols - 1).clip(0).astype(np.uint8), np.zeros(8, np.uint8))
    words = np.zeros(len(symbols), np.uint64)
    for j in range(8):
        words |= data[j : j + len(symbols)].astype(np.uint64) << np.uint64(8 * j)
    step = 0
    while len(pairs):
        x, y = a[pairs] + step, b[pairs] + step
        differ = words[x] ^ words[y]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.log2(low.astype(np.float64), where=low > 0, out=np.zeros(len(low))) // 8)
        found = np.minimum(step + equal.astype(np.int64), limit[pairs])
        done = (differ != 0) | (found >= limit[pairs])
        out[pairs[done]] = found[done]
        pairs = pairs[~done]
        step += 8
    out[out < least] = 0
    return out


def matching_statistics(
    index: RunIndex, symbols: np.ndarray, left: np.ndarray, repeated: np.ndarray, least: int
) -> np.ndarray:
    """For each position the longest match that starts at any other, where it has ``least`` bytes or more; else less.

    ``repeated``: rows' first positions whose row stands for several equal ones; such a row is its own neighbour.
    """
    after, before = index.first[1:], index.last[:-1]
    length = _common(symbols, left, after, before, least)
    reach = np.zeros(len(symbols), np.int64)
    hit = length > 0
    for at in (after, before):
        np.maximum.at(reach, at[hit], at[hit] + length[hit])
    np.maximum.at(reach, repeated, repeated + left[repeated])
    return np.maximum.accumulate(reach) - np.arange(len(symbols))


def repeated_spans(rows: list[bytes], counts: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, from, to`` (end exclusive) of the maximal stretches covered by strings of ``least`` bytes that start elsewhere too.

    ``counts``: how many equal strings each row stands for.
    """
    none = np.zeros(0, np.int64)
    if not rows:
        return none, none, none
    symbols, begins, left = layout(rows)
    statistics = matching_statistics(build(symbols, left), symbols, left, begins[counts > 1], least)
    hits = np.flatnonzero(statistics >= least)
    if not len(hits):
        return none, none, none
    new = np.flatnonzero(np.append(True, np.diff(hits) > least))
    start, end = hits[new], hits[np.append(new[1:], len(hits)) - 1] + least
    row = np.searchsorted(begins, start, "right") - 1
    return row, start - begins[row], end - begins[row]
