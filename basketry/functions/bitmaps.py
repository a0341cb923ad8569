"""Support counting inside one task, for ``DataFrame.mapInArrow``.

A batch of baskets (lists of item ids ``0..n_items-1``) becomes one bit row per item, so the support
of a pair is the number of ones left after AND-ing its rows. Sums are kept over all batches of a task, and
only they leave it; Spark adds up the tasks with a partial and a final aggregate. Nothing is emitted per
basket.

The functions are closures on purpose: they travel to the workers by value, so the package need not be
installed there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BatchFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


LARGEST = 1 << 26  # bytes that one task may hold for bit rows, and again for sums
STEP = 2_000_000  # list entries and pairs handled at once, and rows per emitted batch
# Measured: listing one pair costs as much as AND-ing this many 64-basket words.
PAIR_IN_WORDS = 16


def _helpers(n_items: int) -> tuple[Callable, Callable, Callable]:
    rows_at_once = max(64, LARGEST * 8 // max(n_items, 1))
    step = STEP

    def blocks(batches):
        """The item lists, cut where very many items or very long baskets would need too much memory."""
        for batch in batches:
            lists = batch.column(0)
            ends = lists.offsets.to_numpy()
            lo = 0
            while lo < len(lists):
                fitting = int(np.searchsorted(ends, ends[lo] + step, side="right")) - 1
                hi = min(max(fitting, lo + 1), lo + rows_at_once)
                yield lists.slice(lo, hi - lo)
                lo = hi

    def bit_rows(values, basket, n_baskets, n_values):
        """(n_values, words) uint64 bits, one column bit per basket."""
        width = -(-n_baskets // 64) * 8
        bits = np.zeros(n_values * width, dtype=np.uint8)
        # a basket holds an item once, so adding the bit equals setting it
        np.add.at(bits, values * width + (basket >> 3), (1 << (basket & 7)).astype(np.uint8))
        return bits.reshape(n_values, width).view(np.uint64)

    def batches_of(columns, n):
        """Record batches ``i1..ik, n`` of at most ``step`` rows."""
        names = [f"i{j + 1}" for j in range(len(columns))] + ["n"]
        for lo in range(0, len(n), step):
            ids = [pa.array(c[lo : lo + step], pa.int32()) for c in columns]
            sums = pa.array(n[lo : lo + step], pa.int64())
            yield pa.RecordBatch.from_arrays([*ids, sums], names=names)

    return blocks, bit_rows, batches_of


HELD = 16_000_000  # list entries of a task that are counted together, tile by tile


def pair_counter(n_items: int, pair_in_words: int = PAIR_IN_WORDS) -> BatchFunction:
    """Count every co-occurring pair; yields ``i1 < i2, n``.

    Sums stay in the task: in one square of all items while that fits into ``LARGEST`` bytes. Beyond, up to ``HELD`` entries
    are kept and counted tile by tile, a range of items against a range, so a pair leaves once for all of them.
    Two exact ways, chosen per block by cost. Dense: AND bit rows, work grows with the square of the items.
    Sparse: read the pairs off the item lists, work grows with the square of the basket lengths.
    """
    blocks, bit_rows, batches_of = _helpers(n_items)
    step, largest, held_most = STEP, LARGEST, HELD
    side = max(1, min(n_items, int((largest // 8) ** 0.5)))

    def ragged(starts, lengths):
        ends = np.cumsum(lengths)
        return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)

    def split(lists):
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        lengths = np.diff(lists.offsets.to_numpy())
        return values, np.repeat(np.arange(len(lengths)), lengths), len(lengths)

    def dense(total, a, b, n_baskets, same):
        """``a``, ``b``: ids and baskets of the entries in the tile's rows and columns."""
        rows, columns = (bit_rows(x, y, n_baskets, int(x.max()) + 1) for x, y in (a, b))
        for i in np.flatnonzero(rows.any(axis=1)):
            beyond = i + 1 if same else 0
            n = np.bitwise_count(rows[i] & columns[beyond:]).sum(axis=1, dtype=np.int64)
            total[i * side + beyond : i * side + beyond + len(n)] += n

    def sparse(total, a, b, first, width):
        """Each entry of ``a`` with ``width`` entries of ``b`` from ``first`` on."""
        cost = np.cumsum(width)
        lo = 0
        while lo < len(a):
            done = cost[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(cost, done + step, side="right")))
            np.add.at(total, np.repeat(a[lo:hi] * side, width[lo:hi]) + b[ragged(first[lo:hi], width[lo:hi])], 1)
            lo = hi

    def tile(total, values, basket, n_baskets, r, c):
        """Add the pairs of an item of range ``r`` with one of range ``c``; lists ascend, so ``r`` stands before ``c``."""
        of = values // side
        a = np.flatnonzero(of == r)
        b = a if r == c else np.flatnonzero(of == c)
        if not len(a) or not len(b):
            return
        left, right = values[a] - r * side, values[b] - c * side
        ends = np.searchsorted(basket[b], basket[a], "right")
        first = np.arange(1, len(a) + 1) if r == c else np.searchsorted(basket[b], basket[a], "left")
        width = ends - first
        words = (int(left.max()) + 1) * (int(right.max()) + 1) / (2 if r == c else 1) * -(-n_baskets // 64)
        if width.sum() * pair_in_words < words:
            sparse(total, left, right, first, width)
        else:
            dense(total, (left, basket[a]), (right, basket[b]), n_baskets, r == c)

    def emitted(total, r, c):
        keys = np.flatnonzero(total)
        yield from batches_of((keys // side + r * side, keys % side + c * side), total[keys])

    def count(batches):
        total = np.zeros(side * side, np.int64)
        if side == n_items:
            for lists in blocks(batches):
                tile(total, *split(lists), 0, 0)
            yield from emitted(total, 0, 0)
            return
        held, size = [], 0
        for lists in blocks(batches):
            held.append(split(lists))
            size += len(held[-1][0])
            if size >= held_most:
                yield from tiles(total, held)
                held, size = [], 0
        yield from tiles(total, held)

    def tiles(total, held):
        for r in range(-(-n_items // side)):
            for c in range(r, -(-n_items // side)):
                total[:] = 0
                for part in held:
                    tile(total, *part, r, c)
                yield from emitted(total, r, c)

    return count
