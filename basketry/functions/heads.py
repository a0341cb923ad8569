"""Work on heads inside one task: finding them, mining all sets of one last item, counting given sets.

Ids run from the most to the least frequent item. The *head* of an item in a basket are the items before it, of those
that some candidate holds together with it; so a basket of any length sends an item's group only what can count
there. Equal heads of a batch are one row with a weight.

The functions are closures on purpose: they travel to the workers by value, so the package need not be
installed there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BatchFunction = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

HEADS = "last int, share int, shares int, head array<int>, n bigint"
MINED = "last int, shares int, items array<int>, n bigint"
STEP = 2_000_000  # pairs looked at, and list entries emitted, at once
DENSE_BITS = 1 << 29  # of a table that answers for any two ids whether they are an edge
SAME = 64  # items up to which heads of a batch are compared with each other


def _ragged():
    def ragged(starts, lengths):
        """Indices ``starts[i] .. starts[i] + lengths[i] - 1`` for all i, one after the other."""
        ends = np.cumsum(lengths)
        return np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)

    return ragged


def _merger(ragged, same):
    def merged(key, starts, lengths, values, weights):
        """Equal rows (``key`` and list) as one, with the sum of their weights: row numbers and weights."""
        rows, sums = [], []
        for length in np.unique(lengths):
            here = np.flatnonzero(lengths == length)
            if length > same or len(here) == 1:
                rows.append(here)
                sums.append(weights[here])
                continue
            table = values[ragged(starts[here], lengths[here])].reshape(len(here), length)
            table = np.ascontiguousarray(np.column_stack([key[here], table]).astype(np.int32))
            lists = table.view(np.dtype((np.void, table.shape[1] * 4))).ravel()
            _, first, which = np.unique(lists, return_index=True, return_inverse=True)
            rows.append(here[first])
            sums.append(np.bincount(which.ravel(), weights[here]).astype(np.int64))
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(rows), np.concatenate(sums)

    return merged


def head_finder(
    lasts: np.ndarray, items: np.ndarray, shares: np.ndarray, n_items: int, dense_bits: int = DENSE_BITS, least: int = 2
) -> BatchFunction:
    """Heads of ``number, items`` baskets for the edges ``(items[i], lasts[i])``, sorted by last, then item.

    ``shares[i]``: how many groups the last item has. Two exact ways, chosen per block by cost: look up all pairs of
    a basket, or look for each last item's neighbours in the basket. Heads under ``least`` items are left out.
    """
    ragged, step = _ragged(), STEP
    merged = _merger(ragged, SAME)
    # place of each id among the last items, and where its neighbours begin
    known, begins, degrees = np.unique(lasts, return_index=True, return_counts=True)
    start, degree, groups = (np.zeros(n_items, np.int64) for _ in range(3))
    start[known], degree[known], groups[known] = begins, degrees, shares[begins]
    table = None
    if n_items * n_items <= dense_bits:
        table = np.zeros((n_items * n_items + 7) // 8, np.uint8)
        code = lasts.astype(np.int64) * n_items + items
        np.bitwise_or.at(table, code >> 3, (1 << (code & 7)).astype(np.uint8))

    def by_pairs(values, at, place):
        """Entries and items before them that make an edge."""
        width = np.where(degree[values[at]] > 0, place[at], 0)
        entry = np.repeat(at, width)
        before = values[ragged(at - place[at], width)]
        code = values[entry] * n_items + before
        hit = (table[code >> 3] >> (code & 7).astype(np.uint8)) & 1 > 0
        return entry[hit], before[hit]

    def by_neighbours(values, basket, at, n_baskets):
        held = np.zeros(n_baskets * n_items // 8 + 1, np.uint8)
        code = basket * n_items + values
        np.bitwise_or.at(held, code >> 3, (1 << (code & 7)).astype(np.uint8))
        entry = np.repeat(at, degree[values[at]])
        near = items[ragged(start[values[at]], degree[values[at]])].astype(np.int64)
        code = basket[entry] * n_items + near
        hit = (held[code >> 3] >> (code & 7).astype(np.uint8)) & 1 > 0
        return entry[hit], near[hit]

    def blocks(values, basket, place):
        """Entries with their hits, as many at a time as make about ``step`` lookups."""
        pairs = np.where(degree[values] > 0, place, 0)
        near = degree[values]
        use_pairs = table is not None and pairs.sum() <= near.sum()
        cost = np.cumsum(pairs if use_pairs else near)
        lo = 0
        while lo < len(values):
            done = cost[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(cost, done + step, "right")))
            at = np.arange(lo, hi)
            yield by_pairs(values, at, place) if use_pairs else by_neighbours(values, basket, at, int(basket[-1]) + 1)
            lo = hi

    def mixed(x):
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        return (x * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(33)

    def find(batches):
        for batch in batches:
            lists, numbers = batch.column("items"), batch.column("number").to_numpy()
            rows_at_once = max(1, (1 << 26) * 8 // max(n_items, 1))
            for row in range(0, len(lists), rows_at_once):
                part = lists.slice(row, rows_at_once)
                values = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                lengths = np.diff(part.offsets.to_numpy())
                basket = np.repeat(np.arange(len(lengths)), lengths)
                place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                for entry, item in blocks(values, basket, place):
                    sizes = np.bincount(entry, minlength=len(values)) if len(entry) else np.zeros(len(values), np.int64)
                    full = np.flatnonzero(sizes >= least)
                    if not len(full):
                        continue
                    begin = (np.cumsum(sizes) - sizes)[full]
                    which, n = merged(values[full], begin, sizes[full], item, np.ones(len(full), np.int64))
                    entries = full[which]
                    last = values[entries]
                    share = mixed(numbers[row + basket[entries]]).astype(np.int64) % groups[last]
                    heads = item[ragged(begin[which], sizes[entries])].astype(np.int32)
                    ends = np.append(0, np.cumsum(sizes[entries])).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(last, pa.int32()),
                            pa.array(share, pa.int32()),
                            pa.array(groups[last], pa.int32()),
                            pa.ListArray.from_arrays(pa.array(ends), pa.array(heads)),
                            pa.array(n, pa.int64()),
                        ],
                        names=["last", "share", "shares", "head", "n"],
                    )

    return find


def _bits():
    ragged = _ragged()
    merged = _merger(ragged, 1 << 30)

    def bit_rows(lists, weights, wanted=None):
        """Item ids, one row of bits for each, and the planes by which baskets weigh.

        ``wanted``: ids to keep. A basket's weight is spread over planes, one for each binary digit that occurs.
        """
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = lists.offsets.to_numpy()
        lengths = np.diff(offsets)
        rows, weights = merged(np.zeros(len(lengths), np.int64), offsets[:-1] - offsets[0], lengths, values, weights)
        values = values[ragged((offsets[:-1] - offsets[0])[rows], lengths[rows])]
        basket = np.repeat(np.arange(len(rows)), lengths[rows])
        ids = np.unique(values) if wanted is None else wanted
        at = np.minimum(np.searchsorted(ids, values), max(len(ids) - 1, 0))
        known = ids[at] == values if len(ids) else np.zeros(len(values), bool)
        width = -(-max(len(rows), 1) // 64) * 8
        bits = np.zeros(len(ids) * width, np.uint8)
        # a basket holds an item once, so adding the bit equals setting it
        np.add.at(bits, at[known] * width + (basket[known] >> 3), (1 << (basket[known] & 7)).astype(np.uint8))
        planes = []
        for digit in range(int(weights.max(initial=1)).bit_length()):
            has = (weights >> digit) & 1
            if has.any():
                plane = np.zeros(width * 8, np.uint8)
                plane[: len(has)] = has
                planes.append((1 << digit, np.packbits(plane, bitorder="little").view(np.uint64)))
        if len(planes) == 1 and planes[0][0] == 1:
            planes = []
        return ids, bits.reshape(len(ids), width).view(np.uint64), planes

    def total(rows, planes):
        if not planes:
            return np.bitwise_count(rows).sum(axis=-1, dtype=np.int64)
        return sum(scale * np.bitwise_count(rows & plane).sum(axis=-1, dtype=np.int64) for scale, plane in planes)

    return bit_rows, total


def group_miner(min_count: int, max_k: int | None) -> BatchFunction:
    """All frequent sets of three and more items, group by group; batches come sorted by ``last, share``.

    Depth first: a prefix's extensions are bit rows, and AND-ing each with those after it gives the extensions of the
    longer prefix. An item's only group counts exactly. With several, a set that is frequent in all baskets reaches
    the threshold's share in one of them at least, so the groups together find every candidate.
    """
    bit_rows, total = _bits()
    step = STEP
    at_once = 1 << 16  # words of bit rows for which all pairs of a class are AND-ed together

    def extend(prefix, ids, rows, planes, least):
        """Yields matrices of sets (without the last item) and their counts."""
        depth = len(prefix) + 3  # items of a set found here, the last one included
        if len(ids) < 2 or (max_k is not None and depth > max_k):
            return
        if len(ids) * (len(ids) - 1) // 2 * rows.shape[1] <= at_once:
            x, y = np.triu_indices(len(ids), 1)
            common = rows[x] & rows[y]
            n = total(common, planes)
            kept = np.flatnonzero(n >= least)
            cuts = np.searchsorted(x[kept], np.arange(len(ids) + 1))
            parts = [(a, y[kept[cuts[a] : cuts[a + 1]]], common[kept[cuts[a] : cuts[a + 1]]], n[kept[cuts[a] : cuts[a + 1]]]) for a in range(len(ids)) if cuts[a + 1] > cuts[a]]
        else:

            def one_by_one():
                for a in range(len(ids) - 1):
                    common = rows[a] & rows[a + 1 :]
                    n = total(common, planes)
                    kept = np.flatnonzero(n >= least)
                    if len(kept):
                        yield a, a + 1 + kept, common[kept], n[kept]

            parts = one_by_one()
        for a, others, common, n in parts:
            longer = [*prefix, ids[a]]
            sets = np.empty((len(others), depth - 1), np.int64)
            sets[:, :-1] = longer
            sets[:, -1] = ids[others]
            yield sets, n
            yield from extend(longer, ids[others], common, planes, least)

    def groups(batches):
        key, held = None, []
        for batch in batches:
            last, share = (batch.column(c).to_numpy() for c in ("last", "share"))
            cuts = [0, *(np.flatnonzero((np.diff(last) != 0) | (np.diff(share) != 0)) + 1).tolist(), len(last)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if key is not None and key != (last[a], share[a]):
                    yield key, pa.Table.from_batches(held)
                    held = []
                key = (last[a], share[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield key, pa.Table.from_batches(held)

    def mine(batches):
        lasts, counts, shared, lists, lengths, size = [], [], [], [], [], 0

        def flush():
            ends = np.append(0, np.cumsum(np.concatenate(lengths))).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(lasts), pa.int32()),
                    pa.array(np.concatenate(shared), pa.int32()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(lists), pa.int32())),
                    pa.array(np.concatenate(counts), pa.int64()),
                ],
                names=["last", "shares", "items", "n"],
            )

        for (last, _), table in groups(batches):
            shares = table.column("shares")[0].as_py()
            least = max(1, -(-min_count // shares))
            ids, rows, planes = bit_rows(table.column("head").combine_chunks(), table.column("n").to_numpy())
            often = total(rows, planes) >= least
            for sets, n in extend([], ids[often], rows[often], planes, least):
                whole = np.column_stack([sets, np.full(len(sets), last)])
                lists.append(whole.ravel())
                lengths.append(np.full(len(whole), whole.shape[1]))
                lasts.append(np.full(len(whole), last))
                shared.append(np.full(len(whole), shares))
                counts.append(n)
                size += whole.size
                if size >= step:
                    yield flush()
                    lasts, counts, shared, lists, lengths, size = [], [], [], [], [], 0
        if size:
            yield flush()

    return mine


def whole_groups(miner: BatchFunction) -> Callable[[pa.Table], pa.Table]:
    """The miner for groups that Spark hands over one by one."""

    def mine(group):
        found = list(miner(iter(group.combine_chunks().to_batches())))
        if found:
            return pa.Table.from_batches(found)
        none = {"last": pa.int32(), "shares": pa.int32(), "items": pa.list_(pa.int32()), "n": pa.int64()}
        return pa.table({c: pa.array([], t) for c, t in none.items()})

    return mine


def set_counter() -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Count given sets of one last item against a group of its heads: ``number, n`` of the sets that occur.

    First table: ``head, n``; second: ``number, items``, the last item at their end.
    """
    bit_rows, total = _bits()

    def count(heads, sets):
        none = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64())], names=["number", "n"])
        if not heads.num_rows or not sets.num_rows:
            return none
        lists = sets.column("items").combine_chunks()
        values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        offsets = lists.offsets.to_numpy()
        offsets, lengths = offsets - offsets[0], np.diff(offsets)
        numbers = sets.column("number").to_numpy()
        inner = np.ones(len(values), bool)
        inner[offsets[1:] - 1] = False
        ids, rows, planes = bit_rows(heads.column("head").combine_chunks(), heads.column("n").to_numpy(), np.unique(values[inner]))
        occurs = rows.any(axis=1)
        out, counts = [], []
        at_once = max(1, (1 << 17) // rows.shape[1])  # about 1 MB of bit rows at a time
        for length in np.unique(lengths):
            here = np.flatnonzero(lengths == length)
            table = values[offsets[:-1][here][:, None] + np.arange(length - 1)]
            place = np.searchsorted(ids, table)
            possible = np.flatnonzero(occurs[place].all(axis=1))
            for lo in range(0, len(possible), at_once):
                part = possible[lo : lo + at_once]
                common = rows[place[part, 0]]
                for j in range(1, length - 1):
                    common &= rows[place[part, j]]
                n = total(common, planes)
                out.append(numbers[here[part[n > 0]]])
                counts.append(n[n > 0])
        if not out:
            return none
        return pa.table([pa.array(np.concatenate(out)), pa.array(np.concatenate(counts))], names=["number", "n"])

    return count
