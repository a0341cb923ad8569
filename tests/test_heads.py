"""Heads inside one task, against plain loops over the baskets."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from basketry.functions import heads

INT_LISTS = pa.list_(pa.int32())


def batch(baskets):
    items = pa.array([None, *baskets], INT_LISTS)[1:]  # a slice: offsets do not begin at 0
    return pa.RecordBatch.from_arrays([pa.array(range(len(baskets)), pa.int64()), items], names=["number", "items"])


def random_baskets(draw, n, n_items, most):
    return [sorted(draw.sample(range(n_items), draw.randrange(min(most, n_items) + 1))) for _ in range(n)]


def finder(edges, n_items, shares=1, **kw):
    edges = sorted(edges, key=lambda e: (e[1], e[0]))
    lasts, items = (np.array([e[j] for e in edges], np.int64) for j in (1, 0))
    return heads.head_finder(lasts, items.astype(np.int32), np.full(len(edges), shares), n_items, **kw)


def rows_of(batches):
    return [r for b in batches for r in b.to_pylist()]


@pytest.mark.parametrize("dense_bits", [1 << 29, 0])
@pytest.mark.parametrize("step", [heads.STEP, 7])
def test_heads_hold_neighbours_only(monkeypatch, dense_bits, step):
    monkeypatch.setattr(heads, "STEP", step)
    draw = random.Random(step + dense_bits % 97)
    for n_items in (3, 12, 40):
        baskets = random_baskets(draw, 60, n_items, 14) + [list(range(n_items))] * 5 + [[]]
        edges = [e for e in combinations(range(n_items), 2) if draw.random() < 0.5]
        if not edges:
            continue
        find = finder(edges, n_items, 3, dense_bits=dense_bits)
        got, expected = Counter(), Counter()
        for row in rows_of(find(iter([batch(baskets[:20]), batch(baskets[20:])]))):
            got[row["last"], tuple(row["head"])] += row["n"]
            assert row["shares"] == 3 and 0 <= row["share"] < 3
        for items in baskets:
            for at, last in enumerate(items):
                head = tuple(i for i in items[:at] if (i, last) in set(edges))
                if len(head) >= 2:
                    expected[last, head] += 1
        assert got == expected


def test_a_long_basket_sends_edges_not_pairs():
    """10,000 items with three neighbours each: three ids for each item, not half the square."""
    n = 10_000
    edges = [(i - d, i) for i in range(n) for d in (1, 2, 3) if i >= d]
    found = rows_of(finder(edges, n)(iter([batch([list(range(n))])])))
    assert sum(len(r["head"]) for r in found) <= 3 * n
    assert {r["last"]: r["head"] for r in found}[5000] == [4997, 4998, 4999]


def test_equal_heads_weigh():
    found = rows_of(finder([(0, 2), (1, 2)], 3)(iter([batch([[0, 1, 2]] * 50)])))
    assert found == [{"last": 2, "share": found[0]["share"], "shares": 1, "head": [0, 1], "n": 50}]


def supports(baskets, weights):
    out = Counter()
    for items, n in zip(baskets, weights):
        for k in range(1, len(items) + 1):
            for s in combinations(items, k):
                out[s] += n
    return out


def grouped(rows):
    rows = sorted(rows, key=lambda r: (r["last"], r["share"]))
    columns = {c: pa.array([r[c] for r in rows], pa.int32()) for c in ("last", "share", "shares")}
    columns |= {"head": pa.array([r["head"] for r in rows], INT_LISTS), "n": pa.array([r["n"] for r in rows], pa.int64())}
    return pa.table(columns)


@pytest.mark.parametrize("weight", [1, 5, 1000])
def test_groups_mine_all_sets(weight):
    draw = random.Random(weight)
    for trial in range(12):
        lasts = [8, 9]
        rows = [
            {"last": last, "share": 0, "shares": 1, "head": draw.sample(range(8), draw.randrange(9)), "n": draw.randrange(1, weight + 1)}
            for last in lasts
            for _ in range(draw.randrange(1, 60))
        ]
        rows = [r | {"head": sorted(r["head"])} for r in rows]
        least, max_k = draw.choice([1, 3, weight * 8]), draw.choice([None, 3, 4])
        batches = grouped(rows).to_batches(max_chunksize=7)
        got = rows_of(heads.group_miner(least, max_k)(iter(batches)))
        expected = {}
        for last in lasts:
            mine = [r for r in rows if r["last"] == last]
            for s, n in supports([r["head"] for r in mine], [r["n"] for r in mine]).items():
                if n >= least and 2 <= len(s) < (max_k or 99):
                    expected[(*s, last)] = n
        assert {tuple(r["items"]): r["n"] for r in got} == expected and len(got) == len(expected), trial


def test_shares_find_every_candidate():
    """A set that is frequent over all groups of its last item is found in one of them."""
    draw = random.Random(6)
    rows = [{"last": 6, "share": draw.randrange(4), "shares": 4, "head": sorted(draw.sample(range(6), 4)), "n": 1} for _ in range(80)]
    found = {tuple(r["items"]) for r in rows_of(heads.group_miner(20, None)(iter(grouped(rows).to_batches())))}
    every = {(*s, 6) for s, n in supports([r["head"] for r in rows], [1] * 80).items() if n >= 20 and len(s) > 1}
    assert every and every <= found


def test_wide_classes_go_one_by_one():
    rows = [{"last": 300, "share": 0, "shares": 1, "head": list(range(b % 7, 300, 7)), "n": 1} for b in range(70_000 // 10)]
    rows = grouped(rows)
    got = rows_of(heads.group_miner(1000, 3)(iter(rows.to_batches())))
    assert len(got) == sum(len(range(b, 300, 7)) * (len(range(b, 300, 7)) - 1) // 2 for b in range(7))
    assert {r["n"] for r in got} == {1000}


def test_given_sets_are_counted():
    draw = random.Random(7)
    rows = [{"last": 9, "share": 0, "shares": 1, "head": sorted(draw.sample(range(9), draw.randrange(2, 9))), "n": draw.randrange(1, 40)} for _ in range(90)]
    truth = supports([r["head"] for r in rows], [r["n"] for r in rows])
    sets = draw.sample([s for k in (2, 3, 4) for s in combinations(range(12), k)], 200)
    asked = pa.table({"number": pa.array(range(200), pa.int64()), "items": pa.array([[*s, 9] for s in sets], INT_LISTS)})
    found = heads.set_counter()(grouped(rows), asked).to_pylist()
    assert {r["number"]: r["n"] for r in found} == {i: truth[s] for i, s in enumerate(sets) if truth[s]}
    assert heads.set_counter()(grouped([]), asked).num_rows == heads.set_counter()(grouped(rows), asked.slice(0, 0)).num_rows == 0


def test_nothing_in_nothing_out():
    assert rows_of(finder([(0, 1)], 2)(iter([batch([]), batch([[0, 1]])]))) == []
    assert rows_of(heads.group_miner(1, None)(iter([]))) == []
