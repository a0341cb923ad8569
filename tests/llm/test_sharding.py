"""Best fit in a search tree against a linear search, and the shards of documents."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import sharding

SCHEMA = "doc_id long, text string, size string, shard string"


def plain(sizes, capacity):
    rooms, out = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fitting = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i]]
        if fitting:
            b = min(fitting)[1]
        else:
            b = len(rooms)
            rooms.append(capacity)
        rooms[b] -= sizes[i]
        out[i] = b
    return out


@settings(deadline=None)
@given(st.lists(st.integers(1, 60), max_size=80), st.integers(1, 100))
def test_best_fit(sizes, capacity):
    got = sharding.best_fit_decreasing(sizes, capacity)
    assert got == plain(sizes, capacity)
    for b in set(got):
        held = [s for s, x in zip(sizes, got, strict=True) if x == b]
        assert sum(held) <= capacity or len(held) == 1


def check(rows, got, shards=8):
    assert len(got) == len(rows)
    text = dict(rows)
    slots, size, of = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert 0 <= r["shard"] < shards
        slots[r["shard"]].append((r["slot"], r["doc_id"]))
        size[r["shard"]] += r["size"]
        of[raw].add(r["shard"])
    for s in slots.values():
        assert [n for n, _ in sorted(s)] == list(range(len(s)))
        assert [d for _, d in sorted(s)] == sorted((d for _, d in s), key=lambda d: (d is None, d or 0))
    return size, of


def test_documents(spark):
    rows = [(i, "t" * (i * 37 % 211) + str(i % 150)) for i in range(1500)] + [(5000, None), (5001, "")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(6)
    size, of = check(rows, sharding.shard_documents(df).collect())
    assert len(size) == 8 and max(size.values()) - min(size.values()) < 0.03 * sum(size.values()) / 8
    assert all(len(s) == 1 for s in of.values())
    assert sharding.shard_documents(df.limit(0)).count() == 0


def test_a_group_larger_than_a_shard_is_cut(spark):
    rows = [(i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    size, of = check(rows, sharding.shard_documents(df).collect())
    assert max(size.values()) < 1.1 * sum(size.values()) / 8
    assert all(len(s) == 1 for raw, s in of.items() if raw != b"same text")


@pytest.mark.parametrize("ids", [None, 7])
def test_a_large_group_without_ids_of_its_own(spark, ids):
    """A third of the rows are one text under null or equal ids: all shards still get their share."""
    rows = [(ids if i % 3 == 0 else i, "same text" if i % 3 == 0 else f"text {i}") for i in range(3000)]
    got = sharding.shard_documents(spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)).collect()
    size, slots = Counter(), defaultdict(list)
    for r in got:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sum(size.values()) == sum(len(t) + 1 for _, t in rows) and set(size) == set(range(8))
    assert max(size.values()) - min(size.values()) < 0.03 * sum(size.values()) / 8
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_row_above_a_share_leaves_the_rest_even():
    sizes = [9000, 4000] + [10] * 600
    out = sharding._into(sizes, 8)
    held = Counter()
    for s, b in zip(sizes, out):
        held[b] += s
    assert sorted(held.values()) == [1000] * 6 + [4000, 9000]
    assert sharding._into([], 8) == [] and sharding._into([5], 8) == [0]


@settings(deadline=None)
@given(st.lists(st.integers(1, 500), max_size=60), st.integers(1, 9))
def test_all_shards_stay_in_range(sizes, shards):
    assert all(0 <= b < shards for b in sharding._into(sizes, shards))


def test_two_levels_keep_their_bound(spark):
    draw = random.Random(3)
    for capacity in (640, 6400):
        sizes = [draw.choice([draw.randrange(1, 9), draw.randrange(1, 200), draw.randrange(1, 640)]) for _ in range(700)]
        groups = spark.createDataFrame(list(enumerate(sizes)), "name long, size long")
        placed = sharding.pack_groups(groups, capacity // 64, capacity, None).collect()
        held = Counter()
        for r in placed:
            held[r["shard"]] += sizes[r["name"]]
        assert len(placed) == len(sizes) and max(held.values()) <= capacity
        globally = max(sharding.best_fit_decreasing(sizes, capacity)) + 1
        assert len(held) <= max(globally, 64 / 63 * sum(sizes) / capacity + 1)
