"""Near-duplicates against all pairs of sets, in plain Python."""

import random
import re

import numpy as np
import pytest

from basketry.llm import neardup
from basketry.llm.components import connected_components

SCHEMA = "doc_id long, text string, key string, n string"


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, percent):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return [(d, len(s), min(groups[find(i)])) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def corpus():
    pick = random.Random(6)
    word = lambda: "".join(pick.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(pick.choice([6, 40, 120, 300]))]
        for _ in range(pick.randrange(1, 14)):
            copy = list(base)
            for _ in range(pick.randrange(0, 1 + len(base) // 25)):
                copy[pick.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    rows += [rows[0]] * 5 + [rows[3].upper(), "", None, "  \n", "two words", "two  words", "Two Words", "five words make one shingle"]
    order = list(range(len(rows)))
    pick.shuffle(order)
    return [(order[i] * 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("percent", [85, 80])
def test_components(spark, percent):
    rows = corpus()
    df = spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA).repartition(5)
    got = neardup.near_duplicates(df, percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == sorted(brute(rows, percent))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_one_of_each_group_stays(spark):
    rows = [(4, "a b c d e f"), (2, "A b c d e F"), (2, "A b c d e F"), (2, "other words"), (9, None), (9, None), (None, "only here"), (None, "a b c d e f")]
    df = spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA)
    got = sorted((r["doc_id"] or -1, r["text"] or "", r["key"]) for r in neardup.deduplicate(df).collect())
    assert got == [(-1, "only here", "k"), (2, "A b c d e F", "k"), (2, "other words", "k"), (9, "", "k"), (9, "", "k")]
    assert neardup.near_duplicates(df.limit(0)).count() == 0 == neardup.deduplicate(df.limit(0)).count()
    with pytest.raises(ValueError):
        neardup.near_duplicates(df, 50)


def test_sketches_agree_as_often_as_sets_do():
    random_ = np.random.default_rng(8)
    for n, shared in ((3, 2), (40, 30), (900, 500)):
        agree = []
        for _ in range(30):
            common = random_.integers(0, 2**63, shared).astype(np.uint64)
            a, b = (np.concatenate([common, random_.integers(0, 2**63, n - shared).astype(np.uint64)]) for _ in "ab")
            x, y = neardup.sketch(a), neardup.sketch(b)
            assert (x != neardup._EMPTY).all()
            agree.append((x == y).mean())
        assert abs(np.mean(agree) - shared / (2 * n - shared)) < 0.08


def test_chains(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (300, 300), (7, 3)]
    labels = connected_components(spark.createDataFrame(edges, "a long, b long").repartition(4))
    got = {r["node"]: r["label"] for r in labels.collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 150: 100}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pairs_at_the_threshold(spark):
    """Pairs of a similarity of exactly 0.80, thousands of them: none is ruled out by the sketch."""
    pick = random.Random(15)
    rows = []
    for i in range(4000):
        words = [f"w{pick.randrange(10**9)}" for _ in range(44)]
        rows += [(2 * i, " ".join(words[:40])), (2 * i + 1, " ".join(words[:36] + words[40:]))]
    df = spark.createDataFrame([(*r, "k", "n") for r in rows], SCHEMA).repartition(4)
    assert sorted(r["doc_id"] for r in neardup.deduplicate(df, 80).collect()) == [2 * i for i in range(4000)]


@pytest.mark.parametrize("percent", [80, 83, 85, 90, 100])
def test_layout(percent):
    rows, agree = neardup.layout(percent)
    same = percent / 100
    assert (1 - same**rows) ** (neardup.BINS // rows) <= neardup.MISS
    below = np.random.default_rng(3).binomial(neardup.BINS, same + (1 - same) / 4, 2_000_000) < agree
    assert below.sum() <= 12


def test_members_of_a_hot_bucket_meet_in_blocks(spark):
    """Every pair of different components once, whatever the block; no group has more than two blocks of members."""
    random_ = random.Random(8)
    rows = [(b, bytes([b, i // 256, i % 256]), bytes([random_.randrange(40)])) for b, n in ((1, 90), (2, 1), (3, 7)) for i in range(n)]
    rest = spark.createDataFrame(rows, "bucket long, key binary, label binary")
    want = {(x[1], y[1]) for x in rows for y in rows if x[0] == y[0] and x[1] < y[1] and x[2] != y[2]}
    for block in (1, 8, 1000):
        met = neardup._met(rest, block).selectExpr("x.key AS a", "y.key AS b").collect()
        assert {(bytes(r["a"]), bytes(r["b"])) for r in met} == want and len(met) == len(want)
    plan = neardup._met(rest, 8)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
