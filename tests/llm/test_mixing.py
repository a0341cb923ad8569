"""Mixing against a plain computation."""

import math
import re
from collections import defaultdict

import pytest

from basketry.llm import mixing
from basketry.llm.ranks import ranked
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, source string, place string"


def rows():
    out = [(i, "w " * (i * 7 % 40), f"s{i % 4}", "p") for i in range(300)]
    out += [(300 + i, "x " * 500, "big", "p") for i in range(20)]
    return out + [(900, None, "empty", "p"), (901, "a b", None, "p"), (5, "w " * 35, "s1", "p"), (5, "w " * 35, "s1", "p"), (None, "q", "s2", None)]


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        level = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > 3 * sizes[s] + 1e-9]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: 3.0 * sizes[s] for s in over}


def test_targets_copies_and_rows(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    sizes, largest = defaultdict(int), defaultdict(int)
    for _, text, source, _ in data:
        n = len(re.findall(mixing.WORD, text or ""))
        sizes[source] += n
        largest[source] = max(largest[source], n)
    want = targets(sizes)
    got = mixing.copies(df).collect()
    assert len(got) == len(data)
    taken = defaultdict(int)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert math.floor(rate - 1e-9) <= r["copies"] <= math.ceil(rate - 1e-9) <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source]
    assert sorted(map(repr, mixing.copies(df.repartition(2)).collect())) == sorted(map(repr, got))
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)


def test_empty_table_and_no_words(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert mixing.mixed_sizes(df.limit(0)).count() == 0
    none = spark.createDataFrame([(1, "", "a", "p"), (2, None, "b", "p")], SCHEMA)
    assert [(r["target"], r["taken"]) for r in mixing.mixed_sizes(none).collect()] == [(0.0, 0), (0.0, 0)]


def test_ranks_of_a_hot_group(spark):
    data = [("hot" if i % 3 else None, i * 37 % 500, i) for i in range(500)]
    df = spark.createDataFrame(data, "g string, v long, at long").repartition(7)
    got = {(r["g"], r["v"]): r["rank"] for r in ranked(df, ["g"], [F.col("v")], "rank").collect()}
    for g in ("hot", None):
        values = sorted(v for name, v, _ in data if name == g)
        assert [got[g, v] for v in values] == list(range(1, len(values) + 1))
