"""Rules, their metrics, the rule browser and the rankings."""

import math
import re

import pytest

from basketry.operators import baskets as bk
from basketry.operators import itemsets as its
from basketry.operators import rules as rl
from basketry.operators import topn
from tests import brute
from tests.test_mining import LINES, random_lines


@pytest.fixture(scope="module")
def lines():
    return random_lines(21)


@pytest.fixture(scope="module")
def itemsets(spark, lines):
    tx = bk.transactions(spark.createDataFrame(lines, LINES))
    return its.mine_itemsets(tx, 8, None).itemsets


@pytest.fixture(scope="module")
def toy_rules(spark, toy_lines):
    return rl.generate_rules(its.mine_itemsets(bk.transactions(toy_lines), 2).itemsets)


def as_dict(rules):
    return {
        (tuple(r["antecedent"]), tuple(r["consequent"])): (r["support"], r["confidence"], r["lift"])
        for r in rules.collect()
    }


def test_toy_rules(toy_rules):
    got = as_dict(toy_rules)
    assert len(got) == 12
    assert got[("a",), ("b",)] == (0.6, 0.6 / 0.8, 0.6 / 0.8 / 0.8)
    assert got[("a", "b"), ("c",)] == (0.4, 0.4 / 0.6, 0.4 / 0.6 / 0.8)
    texts = {r["rule"] for r in toy_rules.collect()}
    assert "a, b -> c" in texts


def test_all_splits_with_exact_metrics(itemsets, lines):
    assert as_dict(rl.generate_rules(itemsets)) == brute.rules(lines, 8)
    assert as_dict(rl.generate_rules(itemsets, levels=(3,))) == brute.rules(lines, 8, {3})


def test_confidence_cut_includes_its_bound(itemsets, lines):
    truth = brute.rules(lines, 8)
    bound = sorted(c for _, c, _ in truth.values())[len(truth) // 2]
    got = as_dict(rl.generate_rules(itemsets, min_confidence=bound))
    assert got == {r: m for r, m in truth.items() if m[1] >= bound}


def test_unique_and_sorted(toy_rules):
    doubled = rl.unique_rules(toy_rules.unionByName(toy_rules))
    rows = rl.sort_rules(doubled).collect()
    keys = [(-r["confidence"], -r["lift"], -r["support"], r["rule"]) for r in rows]
    assert len(rows) == 12 and keys == sorted(keys)


def test_extended_metrics(itemsets):
    rows = rl.extended_metrics(rl.generate_rules(itemsets)).collect()
    for r in rows:
        s, a, c = r["support"], r["antecedent_support"], r["consequent_support"]
        conf = s / a
        assert math.isclose(r["leverage"], s - a * c, abs_tol=1e-12)
        assert math.isclose(r["conviction"], (1 - c) / (1 - conf) if conf < 1 else math.inf)
        spread = max(s * (1 - a), a * (c - s))
        assert math.isclose(r["zhangs_metric"], (s - a * c) / spread if spread else 0.0, abs_tol=1e-12)
        assert math.isclose(r["jaccard"], s / (a + c - s))
        assert math.isclose(r["kulczynski"], (s / a + s / c) / 2)
        assert math.isclose(r["certainty"], (conf - c) / (1 - c) if c != 1 else 0.0, abs_tol=1e-12)


def test_extended_metrics_at_their_poles(spark):
    """Both items are in every basket: confidence 1, consequent support 1, spread 0."""
    lines = [("1", "a"), ("1", "b"), ("2", "a"), ("2", "b")]
    mined = its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 1).itemsets
    row = rl.library_rules(mined).first()
    assert (row["conviction"], row["zhangs_metric"], row["certainty"]) == (math.inf, 0.0, 0.0)
    assert row["antecedent support"] == row["consequent support"] == 1.0


def test_query_rules(itemsets):
    rules = rl.library_rules(itemsets, min_confidence=0.0)
    every = rules.collect()
    got = rl.query_rules(rules, 0.5, 0.9, keyword="  I3 ", limit=5)
    want = [
        r
        for r in every
        if r["confidence"] >= 0.5 and r["lift"] >= 0.9
        and ("i3" in r["antecedents"] or "i3" in r["consequents"])
    ]
    want.sort(key=lambda r: (-r["confidence"], r["antecedents"], r["consequents"]))
    assert got.columns == list(rl.BROWSER_COLUMNS)
    assert [tuple(r) for r in got.collect()] == [
        tuple(r[c] for c in rl.BROWSER_COLUMNS) for r in want[:5]
    ]
    rising = rl.query_rules(rules, 0, 0, columns=["leverage"], sort_by="leverage", descending=False)
    values = [r[0] for r in rising.collect()]
    assert values == sorted(r["leverage"] for r in every)[:20]
    assert rl.query_rules(rules, columns=["nothing"]).columns == list(rl.BROWSER_FALLBACK)
    assert rl.query_rules(rules, 0, 0, sort_by="nothing", limit=3).count() == 3
    spaced = rl.query_rules(rules, 0, 0, columns=["antecedent support"], sort_by="consequent support")
    assert spaced.columns == ["antecedent support"]
    assert rl.query_rules(rules, keyword=".*").count() == 0


def test_rankings(itemsets):
    rows = itemsets.collect()
    got = topn.top_itemsets_per_level(itemsets, 2).collect()
    for k in {r["k"] for r in rows}:
        level = sorted((-r["count"], r["itemset_text"]) for r in rows if r["k"] == k)[:2]
        assert [(-r["count"], r["itemset_text"]) for r in got if r["k"] == k] == level
    best = [r["itemset_text"] for r in topn.top_itemsets(itemsets, 3).collect()]
    assert best == [t for _, t in sorted((-r["support"], r["itemset_text"]) for r in rows)[:3]]
    rules = rl.generate_rules(itemsets)
    ranked = sorted((-r["confidence"], -r["lift"], -r["support"], r["rule"]) for r in rules.collect())
    assert [r["rule"] for r in topn.top_rules(rules).collect()] == [t[3] for t in ranked[:10]]


def test_top_n_limits_each_task_before_the_shuffle(itemsets):
    plan = topn.top_itemsets_per_level(itemsets)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_shown_tables_have_five_rows_at_most(itemsets):
    assert topn.display_rows(itemsets).count() == 5
    assert topn.display_rows(itemsets, 20).count() == min(20, itemsets.count())
    assert topn.display_rows(itemsets, 2).count() == 2


@pytest.mark.parametrize("bound", [0.05, 0.5, 0.8, 1.0])
def test_grown_consequents_give_the_same_rules(itemsets, lines, monkeypatch, bound):
    monkeypatch.setattr(rl, "SPLIT_WHOLE", 1)
    got = as_dict(rl.generate_rules(itemsets, min_confidence=bound))
    assert got == {r: m for r, m in brute.rules(lines, 8).items() if m[1] >= bound}


def every_subset(spark, n, support):
    """All sets of ``n`` items, with a support that follows from the set's size."""
    names = "array(" + ", ".join(f"'i{j:02}'" for j in range(n)) + ")"
    sets = spark.range(1, 1 << n).selectExpr(f"filter({names}, (x, j) -> (shiftright(id, j) & 1) = 1) AS itemset")
    return sets.selectExpr("size(itemset) AS k", "itemset", f"CAST({support} * 100 AS BIGINT) AS count", f"{support} AS support")


def test_a_long_set_is_not_split_in_all_ways(spark, monkeypatch):
    """Confidence falls with the consequent: of 16,382 splits only those of one and two items are looked at."""
    n, looked_at = 14, []
    plain = rl._look_up

    def counting(splits, itemsets, name):
        if name == "antecedent":
            looked_at.append(splits.count())
        return plain(splits, itemsets, name)

    monkeypatch.setattr(rl, "_look_up", counting)
    itemsets = every_subset(spark, n, "pow(0.95D, size(itemset))")
    rules = rl.generate_rules(itemsets, levels=(n,), min_confidence=0.94)
    assert rules.count() == n
    assert sum(looked_at) == n + n * (n - 1) // 2 and sum(looked_at) < 0.01 * (2**n - 2)


def test_no_exchange_by_arrays_and_balanced_sides(spark):
    """Every pair holds the best seller; its side is dealt to many tasks by the copies of its support."""
    items = 400
    pairs = [(2, ["best", f"i{j:03}"], 10, 0.1) for j in range(items)]
    single = [(1, [f"i{j:03}"], 20, 0.2) for j in range(items)] + [(1, ["best"], 90, 0.9)]
    itemsets = spark.createDataFrame(single + pairs, "k int, itemset array<string>, count long, support double")
    for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        rules = rl.generate_rules(itemsets)
        plan = rules._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        assert keys and all(re.fullmatch(r"\w+_key#\d+L, \w+_copy#\d+, \d+", k) for k in keys)
        splits = itemsets.filter("k = 2").selectExpr("*", "explode(sequence(1L, 2L)) AS mask")
        found = rl._look_up(splits.withColumn("antecedent", rl._side(1)), itemsets, "antecedent")
        sizes = [r["count"] for r in found.selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * sorted(sizes)[1]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
