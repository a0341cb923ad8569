"""Threshold sweeps, result tables and summaries."""

import pytest

from basketry.functions.thresholds import absolute_support
from basketry.operators import baskets as bk
from basketry.operators import itemsets as its
from basketry.operators import rules as rl
from basketry.plans import sweep as sw
from basketry.plans import tables as tb
from basketry.plans import workflow
from basketry.plans.summary import summary_metrics
from tests import brute
from tests.test_mining import LINES, random_lines

RATIOS = (0.3, 0.1, 0.2, 0.9)


@pytest.fixture(scope="module")
def lines():
    return random_lines(31)


@pytest.fixture(scope="module")
def tx(spark, lines):
    return bk.transactions(spark.createDataFrame(lines, LINES))


@pytest.fixture(scope="module")
def swept(tx):
    return sw.sweep(tx, RATIOS, max_k=3)


def per_threshold(lines, n):
    for pos, ratio in enumerate(RATIOS):
        yield pos, ratio, absolute_support(n, ratio, "floor")


def test_one_mining_run_equals_one_per_threshold(swept, tx, lines):
    got = {}
    for r in swept.itemsets.collect():
        got.setdefault(r["list_pos"], {})[tuple(r["itemset"])] = r["count"]
    for pos, _, min_count in per_threshold(lines, tx.n):
        assert got.get(pos, {}) == brute.frequent(lines, min_count, 3)


def test_summary_lists_empty_thresholds(swept, tx, lines):
    rows = [tuple(r) for r in sw.sweep_summary(swept).collect()]
    want = []
    for _, ratio, min_count in per_threshold(lines, tx.n):
        sets = brute.frequent(lines, min_count, 3)
        sizes = [sum(len(s) == k for s in sets) for k in (1, 2, 3)]
        want.append((ratio, min_count, *sizes))
    assert rows == sorted(want)
    assert rows[-1][2:] == (0, 0, 0)
    first = sw.first_thresholds(sw.sweep_summary(swept), 2).collect()
    assert [r["min_support"] for r in first] == [0.1, 0.2]


def test_correlated_itemsets(swept, tx, lines):
    listed = {}
    for pos, ratio, min_count in per_threshold(lines, tx.n):
        sets = brute.frequent(lines, min_count, 3)
        for k in (2, 3):
            level = sorted((-c, " + ".join(s), s) for s, c in sets.items() if len(s) == k)
            for count, text, s in level[:4]:
                listed.setdefault(s, (count, text, len(s), -count / tx.n, -count, ratio))
    want = [v[1:] for v in sorted(listed.values())[:6]]
    got = [tuple(r) for r in sw.correlated_itemsets(swept, per_level=4, n=6).collect()]
    assert got == want


def test_valuable_rules_and_best_threshold(swept, tx, lines):
    truth, valuable = {}, {}
    for pos, _, min_count in per_threshold(lines, tx.n):
        rules = [
            (-c, -lift, -s, " + ".join(x) + " -> " + " + ".join(y))
            for (x, y), (s, c, lift) in brute.rules(lines, min_count, {2, 3}).items()
        ]
        good = [r for r in rules if -r[0] >= 0.7 and -r[1] > 1.0]
        valuable[pos] = bool(good)
        truth[pos] = [r[3] for r in sorted(good or rules)[:10]]
    rules = sw.sweep_rules(swept)
    table = sw.valuable_rules(rules)
    got = {}
    for r in sorted(table.collect(), key=lambda r: (r["list_pos"], r["rank"])):
        got.setdefault(r["list_pos"], []).append(r["rule"])
    assert got == {pos: r for pos, r in truth.items() if r}
    assert set(valuable.values()) == {True, False}  # both branches are exercised
    winner = max(truth, key=lambda pos: (len(truth[pos]), -pos))
    best = sw.best_threshold(table).first()
    assert (best["min_support"], best["n_rules"]) == (RATIOS[winner], len(truth[winner]))
    assert [r["rule"] for r in sw.best_rules(table).collect()] == truth[winner]


def test_no_rules_at_all(spark):
    tx = bk.transactions(spark.createDataFrame([("1", "a"), ("2", "b")], LINES))
    swept = sw.sweep(tx, (0.5, 0.9))
    table = sw.valuable_rules(sw.sweep_rules(swept))
    assert table.count() == sw.best_threshold(table).count() == sw.correlated_itemsets(swept).count() == 0


def test_timed_thresholds(spark, toy_lines):
    runs = sw.time_thresholds(bk.transactions(toy_lines), (0.4, 0.8), max_k=3)
    rows = {r["min_support"]: r for r in runs.collect()}
    assert rows[0.4]["total_freq"] == 7 and rows[0.8]["total_freq"] == 3
    assert (rows[0.4]["l1_count"], rows[0.4]["l2_count"], rows[0.4]["l3_count"]) == (3, 3, 1)
    known = spark.createDataFrame(
        [(0.1, 2.0), (0.2, 2.0), (0.3, 1.0), (0.4, 1.0)], "min_support double, execution_time_sec double"
    )
    assert tuple(sw.slowest_and_fastest(known).first()) == (0.1, 2.0, 0.3, 1.0)


def test_threshold_modes(spark, toy_lines):
    table = sw.threshold_modes(bk.dataset_counts(toy_lines), (0.3, 0.6), ("ceil", "floor", "ratio"))
    assert [tuple(r) for r in table.collect()] == [(0.3, 5, 2, 1, 2), (0.6, 5, 3, 3, 3)]


def test_summary_metrics(tx, lines, spark):
    kept = spark.createDataFrame(lines, LINES)
    mined = its.mine_itemsets(tx, 30, None).itemsets
    rules = rl.library_rules(mined, 0.3)
    got = {r["metric"]: r["value"] for r in summary_metrics(kept, kept, mined, rules).collect()}
    truth = {r: m for r, m in brute.rules(lines, 30).items() if m[1] >= 0.3}
    sets = brute.frequent(lines, 30)
    assert got["rows"] == len(lines) and got["columns"] == 2
    assert got["transactions"] == tx.n and got["unique_items"] == 9
    assert got["frequent_itemsets"] == len(sets) and got["association_rules"] == len(truth)
    assert got["avg_support"] == round(sum(sets.values()) / tx.n / len(sets), 4)
    assert got["avg_lift"] == round(sum(m[2] for m in truth.values()) / len(truth), 4)
    none = {
        r["metric"]: r["value"]
        for r in summary_metrics(kept, kept, mined, rules.filter("confidence > 2")).collect()
    }
    assert none["avg_confidence"] == none["avg_lift"] == 0.0


# --- tables ---------------------------------------------------------------------------------------


def test_level_tables(spark, toy_lines):
    steps = its.level_steps(bk.transactions(toy_lines), 2)
    assert [tuple(r) for r in tb.c1_table(steps.c1).collect()][0] == ("a", 4, "80.00%")
    assert tb.c1_table(steps.c1).columns == ["Itemset", "Count", "Support"]
    assert [tuple(r) for r in tb.c2_table(steps.c2).collect()][0] == ("a, b", 3)
    assert tb.frequent_table(steps.l2).columns == ["itemsets", "Count", "Support"]
    assert tb.frequent_table(steps.l2.select("itemset")).columns == ["itemsets"]
    assert [tuple(r) for r in tb.c3_table(steps.c3).collect()] == [("a, b, c", 2, "40.00%")]
    dropped = tb.l1_dropped_table(steps.dropped_l1)
    assert dropped.columns == ["Dropped Itemset", "Quantity"] and dropped.count() == 0


def test_tables_accept_the_usual_names(spark):
    other = spark.createDataFrame([(["b", "a"], "7.9", 0.5)], "Itemset array<string>, qty string, Support double")
    assert tuple(tb.c1_table(other).first()) == ("a, b", 7, "50.00%")
    with pytest.raises(ValueError, match="no column for count"):
        tb.c2_table(other.drop("qty"))
    xy = spark.createDataFrame(
        [("a", "b", 0.12345, 0.7, 1.005)], "X string, Y string, support double, confidence double, lift double"
    )
    assert tuple(tb.rule_summary_table(xy).first()) == (
        "a -> b", "0.1235", "12.35%", "0.7000", "70.00%", "1.00", "strong + useful",
    )
    assert tuple(tb.rules_table(xy).first()) == ("a -> b", "0.7000 (70.00%)")
    with pytest.raises(ValueError, match="lacks lift"):
        tb.rule_summary_table(xy.drop("lift"))
    with pytest.raises(ValueError, match="no column for antecedent"):
        tb.rules_table(xy.drop("X"))
    with pytest.raises(ValueError, match="the input lacks"):
        tb.top_rules_table(xy)


def test_execution_table(spark):
    runs = spark.createDataFrame(
        [(0.005, 103, 1.5, 3, 2, 1)],
        "min_support double, abs_support_count long, execution_time_sec double, l1_count long, l2_count long, l3_count long",
    )
    assert tuple(tb.execution_table(runs).first()) == ("0.0050", 103, "1.500000", 3, 2, 1)
    assert tb.execution_table(runs.drop("execution_time_sec")).first()["Execution Time (s)"] is None
    detail = tb.execution_detail_table(runs)
    assert detail.columns == runs.columns
    assert tuple(detail.first()) == ("0.005", 103, "1.500000", 3, 2, 1)


# --- whole analyses -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def invoices(spark, lines):
    """The random lines as a file would hold them, with a return and a line without quantity."""
    rows = [(basket, item, "1", item) for basket, item in lines]
    rows += [("Cx", "i0", "-1", "i0"), ("b1", "only-a", None, None)]
    return spark.createDataFrame(
        rows, "InvoiceNo string, StockCode string, Quantity string, Description string"
    )


def test_benchmark(invoices, lines, tx):
    rows = workflow.benchmark(invoices, (0.2, 0.4)).collect()
    assert [(r["min_support"], r["abs_support_count"], r["n_txn"]) for r in rows] == [
        (0.2, absolute_support(tx.n, 0.2), tx.n),
        (0.4, absolute_support(tx.n, 0.4), tx.n),
    ]
    for r in rows:
        sets = brute.frequent(lines, r["abs_support_count"])
        assert r["total_freq"] == len(sets) and r["max_k"] == max(map(len, sets))
        assert r["per_k"] == {k: sum(len(s) == k for s in sets) for k in range(1, r["max_k"] + 1)}


def test_stepwise(invoices, lines, tx):
    got = workflow.stepwise(invoices, 0.3)
    min_count = absolute_support(tx.n, 0.3, "floor")
    truth = brute.supports(lines, 3)
    assert {r["Itemset"]: r["Count"] for r in got.c1.collect()} == {
        s[0]: c for s, c in truth.items() if len(s) == 1
    }
    want = {", ".join(s): c for s, c in truth.items() if len(s) == 3 and c >= min_count}
    assert {r["itemsets"]: r["Count"] for r in got.l3.collect()} == want
    rules = brute.rules(lines, min_count, {3})
    assert got.rules.count() == got.rule_summary.count() == len(rules)
    assert got.c2.count() == 36 and got.l1_dropped.count() == 0
    assert got.l2.count() == sum(len(s) == 2 and c >= min_count for s, c in truth.items())


def test_threshold_study(invoices, lines, tx, swept):
    got = workflow.threshold_study(invoices, RATIOS)
    assert got.execution.collect() == sw.sweep_summary(swept).collect()
    assert got.correlated.collect() == sw.correlated_itemsets(swept).collect()
    assert got.best_rules.count() == 10


def test_library_run(invoices, lines, tx):
    got = workflow.library_run(invoices, 0.4, 0.5)
    min_count = absolute_support(tx.n, 0.4, "ratio")
    assert got.itemsets.count() == len(brute.frequent(lines, min_count))
    truth = [m for m in brute.rules(lines, min_count).values() if m[1] >= 0.5]
    assert got.rules.count() == len(truth)
    metrics = {r["metric"]: r["value"] for r in got.summary.collect()}
    assert metrics["rows"] == len(lines) and metrics["columns"] == 4
    assert metrics["association_rules"] == len(truth)
    assert rl.query_rules(got.rules, 0.5, 0.0, limit=3).count() == min(3, len(truth))
