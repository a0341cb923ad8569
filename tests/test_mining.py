"""Baskets and levels: golden toys, brute force, an independent miner, skew, and large candidate sets."""

import random
from dataclasses import replace

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from basketry.functions.thresholds import absolute_support
from basketry.operators import baskets as bk
from basketry.operators import candidates as cd
from basketry.operators import counting
from basketry.operators import itemsets as its
from basketry.session import materialize
from tests import brute
from tests.conftest import TESTDATA
from workloads import views

LINES = "basket_id string, item string"


def as_dict(itemsets):
    return {tuple(r["itemset"]): r["count"] for r in itemsets.collect()}


def random_lines(seed, n_baskets=60, n_items=9):
    rng = random.Random(seed)
    return [
        (f"b{b}", f"i{i}")
        for b in range(n_baskets)
        for i in rng.sample(range(n_items), rng.randint(0, n_items))
        for _ in range(rng.randint(1, 2))
    ]


def test_toy(spark, toy_lines):
    tx = bk.transactions(toy_lines)
    result = its.mine_itemsets(tx, 2, max_k=3)
    assert tx.n == 5
    assert as_dict(result.itemsets) == {
        ("a",): 4, ("b",): 4, ("c",): 4,
        ("a", "b"): 3, ("a", "c"): 3, ("b", "c"): 3,
        ("a", "b", "c"): 2,
    }
    row = result.itemsets.filter("k = 3").first()
    assert (row["itemset_text"], row["support"]) == ("a, b, c", 0.4)
    funnel = [tuple(r) for r in its.level_funnel(result).collect()]
    assert funnel == [(1, None, 3), (2, 3, 3), (3, 1, 1)]
    totals = its.run_totals(result).first()
    assert (totals["max_k"], totals["total_freq"]) == (3, 7)
    assert totals["per_k"] == {1: 3, 2: 3, 3: 1}
    assert totals["per_k_text"] == "L1=3, L2=3, L3=1"


@pytest.mark.parametrize("seed,min_count,max_k", [(1, 5, 10), (2, 12, None), (3, 1, 4), (4, 20, 2)])
def test_matches_brute_force(spark, seed, min_count, max_k):
    lines = random_lines(seed)
    result = its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), min_count, max_k)
    assert as_dict(result.itemsets) == brute.frequent(lines, min_count, max_k)


@pytest.mark.parametrize("item,ratio", [("StockCode", 0.002), ("Brand", 0.005)])
def test_matches_an_independent_miner(spark, item, ratio):
    lines = views.invoice_lines(spark, TESTDATA).filter("Quantity > 0").select(
        F.col("InvoiceNo").alias("basket_id"), F.col(item).alias("item")
    )
    tx = bk.transactions(lines)
    min_count = absolute_support(tx.n, ratio)
    mined = as_dict(its.mine_itemsets(tx, min_count, None).itemsets)
    model = FPGrowth(itemsCol="items", minSupport=(min_count - 0.5) / tx.n).fit(bk.build_baskets(lines))
    other = {tuple(sorted(r["items"])): r["freq"] for r in model.freqItemsets.collect()}
    assert mined == other


def test_anti_monotone(spark):
    lines = random_lines(5)
    sets = as_dict(its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 6).itemsets)
    for whole, count in sets.items():
        for i in range(len(whole)):
            rest = whole[:i] + whole[i + 1 :]
            assert not rest or sets[rest] >= count


@pytest.mark.parametrize(
    "lines,min_count,want",
    [
        ([], 1, {}),
        ([("1", "a")], 1, {("a",): 1}),
        ([("1", "a"), ("1", "b")], 1, {("a",): 1, ("b",): 1, ("a", "b"): 1}),
        ([("1", "a"), ("2", "b")], 2, {}),
    ],
)
def test_degenerate_inputs(spark, lines, min_count, want):
    result = its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), min_count)
    assert as_dict(result.itemsets) == want
    totals = its.run_totals(result).first()
    assert totals["total_freq"] == len(want)
    its.level_funnel(result).collect()


def test_max_k_one(spark, toy_lines):
    result = its.mine_itemsets(bk.transactions(toy_lines), 2, max_k=1)
    assert set(as_dict(result.itemsets)) == {("a",), ("b",), ("c",)}


def test_item_text_with_the_separator_inside(spark):
    lines = [("1", "a, b"), ("1", "c"), ("2", "a"), ("2", "b"), ("2", "c"), ("3", "a, b"), ("3", "c")]
    mined = its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 1).itemsets
    assert as_dict(mined) == brute.frequent(lines, 1)


def test_joined_candidates_are_pruned(spark):
    level2 = spark.createDataFrame([(1, 2, 9), (1, 3, 9), (2, 3, 9), (2, 4, 9)], "i1 int, i2 int, count long")
    assert [tuple(r) for r in cd.join_candidates(level2, 3).collect()] == [(1, 2, 3)]
    level3 = spark.createDataFrame(
        [(1, 2, 3), (1, 2, 4), (1, 3, 4), (2, 3, 4), (1, 2, 5), (1, 3, 5)], "i1 int, i2 int, i3 int"
    )
    assert [tuple(r) for r in cd.join_candidates(level3, 4).collect()] == [(1, 2, 3, 4)]


def test_overlap_candidates_are_not_pruned(spark):
    level2 = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (2, 4), (5, 6)], "i1 int, i2 int")
    got = sorted(tuple(r) for r in cd.overlap_candidates(level2).collect())
    assert got == [(1, 2, 3), (1, 2, 4), (2, 3, 4)]


@pytest.mark.parametrize("neighbours", [1, 3, 1024])
def test_overlap_by_blocks_of_neighbours(spark, neighbours):
    rng = random.Random(neighbours)
    pairs = {(0, i) for i in range(1, 30)} | {tuple(sorted(rng.sample(range(40), 2))) for _ in range(30)}
    level2 = spark.createDataFrame(sorted(pairs), "i1 int, i2 int")
    got = [tuple(r) for r in cd.overlap_candidates(level2, neighbours).collect()]
    want = {tuple(sorted({*x, *y})) for x in pairs for y in pairs if len({*x, *y}) == 3}
    assert sorted(got) == sorted(want)


def test_a_best_seller_in_all_pairs_is_spread(spark):
    """One item in every frequent pair: the join's largest task has under twice the median's rows."""
    level2 = spark.range(1, 3001).selectExpr("0 AS i1", "CAST(id AS INT) AS i2")
    for key, value in (("spark.sql.adaptive.enabled", "false"), ("spark.sql.autoBroadcastJoinThreshold", "-1")):
        spark.conf.set(key, value)
    try:
        joined = cd.neighbour_pairs(level2, 128).groupBy(F.spark_partition_id()).count().collect()
        sizes = sorted(r["count"] for r in joined)
        assert sum(sizes) == 3000 * 2999 // 2 and len(sizes) == 4 and sizes[-1] < 2 * sizes[len(sizes) // 2 - 1]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_presence_vectors_hold_the_long_form(spark):
    from pyspark.ml.linalg import VectorUDT

    lines = spark.createDataFrame(random_lines(17) + [("x", "i1"), ("x", "i1")], LINES)
    found = bk.presence_vectors(lines)
    assert isinstance(found.vectors.schema["features"].dataType, VectorUDT)
    names = {r["id"]: r["item"] for r in found.dictionary.collect()}
    rows = {(r["basket_id"], names[i]) for r in found.vectors.collect() for i in r["features"].indices.tolist()}
    presence = {tuple(r) for r in bk.presence(lines).collect()}
    assert rows == presence == {tuple(r) for r in found.entries().collect()}
    assert {len(r["features"]) for r in found.vectors.collect()} == {found.n_items}
    assert bk.presence_vectors(lines.limit(0)).vectors.count() == 0


def test_steps_count_zero_and_infrequent_candidates(spark):
    """c is never with d; a-b is infrequent although a-b-e is a union of a-e and b-e."""
    lines = [(str(b), i) for b, items in enumerate(["ae", "ae", "be", "be", "abe", "c", "c", "d", "d"]) for i in items]
    steps = its.level_steps(bk.transactions(spark.createDataFrame(lines, LINES)), 2)
    counts = {tuple(r["itemset"]): r["count"] for r in steps.c2.collect()}
    assert counts == {("a", "e"): 3, ("b", "e"): 3, ("a", "b"): 1}
    encoded = bk.encode_baskets(bk.transactions(spark.createDataFrame(lines, LINES)), 2)
    every = {tuple(r["itemset"]): r["count"] for r in its.pair_level(encoded, absent=True)[0].collect()}
    assert len(every) == 10 and every["c", "d"] == 0 and every["a", "b"] == 1
    assert {tuple(r["itemset"]): r["count"] for r in steps.l2.collect()} == {("a", "e"): 3, ("b", "e"): 3}
    assert {tuple(r["itemset"]): r["count"] for r in steps.c3.collect()} == {("a", "b", "e"): 1}
    assert steps.l3.count() == 0
    assert steps.dropped_l1.count() == 0 and steps.c1.count() == steps.l1.count() == 5


@pytest.mark.parametrize("seed", [7, 8])
def test_steps_match_brute_force(spark, seed):
    lines = random_lines(seed, n_baskets=40)
    truth = brute.supports(lines, 3)
    min_count = 13
    steps = its.level_steps(bk.transactions(spark.createDataFrame(lines, LINES)), min_count)
    for k, level in ((1, steps.l1), (2, steps.l2), (3, steps.l3)):
        got = {tuple(r["itemset"]): r["count"] for r in level.collect()}
        assert got == {s: c for s, c in truth.items() if len(s) == k and c >= min_count}
    pairs = [s for s, c in truth.items() if len(s) == 2 and c >= min_count]
    unions = {tuple(sorted({*x, *y})) for x in pairs for y in pairs if len({*x, *y}) == 3}
    got = {tuple(r["itemset"]): r["count"] for r in steps.c3.collect()}
    assert got == {s: truth.get(s, 0) for s in unions}


def test_steps_without_any_pair(spark):
    steps = its.level_steps(bk.transactions(spark.createDataFrame([("1", "a"), ("2", "b")], LINES)), 1)
    assert steps.c2.count() == steps.l2.count() == steps.c3.count() == steps.l3.count() == 0


def test_items_in_many_baskets_are_counted_in_shares(spark, monkeypatch):
    """An item in more baskets than a group holds is counted in several groups, with the same result."""
    lines = random_lines(9, n_baskets=40, n_items=7)
    df = spark.createDataFrame(lines, LINES)
    want = brute.frequent(lines, 5, 4)
    monkeypatch.setattr(counting, "BASKETS_PER_GROUP", 4)
    assert as_dict(its.mine_itemsets(bk.transactions(df), 5, max_k=4).itemsets) == want
    steps = its.level_steps(bk.transactions(df), 5)
    assert {tuple(r["itemset"]): r["count"] for r in steps.l3.collect()} == {
        s: c for s, c in want.items() if len(s) == 3
    }


def test_heads_are_shuffled_once(spark, monkeypatch):
    """The written heads know their groups: mining them and counting candidates in them needs no exchange of baskets."""
    monkeypatch.setattr(counting, "BASKETS_PER_GROUP", 4)
    tx = bk.transactions(spark.createDataFrame(random_lines(10), LINES))
    encoded = replace(bk.encode_baskets(tx, 5), tasks=3)
    pairs, n_pairs = counting.frequent(counting.count_pairs(encoded), 5)
    edges = pairs.selectExpr("i1 AS item", "i2 AS last")
    found, split = counting.heads(encoded, edges, n_pairs)
    assert split
    dealt = counting._dealt(encoded, found)

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    mined = dealt.groupBy("last", "share").applyInArrow(lambda table: table, dealt.schema)
    assert "Exchange" not in plan(mined)
    sets = spark.createDataFrame([(1, 5, [0, 1, 5])], "number long, last int, items array<int>")
    counted = plan(counting._count_sets(encoded, dealt, sets))
    assert "Bucketed: true" in counted and counted.count("Exchange hashpartitioning(last") == 1  # the sets' side
    counts = counting.count_candidates(encoded, spark.createDataFrame([(0, 1, 5), (0, 2, 3)], "i1 int, i2 int, i3 int"), 3)
    whole = {(r.i1, r.i2, r.i3): r["count"] for r in counts.collect()}
    baskets = [set(r["items"]) for r in encoded.baskets.collect()]
    assert whole == {c: n for c in ((0, 1, 5), (0, 2, 3)) if (n := sum({*c} <= b for b in baskets))}


def test_edges_in_rounds(spark, monkeypatch):
    lines = random_lines(14)
    monkeypatch.setattr(counting, "EDGES_AT_ONCE", 5)
    mined = its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 4).itemsets
    assert as_dict(mined) == brute.frequent(lines, 4)


def test_names_beyond_the_plan_are_joined(spark, monkeypatch):
    lines = random_lines(15)
    monkeypatch.setattr(bk, "NAMES_IN_PLAN", 3)
    mined = its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 6).itemsets
    assert as_dict(mined) == brute.frequent(lines, 6)


def test_names_with_any_character(spark):
    names = ["a b", "a b", "x", "\U000f0000", "it's", "a|b.*[c]", "", " ", "é\n"]
    lines = [(str(b), name) for b in range(3) for name in names]
    assert as_dict(its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 2, 2).itemsets) == brute.frequent(lines, 2, 2)


def test_hot_basket_and_hot_item(spark):
    """One basket holds a third of all rows and one item is in every basket."""
    hot = [("hot", f"i{n % 40}") for n in range(400)]
    rest = [(f"b{b}", i) for b in range(400) for i in ("i0", f"i{b % 40}")]
    lines = hot + rest
    tx = bk.transactions(spark.createDataFrame(lines, LINES).repartition(8))
    assert tx.n == 401
    mined = as_dict(its.mine_itemsets(tx, 5, max_k=2).itemsets)
    assert mined == brute.frequent(lines, 5, 2)


def test_dictionary_is_dense_and_ordered_over_partitions(spark):
    lines = [(f"b{b}", f"i{i:03}") for i in range(200) for b in range(i % 7 + 1)]
    tx = bk.transactions(spark.createDataFrame(lines, LINES))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dictionary, n_items, entries, *_ = bk.item_dictionary(bk.item_counts(tx))
        rows = [tuple(r) for r in dictionary.orderBy("id").collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    order = sorted(((-(i % 7 + 1), f"i{i:03}") for i in range(200)))
    assert rows == [(n, item, -c) for n, (c, item) in enumerate(order)]
    assert (n_items, entries) == (200, sum(-c for c, _ in order))


def test_counting_tasks_follow_the_entries():
    assert bk._counting_tasks(0, 8) == 1
    assert bk._counting_tasks(120_000, 8) == 3
    assert bk._counting_tasks(10_000_000, 8) == 8
    assert bk._counting_tasks(200_000_000_000, 8) == 10_000


def test_baskets_presence_and_counts(spark):
    lines = spark.createDataFrame([("1", "b"), ("1", "a"), ("1", "a"), ("2", "c")], LINES)
    got = {r["basket_id"]: r["items"] for r in bk.build_baskets(lines).collect()}
    assert got == {"1": ["a", "b"], "2": ["c"]}
    assert bk.presence(lines).count() == 3
    assert tuple(bk.dataset_counts(lines).first()) == (2, 3)


def test_candidate_joins_broadcast_small_levels(spark):
    tx = bk.transactions(spark.createDataFrame(random_lines(11), LINES))
    sets = materialize(its.mine_sets(bk.encode_baskets(tx, 3), max_k=3))
    plan = cd.join_candidates(its.level_of(sets, 3), 4)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_same_result_without_broadcast_joins(spark):
    """With every join shuffled: what happens once a dictionary or level is too large to broadcast."""
    lines = random_lines(12)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 8)
        assert as_dict(result.itemsets) == brute.frequent(lines, 8)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_given_depth_is_reported_when_it_cuts_off(spark, toy_lines):
    tx = bk.transactions(toy_lines)
    assert its.mine_itemsets(tx, 2, max_k=2).cut_off
    assert not its.mine_itemsets(tx, 2).cut_off
    assert not its.mine_itemsets(tx, 100, max_k=2).cut_off


def test_restricted_baskets_mine_alike(spark):
    lines = random_lines(13)
    encoded = bk.encode_baskets(bk.transactions(spark.createDataFrame(lines, LINES)), 3)
    for min_count in (3, 8, 15):
        found = its.mine_encoded(bk.restrict(encoded, min_count))
        assert as_dict(found.itemsets) == brute.frequent(lines, min_count)
