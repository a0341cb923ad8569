"""Numbers of frequent sets per level that were computed independently of this engine."""

import pytest

from basketry.functions.thresholds import absolute_support
from basketry.operators import baskets as bk
from basketry.operators import itemsets as its
from basketry.operators import rules as rl
from basketry.operators.clean import clean_lines
from workloads import views

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

# tables, profile, item, baskets, [(ratio, mode, absolute, sets per level)]
INVOICES = [
    (SMALL, "A", "StockCode", 1395, [(0.01, "ceil", 14, [6, 15, 20, 15, 1])]),
    (SMALL, "B", "StockCode", 1338, [(0.01, "ceil", 14, [6, 15, 20, 10])]),
    (
        MEDIUM, "A", "StockCode", 13972,
        [
            (0.05, "ceil", 699, [6, 15, 6]),
            (0.02, "ceil", 280, [6, 15, 20]),
            (0.005, "ceil", 70, [6, 15, 20, 15, 6]),
            (0.002, "ceil", 28, [6, 15, 20, 15, 6, 1]),
        ],
    ),
    (MEDIUM, "C", "StockCode", 13506, [(0.01, "ceil", 136, [6, 15, 20, 14])]),
    (
        MEDIUM, "A", "Brand", 13972,
        [(0.01, "ceil", 140, [25, 188]), (0.01, "floor", 139, [25, 196]), (0.002, "floor", 27, [25, 300, 30])],
    ),
    (MEDIUM, "B", "Brand", 13506, [(0.01, "ceil", 136, [25, 49])]),
]


def per_level(result):
    return [n for _, n in sorted(result.itemsets.groupBy("k").count().collect())]


@pytest.mark.parametrize("sf_dir,profile,item,n,runs", INVOICES)
def test_invoices(spark, sf_dir, profile, item, n, runs):
    lines = clean_lines(views.invoice_lines(spark, sf_dir), profile, item_col=item)
    tx = bk.transactions(lines)
    assert tx.n == n
    for ratio, mode, absolute, levels in runs:
        assert absolute_support(n, ratio, mode) == absolute
        assert per_level(its.mine_itemsets(tx, absolute)) == levels


@pytest.mark.parametrize(
    "view,n,absolute,levels,n_rules,labels",
    [
        (views.user_events, 150, 8, [5, 10, 10, 5, 1], 180, {"strong + unuseful": 180}),
        (
            views.customer_baskets, 1500, 75, [6, 15, 20, 15, 6, 1], 602,
            {"strong + useful": 600, "strong + unuseful": 2},
        ),
    ],
)
def test_dense_views(spark, view, n, absolute, levels, n_rules, labels):
    tx = bk.transactions(view(spark, MEDIUM))
    assert tx.n == n and absolute_support(n, 0.05) == absolute
    result = its.mine_itemsets(tx, absolute)
    assert per_level(result) == levels
    rules = rl.label_rules(rl.generate_rules(result.itemsets))
    assert dict(rules.groupBy("interpretation").count().collect()) == labels
    assert rules.count() == n_rules
