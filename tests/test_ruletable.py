"""The stored rule table against the browser over all rules, and what it reads."""

from __future__ import annotations

import re

import pytest

from basketry.operators import baskets as bk
from basketry.operators import itemsets as its
from basketry.operators import rules as rl
from basketry.operators import ruletable as rt
from basketry.session import new_table_path
from tests.test_mining import LINES, random_lines


@pytest.fixture(scope="module")
def mined(spark):
    lines = [(b, i.replace("i", "Item ")) for b, i in random_lines(41)]
    lines += [(f"z{n}", i) for n in range(12) for i in ("a, b", "Item 3", "ITEM x")]
    return its.mine_itemsets(bk.transactions(spark.createDataFrame(lines, LINES)), 9).itemsets


@pytest.fixture(scope="module")
def path(spark, mined):
    path = new_table_path(spark)
    rt.write_rule_table(mined, path, min_confidence=0.2, buckets=8)
    return path


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("keyword", ["", "item 3", " ITEM ", "x", "a, b", ",", "b, item", "nothing", "%", "item 3, item"])
@pytest.mark.parametrize(("confidence", "lift"), [(0.2, 0.0), (0.5, 1.0), (1.0, 0.5)])
def test_same_rows_as_the_browser(spark, mined, path, keyword, confidence, lift):
    rules = rl.library_rules(mined, min_confidence=0.2)
    for options in ({}, {"sort_by": "lift", "descending": False, "limit": None, "columns": ["antecedents", "consequents", "jaccard"]}):
        expected = rl.query_rules(rules, confidence, lift, keyword, **options)
        assert rows(rt.query_rule_table(spark, path, confidence, lift, keyword, **options)) == rows(expected)


def test_filters_prune_files(spark, path):
    whole = {r["f"] for r in spark.read.parquet(f"{path}/rules").selectExpr("input_file_name() AS f").distinct().collect()}
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        wanted = rt.stored_rules(spark, path, 0.9, 1.5, "item 3")
        plan = wanted._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    folders = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "tenths" in folders and "bucket" in folders
    assert "GreaterThanOrEqual(confidence,0.9)" in pushed and "GreaterThanOrEqual(lift,1.5)" in pushed
    buckets = re.search(r"bucket#\d+ (?:= |IN \()([\d,]+)", folders).group(1).split(",")
    opened = [f for f in whole if int(re.search(r"tenths=(\d+)", f)[1]) >= 8 and re.search(r"bucket=(\d+)", f)[1] in buckets]
    assert 0 < len(opened) < len(whole) / 3
