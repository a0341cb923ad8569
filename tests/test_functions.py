"""Thresholds, formatting, and the counting kernels against plain Python."""

from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.functions import bitmaps, text
from basketry.functions.thresholds import absolute_support, absolute_support_column


def test_published_thresholds_are_floors():
    ratios = (0.05, 0.02, 0.01, 0.005)
    assert [absolute_support(20728, r, "floor") for r in ratios] == [1036, 414, 207, 103]
    assert [absolute_support(20728, r, "ceil") for r in ratios] == [1037, 415, 208, 104]


def test_binary_noise_is_kept_per_mode():
    assert absolute_support(100, 0.07, "ceil") == 8
    assert absolute_support(100, 0.29, "floor") == 28
    assert absolute_support(100, 0.07, "ratio") == 7
    assert absolute_support(0, 0.5) == absolute_support(0, 0.5, "ratio") == 1
    with pytest.raises(ValueError):
        absolute_support(1, 0.5, "round")


@given(st.integers(1, 10**7), st.floats(1e-6, 1.0))
def test_ratio_mode_is_the_smallest_count_reaching_the_ratio(n, ratio):
    count = absolute_support(n, ratio, "ratio")
    assert count / n >= ratio
    assert count == 1 or (count - 1) / n < ratio


def test_column_form_agrees(spark):
    cases = [(n, r) for n in (1, 7, 100, 13972, 20728) for r in (0.005, 0.01, 0.07, 0.29, 0.5, 1.0)]
    df = spark.createDataFrame(cases, "n bigint, r double")
    for mode in ("ceil", "floor", "ratio"):
        column = absolute_support_column(F.col("n"), F.col("r"), mode)
        got = [row[0] for row in df.select(column).collect()]
        assert got == [absolute_support(n, r, mode) for n, r in cases]


def test_number_text(spark):
    values = [0.125, 1.005, 0.03125, 12345.678, 0.0, 1.0, 0.7, 2 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    v = F.col("v")
    rows = df.select(
        text.fixed(v, 2), text.fixed(v, 4), text.percent(v), text.fixed_with_percent(v)
    ).collect()
    for value, row in zip(values, rows):
        assert tuple(row) == (
            f"{value:.2f}",
            f"{value:.4f}",
            f"{value * 100:.2f}%",
            f"{value:.4f} ({value * 100:.2f}%)",
        )


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("3.9",), (None,), ("x",)], "v string")
    rows = df.select(text.fixed(F.col("v"), 1), text.safe_count(F.col("v"))).collect()
    assert [tuple(r) for r in rows] == [("3.9", 3), ("0.0", 0), ("0.0", 0)]
    nan = spark.createDataFrame([(float("nan"),)], "v double")
    assert nan.select(text.safe_count(F.col("v"))).first()[0] == 0


def test_labels(spark):
    df = spark.createDataFrame(
        [(0.7, 1.0), (0.7, 1.01), (0.69, 1.0), (0.69, 1.5)], "c double, l double"
    )
    got = [r[0] for r in df.select(text.interpretation(F.col("c"), F.col("l"))).collect()]
    assert got == ["strong + unuseful", "strong + useful", "weak + unuseful", "weak + useful"]


# --- kernels --------------------------------------------------------------------------------------

baskets = st.lists(st.sets(st.integers(0, 9), max_size=8).map(sorted), min_size=1, max_size=150)


def batch(rows, skip=0):
    column = pa.array([[0]] * skip + rows, pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays([column.slice(skip)], names=["items"])


def totals(batches, k):
    out = {}
    for b in batches:
        *ids, n = (c.to_pylist() for c in b.columns)
        for key, count in zip(zip(*ids), n):
            out[key] = out.get(key, 0) + count
    return out


def truth(rows, k):
    out = {}
    for row in rows:
        for s in combinations(row, k):
            out[s] = out.get(s, 0) + 1
    return out


@settings(deadline=None)
@given(baskets, st.sampled_from([10, 4000]), st.sampled_from([0, 10**9]), st.integers(0, 3))
def test_pairs(rows, n_items, pair_in_words, skip):
    """Dense or sparse (by the weight of a pair), with sums kept per task or, for many items, per batch."""
    counter = bitmaps.pair_counter(n_items, pair_in_words)
    got = totals(counter(iter([batch(rows, skip), batch(rows[:7])])), 2)
    assert got == truth(rows + rows[:7], 2)


def test_large_batches_are_cut(monkeypatch):
    """The memory bound cuts blocks and the row bound cuts emitted batches; sums stay the same."""
    rows = [sorted({i % 9, (i * 7) % 9, (i * i) % 9}) for i in range(500)]
    monkeypatch.setattr(bitmaps, "LARGEST", 100)
    monkeypatch.setattr(bitmaps, "STEP", 5)
    for weight in (0, 10**9):
        got = list(bitmaps.pair_counter(9, weight)(iter([batch(rows)])))
        assert len(got) > 5 and totals(got, 2) == truth(rows, 2)


def test_empty_batches():
    assert list(bitmaps.pair_counter(3)(iter([batch([])]))) == []


def test_fixed_prints_like_c(spark):
    random = np.random.default_rng(5)
    values = np.concatenate(
        [
            random.uniform(-2, 2, 20_000),
            random.uniform(-1e6, 1e6, 20_000),
            random.integers(-(10**7), 10**7, 20_000) / 2.0 ** random.integers(0, 12, 20_000),
            10.0 ** random.uniform(-9, 9, 20_000),
            random.integers(0, 10**6, 20_000) / 10.0 ** random.integers(0, 7, 20_000),
            [5e-5, 0.125, 2.5, 0.5, 1.5, -0.00001, -0.0, 0.0, float("inf"), -float("inf"), float("nan"), 1e15, 1e22],
        ]
    )
    df = spark.createDataFrame(pd.DataFrame({"x": values}))
    for digits in (0, 2, 4, 6):
        got = df.select("x", text.fixed(F.col("x"), digits).alias("t")).toPandas()
        want = [f"{x:.{digits}f}" for x in values]
        wrong = [(x, g, w) for x, g, w in zip(values, got["t"], want, strict=True) if g != w]
        assert not wrong, wrong[:5]


def test_tiles_send_each_pair_once_for_all_held_entries():
    """20,000 items: a task's rows are its distinct pairs, however many batches bring them."""
    random = np.random.default_rng(8)
    rows = [sorted(random.choice(20_000, 12, replace=False).tolist()) for _ in range(60)] * 4
    parts = [batch(rows[lo : lo + 20]) for lo in range(0, len(rows), 20)]
    got = list(bitmaps.pair_counter(20_000)(iter(parts)))
    assert totals(got, 2) == truth(rows, 2)
    assert sum(b.num_rows for b in got) == len(truth(rows, 2))
