"""Several support thresholds over the same baskets.

Supports do not depend on the threshold, and a set frequent at a high threshold is frequent at every
lower one. So the baskets are mined once, at the lowest threshold, and each higher threshold is a filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from time import perf_counter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.text import REPORT_SEPARATOR
from basketry.functions.thresholds import absolute_support, absolute_support_column
from basketry.operators.baskets import Transactions, encode_baskets, restrict
from basketry.operators.itemsets import mine_encoded, mine_itemsets
from basketry.operators.rules import generate_rules, is_valuable, rank_order
from basketry.operators.topn import TOP_ITEMS, TOP_RULES, top_per_group
from basketry.session import discard, materialize

# The published threshold lists.
SWEEP_RATIOS = (0.005, 0.01, 0.02, 0.03, 0.05)
BENCHMARK_RATIOS = (0.05, 0.02, 0.01, 0.005)


@dataclass(frozen=True)
class Sweep:
    """``thresholds``: ``list_pos, min_support, abs_support_count`` (one row per given ratio).

    ``mined``: the itemsets of the lowest threshold. ``itemsets``: the same per threshold. ``rows``: the
    thresholds as given.
    """

    thresholds: DataFrame
    mined: DataFrame
    itemsets: DataFrame
    rows: list[tuple[int, float, int]]


def _thresholds_expr(rows: list[tuple[int, float, int]]) -> str:
    structs = ", ".join(
        f"named_struct('list_pos', {pos}, 'min_support', {ratio!r}D, 'abs_support_count', {count}L)"
        for pos, ratio, count in rows
    )
    return f"array({structs})"


def _per_threshold(df: DataFrame, rows: list[tuple[int, float, int]]) -> DataFrame:
    """Repeat each row for the thresholds its count reaches; no join, no shuffle."""
    reached = F.expr(f"filter({_thresholds_expr(rows)}, t -> `count` >= t.abs_support_count)")
    return df.withColumn("t", F.explode(reached)).select("t.*", *df.columns)


def threshold_modes(lines_counts: DataFrame, ratios: Sequence[float], modes: Sequence[str]) -> DataFrame:
    """Absolute thresholds of each ratio under each mode; ``lines_counts`` has one row with
    ``n_transactions``."""
    n, ratio = F.col("n_transactions"), F.col("min_support")
    table = lines_counts.select(
        "n_transactions", F.explode(F.array(*[F.lit(float(r)) for r in ratios])).alias("min_support")
    )
    return table.select(
        "min_support",
        "n_transactions",
        *[absolute_support_column(n, ratio, m).alias(f"abs_{m}") for m in modes],
    )


def sweep(
    tx: Transactions,
    ratios: Sequence[float] = SWEEP_RATIOS,
    mode: str = "floor",
    max_k: int | None = None,
) -> Sweep:
    rows = [(pos, float(r), absolute_support(tx.n, r, mode)) for pos, r in enumerate(ratios)]
    mined = mine_itemsets(tx, min(count for _, _, count in rows), max_k).itemsets
    thresholds = mined.sparkSession.createDataFrame(
        rows, "list_pos int, min_support double, abs_support_count bigint"
    )
    return Sweep(thresholds, mined, _per_threshold(mined, rows), rows)


def sweep_summary(result: Sweep, levels: Sequence[int] = (1, 2, 3)) -> DataFrame:
    """Sets per threshold and each of ``levels``, lowest threshold first; a threshold without any has zeros."""
    columns = {k: f"l{k}_count" for k in levels}
    found = result.itemsets.groupBy("list_pos").agg(
        *[F.count_if(F.col("k") == k).alias(name) for k, name in columns.items()]
    )
    return (
        result.thresholds.join(found, "list_pos", "left")
        .fillna(0, [*columns.values()])
        .select("min_support", "abs_support_count", *columns.values())
        .orderBy("min_support")
    )


def first_thresholds(summary: DataFrame, n: int = 5) -> DataFrame:
    return summary.orderBy("min_support").limit(n)


def time_thresholds(
    tx: Transactions,
    ratios: Sequence[float] = BENCHMARK_RATIOS,
    mode: str = "ceil",
    max_k: int | None = None,
) -> DataFrame:
    """Mine each threshold on its own and record the wall-clock seconds of each run.

    The baskets are encoded once, for the lowest threshold; each run reads them down to its own items.
    """
    counts = [absolute_support(tx.n, ratio, mode) for ratio in ratios]
    encoded = encode_baskets(tx, min(counts))
    records = []
    for ratio, min_count in zip(ratios, counts, strict=True):
        start = perf_counter()
        itemsets = mine_encoded(restrict(encoded, min_count), max_k).itemsets
        elapsed = round(perf_counter() - start, 6)
        sets = dict(itemsets.groupBy("k").count().collect())
        first_levels = [sets.get(k, 0) for k in (1, 2, 3)]
        records.append(
            (float(ratio), min_count, elapsed, *first_levels)
            + (tx.n, max(sets, default=0), sum(sets.values()), sets)
        )
    discard(encoded.baskets)
    return tx.presence.sparkSession.createDataFrame(
        records,
        "min_support double, abs_support_count bigint, execution_time_sec double, "
        "l1_count bigint, l2_count bigint, l3_count bigint, "
        "n_txn bigint, max_k int, total_freq bigint, per_k map<int, bigint>",
    )


def slowest_and_fastest(execution: DataFrame) -> DataFrame:
    """One row; the first of equal times wins, as the lowest threshold."""
    time, support = F.col("execution_time_sec"), F.col("min_support")
    return execution.agg(
        F.max_by("min_support", F.struct(time, -support)).alias("slowest_min_support"),
        F.max("execution_time_sec").alias("slowest_sec"),
        F.min_by("min_support", F.struct(time, support)).alias("fastest_min_support"),
        F.min("execution_time_sec").alias("fastest_sec"),
    )


def correlated_itemsets(result: Sweep, per_level: int = TOP_ITEMS, n: int = TOP_ITEMS) -> DataFrame:
    """Best pairs and triples over all thresholds, each under the first threshold that lists it."""
    sets = result.itemsets.filter(F.col("k").isin(2, 3)).withColumn(
        "text", F.array_join("itemset", REPORT_SEPARATOR)
    )
    order = [F.desc("support"), F.desc("count"), F.asc("text")]
    return (
        top_per_group(sets, ["list_pos", "k"], order, per_level)
        .groupBy("itemset")
        .agg(
            F.first("text").alias("text"),
            F.first("k").alias("itemset_size"),
            F.first("support").alias("support"),
            F.first("count").alias("count"),
            F.min_by("min_support", "list_pos").alias("min_support"),
        )
        .orderBy(*order)
        .limit(n)
        .select(F.col("text").alias("itemset"), "itemset_size", "support", "count", "min_support")
    )


def sweep_rules(result: Sweep) -> DataFrame:
    """Rules of the pairs and triples of every threshold; their metrics are computed once."""
    rules = generate_rules(result.mined, levels=(2, 3), separator=REPORT_SEPARATOR)
    return _per_threshold(rules, result.rows)


def valuable_rules(rules: DataFrame, n: int = TOP_RULES) -> DataFrame:
    """Per threshold the best valuable rules, or its best rules where none is valuable.

    Valuable rules rank first, so the top ``n`` already tell whether a threshold has any: one pass over
    the rules, and the flag is taken over at most ``n`` rows per threshold.
    """
    flagged = rules.withColumn("valuable", is_valuable())
    ranked = top_per_group(flagged, ["list_pos"], [F.desc("valuable"), *rank_order()], n)
    any_valuable = F.max("valuable").over(Window.partitionBy("list_pos"))
    return (
        ranked.withColumn("any_valuable", any_valuable)
        .filter(F.col("valuable") | ~F.col("any_valuable"))
        .select("list_pos", "min_support", "rank", "rule", "support", "confidence", "lift")
    )


def best_threshold(valuable: DataFrame) -> DataFrame:
    """One row: the threshold with most valuable rules, the earliest of the list among equals."""
    sizes = valuable.groupBy("list_pos", "min_support").agg(F.count("*").alias("n_rules"))
    return sizes.orderBy(F.desc("n_rules"), F.asc("list_pos")).limit(1)


def best_rules(valuable: DataFrame) -> DataFrame:
    """The valuable rules of the best threshold."""
    ranked = materialize(valuable)  # at most n rows per threshold, read twice
    return (
        ranked.join(F.broadcast(best_threshold(ranked).select("list_pos")), "list_pos", "left_semi")
        .orderBy("rank")
        .select("min_support", "rank", "rule", "support", "confidence", "lift")
    )
