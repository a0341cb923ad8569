"""The three complete analyses, from cleaned lines to their result tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from basketry.functions.thresholds import absolute_support
from basketry.operators.baskets import transactions
from basketry.operators.clean import clean_lines, kept_lines
from basketry.operators.itemsets import level_steps, mine_itemsets
from basketry.operators.rules import generate_rules, library_rules, sort_rules
from basketry.plans import tables as tb
from basketry.plans.summary import summary_metrics
from basketry.plans.sweep import (
    BENCHMARK_RATIOS,
    SWEEP_RATIOS,
    Sweep,
    best_rules,
    correlated_itemsets,
    sweep,
    sweep_rules,
    sweep_summary,
    time_thresholds,
    valuable_rules,
)
from basketry.session import materialize

# The published defaults of the analyses.
STEP_SUPPORT = 0.005
LIBRARY_SUPPORT = 0.02
LIBRARY_CONFIDENCE = 0.3


def benchmark(
    lines: DataFrame, ratios: Sequence[float] = BENCHMARK_RATIOS, max_k: int | None = None
) -> DataFrame:
    """Profile A: one timed mining run per ratio over the same transactions."""
    tx = transactions(clean_lines(lines, "A"))
    runs = time_thresholds(tx, ratios, "ceil", max_k)
    tx.release()
    return runs


@dataclass(frozen=True)
class StepTables:
    """The stepwise analysis as shown: candidates and survivors of three levels, then the rules."""

    c1: DataFrame
    l1_dropped: DataFrame
    c2: DataFrame
    l2: DataFrame
    c3: DataFrame
    l3: DataFrame
    rules: DataFrame
    rule_summary: DataFrame


def stepwise(lines: DataFrame, ratio: float = STEP_SUPPORT) -> StepTables:
    """Profile B up to three items, rules from the triples."""
    tx = transactions(clean_lines(lines, "B"))
    min_count = absolute_support(tx.n, ratio, "floor")
    steps = level_steps(tx, min_count)
    itemsets = mine_itemsets(tx, min_count, max_k=3).itemsets
    rules = sort_rules(generate_rules(itemsets, levels=(3,)))
    return StepTables(
        tb.c1_table(steps.c1),
        tb.l1_dropped_table(steps.dropped_l1),
        tb.c2_table(steps.c2),
        tb.frequent_table(steps.l2),
        tb.c3_table(steps.c3),
        tb.frequent_table(steps.l3),
        tb.rules_table(rules),
        tb.rule_summary_table(rules),
    )


@dataclass(frozen=True)
class SweepTables:
    """Tables of a threshold sweep: sets per threshold, best sets over all, best rules of the best."""

    sweep: Sweep
    execution: DataFrame
    correlated: DataFrame
    best_rules: DataFrame


def threshold_study(lines: DataFrame, ratios: Sequence[float] = SWEEP_RATIOS) -> SweepTables:
    """Profile B, every ratio from one mining run."""
    tx = transactions(clean_lines(lines, "B"))
    swept = sweep(tx, ratios, "floor", max_k=3)
    tx.release()
    return SweepTables(
        swept,
        sweep_summary(swept),
        correlated_itemsets(swept),
        best_rules(valuable_rules(sweep_rules(swept))),
    )


@dataclass(frozen=True)
class LibraryTables:
    itemsets: DataFrame
    rules: DataFrame
    summary: DataFrame


def library_run(
    lines: DataFrame,
    ratio: float = LIBRARY_SUPPORT,
    min_confidence: float = LIBRARY_CONFIDENCE,
    item_col: str | None = None,
) -> LibraryTables:
    """Profile C, all levels, rules above a confidence; the rules feed ``query_rules``."""
    cleaned = clean_lines(lines, "C", item_col=item_col)
    tx = transactions(cleaned)
    itemsets = mine_itemsets(tx, absolute_support(tx.n, ratio, "ratio"), None).itemsets
    tx.release()
    rules = materialize(library_rules(itemsets, min_confidence))
    kept = kept_lines(lines, "C", item_col=item_col)
    return LibraryTables(itemsets, rules, summary_metrics(kept, cleaned, itemsets, rules))
