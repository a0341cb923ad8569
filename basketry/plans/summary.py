"""Headline numbers of a run as a metric/value table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.operators.baskets import distinct_counts


def summary_metrics(
    kept_lines: DataFrame, lines: DataFrame, itemsets: DataFrame, rules: DataFrame
) -> DataFrame:
    """``kept_lines``: raw lines after cleaning; ``lines``: their ``(basket_id, item)`` projection.

    Each part is one aggregate row; they are stacked, never joined.
    """

    def metric(df: DataFrame, **aggregates: Column) -> DataFrame:
        row = df.agg(*[c.cast("double").alias(name) for name, c in aggregates.items()])
        stack = ", ".join(f"'{name}', `{name}`" for name in aggregates)
        return row.selectExpr(f"stack({len(aggregates)}, {stack}) AS (metric, value)")

    def mean(name: str) -> Column:
        return F.bround(F.avg(name), 4)

    return (
        metric(kept_lines, rows=F.count(F.lit(1)), columns=F.lit(len(kept_lines.columns)))
        .unionByName(
            metric(
                distinct_counts(lines, {"transactions": "basket_id", "unique_items": "item"}),
                transactions=F.max("transactions"),
                unique_items=F.max("unique_items"),
            )
        )
        .unionByName(
            metric(
                itemsets,
                frequent_itemsets=F.count(F.lit(1)),
                avg_support=F.coalesce(mean("support"), F.lit(float("nan"))),
            )
        )
        .unionByName(
            metric(
                rules,
                association_rules=F.count(F.lit(1)),
                avg_confidence=F.coalesce(mean("confidence"), F.lit(0.0)),
                avg_lift=F.coalesce(mean("lift"), F.lit(0.0)),
            )
        )
    )
