"""Ranks over groups of any size: range partitions, their counts, and row numbers inside each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialize


def ranked(df: DataFrame, groups: list[str], order: list[Column], rank: str) -> DataFrame:
    """Add ``rank`` (from 1) of each row inside its group, in the given order.

    Rows are dealt by range of ``groups`` and ``order``, so a group of a third of all rows spreads over many
    tasks. What is summed in one task is one count for each range and group in it. Rows equal in all
    columns of ``order`` get their ranks in any order; ranks start at 1 for each group, nulls being a group.
    """
    keys = [F.col(g) for g in groups]
    dealt = materialize(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    )
    before = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*groups, "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = materialize(
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    inside = Window.partitionBy("_range", *groups).orderBy(*order)
    numbered = dealt.withColumn("_at", F.row_number().over(inside)).alias("n")
    same = F.col("n._range") == F.col("o._range")
    for g in groups:
        same &= F.col(f"n.{g}").eqNullSafe(F.col(f"o.{g}"))
    return numbered.join(offsets.alias("o"), same).select(
        *[f"n.{c}" for c in df.columns], (F.col("o._before") + F.col("n._at")).alias(rank)
    )
