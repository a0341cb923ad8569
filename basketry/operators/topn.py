"""Top-n reports. The limits here are the feature itself, never a guard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.rules import rank_order

# Published sizes of the reports.
TOP_PER_LEVEL = 5
TOP_RULES = 10
TOP_ITEMS = 10
DISPLAY_ROWS = 5


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group.

    Catalyst turns the rank filter into a group limit before the shuffle, so a task passes on at most
    ``n`` rows per group, however large the group.
    """
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", rank).filter(F.col("rank") <= n)


def top_itemsets_per_level(itemsets: DataFrame, n: int = TOP_PER_LEVEL) -> DataFrame:
    return top_per_group(
        itemsets, ["k"], [F.desc("count"), F.asc("itemset_text")], n
    ).select("k", "rank", "itemset_text", "count")


def top_itemsets(itemsets: DataFrame, n: int = TOP_ITEMS, by: str = "support") -> DataFrame:
    return itemsets.orderBy(F.desc(by), F.asc("itemset_text")).limit(n)


def top_rules(rules: DataFrame, n: int = TOP_RULES) -> DataFrame:
    return rules.orderBy(*rank_order()).limit(n)


def top_rules_by_confidence(rules: DataFrame, n: int = TOP_RULES) -> DataFrame:
    return rules.orderBy(F.desc("confidence"), F.asc("antecedents"), F.asc("consequents")).limit(n)


def display_rows(table: DataFrame, max_rows: int = DISPLAY_ROWS) -> DataFrame:
    """The first rows of a shown table."""
    return table.limit(max_rows)
