"""Rules stored for browsing: filters by keyword, confidence and lift read only the files that can match.

A rule stands in the table once for each of its items, in a folder for its confidence (tenths) and for a bucket of the item's
hash, with its rows ordered by lift. A keyword is looked up among the item names first, a table of its own, and
only the buckets of items that hold it are read; without a keyword one row of each rule is read. Folders of lower
confidence are never opened, and the files' statistics rule out lifts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.text import ITEM_SEPARATOR
from basketry.operators.rules import extended_metrics, generate_rules, library_names, query_rules

BUCKETS = 32


def write_rule_table(itemsets: DataFrame, path: str, min_confidence: float = 0.3, buckets: int = BUCKETS) -> None:
    """Store the rules of a mining run below ``path``: the table ``rules``, and ``items`` with their buckets."""
    rules = extended_metrics(generate_rules(itemsets, min_confidence=min_confidence))
    stored = (
        library_names(rules, "antecedent", "consequent")
        .withColumn("tenths", F.floor(F.col("confidence") * 10).cast("int"))
        .withColumn("items", F.concat("antecedent", "consequent"))
        .select("*", F.posexplode("items").alias("place", "item"))
        .withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int"))
        .drop("antecedent", "consequent", "item")
    )
    # a best seller's folder is written by as many tasks as its size asks for
    dealt = stored.hint("rebalance", "tenths", "bucket").sortWithinPartitions("tenths", "bucket", "place", "lift")
    dealt.write.partitionBy("tenths", "bucket").parquet(f"{path}/rules")
    names = itemsets.filter("k = 1").select(F.col("itemset")[0].alias("item"))
    names.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(buckets)).cast("int")).write.parquet(f"{path}/items")


def stored_rules(spark: SparkSession, path: str, min_confidence: float, min_lift: float, keyword: str = "") -> DataFrame:
    """The stored rules that pass, each once, with all their columns; only files that can hold some are read."""
    rules = spark.read.parquet(f"{path}/rules")
    # a confidence of 1 stands in folder 10; rounding of the product may put a bound's own rules one folder lower
    lowest = int(min_confidence * 10) - 1
    rules = rules.filter((F.col("tenths") >= lowest) & (F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
    term = keyword.strip().lower()
    inside_items = term and not set(ITEM_SEPARATOR.strip()) & set(term)
    if not inside_items:
        # one row of each rule; a keyword across two items is looked for in all of them
        return rules.filter("place = 0").drop("place", "items", "bucket", "tenths")
    found = spark.read.parquet(f"{path}/items").filter(F.lower("item").contains(term))
    # as many as the table has buckets at most
    buckets = [row["bucket"] for row in found.select("bucket").distinct().collect()]
    rules = rules.filter(F.col("bucket").isin(buckets))
    # a rule with several such items stands in several places: the first counts
    holds = F.transform("items", lambda name: F.contains(F.lower(name), F.lit(term)))
    return rules.filter(F.array_position(holds, True) == F.col("place") + 1).drop("place", "items", "bucket", "tenths")


def query_rule_table(
    spark: SparkSession,
    path: str,
    min_confidence: float = 0.30,
    min_lift: float = 1.0,
    keyword: str = "",
    columns: Sequence[str] | None = None,
    sort_by: str = "confidence",
    descending: bool = True,
    limit: int | None = 20,
) -> DataFrame:
    """:func:`basketry.operators.rules.query_rules` over a stored table."""
    rules = stored_rules(spark, path, min_confidence, min_lift, keyword)
    return query_rules(rules, min_confidence, min_lift, keyword, columns, sort_by, descending, limit)
