"""Transaction lines and baskets read from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def invoice_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retail-shaped lines: returns become ``C`` invoices with negative quantity, line 7 has none."""
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    order = F.col("l_orderkey").cast("string")
    returned = F.col("l_returnflag") == "R"
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.when(returned, F.concat(F.lit("C"), order)).otherwise(order).alias("InvoiceNo"),
        F.col("p_type").alias("StockCode"),
        F.col("p_brand").alias("Brand"),
        F.col("p_name").alias("Description"),
        F.when(returned, -F.col("l_quantity"))
        .when(F.col("l_linenumber") == 7, None)
        .otherwise(F.col("l_quantity"))
        .alias("Quantity"),
    )


def _kept_purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") != "R")
    orders, part = table(spark, sf_dir, "orders"), table(spark, sf_dir, "part")
    return lineitem.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).join(
        part, F.col("p_partkey") == F.col("l_partkey")
    )


def customer_baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All part types a customer ever kept: deep, strong rules."""
    return _kept_purchases(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("basket_id"), F.col("p_type").alias("item")
    )


def customer_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brand and type of everything a customer ever kept: 150 items, about 25 per basket."""
    return _kept_purchases(spark, sf_dir).select(
        F.col("o_custkey").cast("string").alias("basket_id"),
        F.concat_ws(" ", "p_brand", "p_type").alias("item"),
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("basket_id"), F.col("event_type").alias("item")
    )


def user_day_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One basket per user and day (UTC, from the stored clock time)."""
    day = F.col("ts").cast("date").cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("|"), day).alias("basket_id"),
        F.col("event_type").alias("item"),
    )
