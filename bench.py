"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the tables, ``BENCH_CPUS`` (default all) the local cores. Each query
is timed from its call to its last result row: the median of three runs after one untimed. The
``mine_*`` entries mine support ratios on one set of transactions written beforehand (``load_*``), as the published
run did: on invoices, on baskets about as long as the published ones, and (``mine_published_*``) on lines made in
the published size, 20,728 baskets of 3,941 items, under the published absolute thresholds. ``published`` repeats
that run's seconds and numbers of sets.
"""

from __future__ import annotations

import json
import math
import os
from statistics import median
from time import perf_counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.baskets import transactions
from basketry.operators.clean import clean_lines
from basketry.plans.sweep import BENCHMARK_RATIOS, slowest_and_fastest, time_thresholds
from basketry.session import create_session, scope
from workloads import views
from workloads.queries import BRAND, QUERIES

HEADLINE = (
    "clean_a",
    "baskets_text",
    "dataset_profile",
    "item_dictionary",
    "c2_pairs",
    "c3_triples",
    "frequent_itemsets",
    "frequent_itemsets_deep",
    "frequent_itemsets_brand",
    "itemsets_customers",
    "rules_min_conf",
    "rules_extended",
    "query_rules",
    "threshold_sweep",
    "correlated_itemsets",
    "best_rules",
    "summary_metrics",
)


# The published size, seconds and numbers of sets per support ratio.
BASKETS, ITEMS, LINES = 20_728, 3_941, 541_909
PUBLISHED = {0.05: (1.461, 33), 0.02: (21.303, 356), 0.01: (168.272, 1_857), 0.005: (626.312, 16_923)}


# Ranks of items by the share of baskets that hold them, as published per support ratio.
RANKS = ((33, 0.05), (276, 0.02), (792, 0.01), (1_503, 0.005))
# Spread of the basket sizes' logarithm: long baskets are what brings items together.
SPREAD = 1.35


def published_size(spark: SparkSession) -> DataFrame:
    """Lines of the published size: items about as frequent as published, baskets of very different lengths."""

    def uniform(*seed):
        return (F.pmod(F.xxhash64(*seed), F.lit(1 << 40)) + 0.5) / float(1 << 40)

    z = F.sqrt(-2 * F.log(uniform("id", F.lit(1)))) * F.cos(2 * math.pi * uniform("id", F.lit(2)))
    size = F.greatest(F.lit(1), F.round(LINES / BASKETS * F.exp(SPREAD * z - SPREAD**2 / 2)))
    baskets = spark.range(BASKETS).select("id", F.explode(F.sequence(F.lit(1), size.cast("int"))).alias("line"))
    # shares of items by rank: straight lines between the published points, on logarithms
    points = [(1.0, 0.12), *((float(r), p) for r, p in RANKS), (float(ITEMS), 0.0002)]
    weights = []
    for (r, p), (r2, p2) in zip(points, points[1:]):
        steps = [r * (r2 / r) ** (i / 20) for i in range(21)]
        weights += [(lo, hi, p * (lo / r) ** (math.log(p2 / p) / math.log(r2 / r)) * (hi - lo)) for lo, hi in zip(steps, steps[1:])]
    total = sum(w for _, _, w in weights)
    u, rank, below = uniform("id", "line"), F.lit(float(ITEMS)), 0.0
    for lo, hi, w in reversed(weights):
        below = 1 - sum(x for a, _, x in weights if a >= lo) / total
        rank = F.when(F.col("u") < below + w / total, lo + (hi - lo) * (F.col("u") - below) * (total / w)).otherwise(rank)
    lines = baskets.withColumn("u", u).select("id", F.floor(rank).alias("item"))
    return lines.select(F.col("id").cast("string").alias("basket_id"), F.concat(F.lit("item "), "item").alias("item"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    spark = create_session(
        "basketry-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": str(cores),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        with scope(spark):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in HEADLINE:
        run(name)
        seconds = []
        for _ in range(3):
            start = perf_counter()
            run(name)
            seconds.append(perf_counter() - start)
        times[name] = round(median(seconds), 3)

    def mine(label: str, lines, ratios, mode="ceil"):
        start = perf_counter()
        tx = transactions(lines)
        times[f"load_{label}"] = round(perf_counter() - start, 3)
        runs = time_thresholds(tx, ratios, mode)
        for row in runs.collect():
            name = f"mine_{label}_{row['min_support']}"
            times[name] = round(row["execution_time_sec"], 3)
            sets[name] = row["total_freq"]
        return runs

    sets: dict[str, int] = {}
    invoices = clean_lines(views.invoice_lines(spark, sf_dir), "A", item_col=BRAND)
    runs = mine("invoices", invoices, BENCHMARK_RATIOS)
    extremes = slowest_and_fastest(runs).first()
    mine("customers", views.customer_products(spark, sf_dir), (0.05, 0.02, 0.01))
    mine("published", published_size(spark), tuple(PUBLISHED), "floor")
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "frequent_sets": sets,
                "published": {str(r): {"sec": s, "sets": n} for r, (s, n) in PUBLISHED.items()},
                "slowest_min_support": extremes["slowest_min_support"],
                "fastest_min_support": extremes["fastest_min_support"],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
