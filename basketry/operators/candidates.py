"""Candidate itemsets, as joins over the frequent sets of the level below.

Levels are tables with one integer column per position, ``i1 < i2 < … < ik``. Integer columns hash and
compare inside code generation, and Catalyst broadcasts a level when its file is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def positions(k: int) -> list[str]:
    return [f"i{j}" for j in range(1, k + 1)]


def pair_candidates(dictionary: DataFrame, n_items: int) -> DataFrame:
    """Every pair of frequent items, written out from each id instead of by a cross join."""
    return dictionary.filter(F.col("id") < n_items - 1).select(
        F.col("id").alias("i1"),
        F.explode(F.sequence(F.col("id") + 1, F.lit(n_items - 1))).alias("i2"),
    )


def join_candidates(level: DataFrame, k: int) -> DataFrame:
    """Join two (k-1)-sets that differ in one item only, then prune (k ≥ 3).

    The classic join shares all items but the last in the chosen item order. Ids run from the most to
    the least frequent item, so here the sets share all but the *first* id: groups form around rare items
    and stay small, where a join on best sellers would put most of the work under a few keys. Each
    candidate still arises exactly once.

    A candidate survives when all its (k-1)-subsets are frequent. The two it was built from are, so one
    semi join remains for each shared position.
    """
    shared = positions(k)[2:]
    known = level.select(*positions(k - 1))
    candidates = (
        known.toDF("i1", *shared)
        .join(known.toDF("i2", *shared), shared)
        .filter(F.col("i1") < F.col("i2"))
        .select(*positions(k))
    )
    for dropped in shared:
        kept = [c for c in positions(k) if c != dropped]
        candidates = candidates.join(known.toDF(*kept), kept, "left_semi")
    return candidates.select(*positions(k))


# Neighbours of an item that are joined with each other in one group.
NEIGHBOURS = 1024


def neighbour_pairs(level2: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """``shared, x, y`` with ``x < y``: any two frequent pairs that share an item.

    A best seller's neighbours are cut into blocks and block is joined with block, so no group holds more than about two
    blocks, although the result grows with the square of the neighbours.
    """
    ends = level2.select(F.col("i1").alias("shared"), F.col("i2").alias("other")).unionByName(
        level2.select(F.col("i2").alias("shared"), F.col("i1").alias("other"))
    )
    blocks = F.ceil(F.count(F.lit(1)) / neighbours).cast("int").alias("blocks")
    ends = ends.join(ends.groupBy("shared").agg(blocks), "shared")
    # an end goes to the meeting of its own block with every block
    ends = ends.select(
        "shared",
        "other",
        F.pmod(F.xxhash64("other"), "blocks").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("meets"),
    )
    x = ends.select("shared", F.col("block").alias("a"), F.col("meets").alias("b"), F.col("other").alias("x"))
    y = ends.select("shared", F.col("meets").alias("a"), F.col("block").alias("b"), F.col("other").alias("y"))
    return x.join(y, ["shared", "a", "b"]).filter(F.col("x") < F.col("y")).select("shared", "x", "y")


def overlap_candidates(level2: DataFrame, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Every union of two frequent pairs that has three items; the third pair need not be frequent."""
    low, high = F.least("shared", "x"), F.greatest("shared", "y")
    return (
        neighbour_pairs(level2, neighbours)
        .select(
            low.alias("i1"),
            (F.col("shared") + F.col("x") + F.col("y") - low - high).alias("i2"),
            high.alias("i3"),
        )
        .distinct()
    )
