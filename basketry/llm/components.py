"""Connected components over an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.session import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges``: columns ``a``, ``b`` of one sortable type. Returns ``node``, ``label`` (its component's least node).

    Large stars hang every larger neighbour on the least node around it, small stars every node and its smaller
    neighbours; the edge table never gains rows and the rounds grow with the logarithm of the longest chain.
    Each round is written to the shared folder, so a lost executor costs one round at most. No edge: no row.
    """
    current = materialize(_down(edges).distinct())
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("u"))
        large = materialize(_down(large.select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("u"))
        small = small.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        following = materialize(_down(small).distinct())
        discard(current, large)
        current, before = following, state
        state = _state(current)
        if state == before:
            break
    heads = current.select("b").distinct()
    return materialize(
        current.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
            heads.select(F.col("b").alias("node"), F.col("b").alias("label"))
        )
    )


def _down(edges: DataFrame) -> DataFrame:
    """Each edge from its larger to its smaller node, no loops."""
    return edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
    return tuple(row)
