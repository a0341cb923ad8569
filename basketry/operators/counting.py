"""How often sets occur: partial sums inside tasks, one small shuffle of sums.

Pairs take one scan of the baskets. Longer sets are found and counted at their last, their rarest item, from *heads*
(:mod:`basketry.functions.heads`), which are shuffled once, whatever the depth.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.bitmaps import pair_counter
from basketry.functions.heads import HEADS, MINED, group_miner, head_finder, set_counter, whole_groups
from basketry.operators.baskets import EncodedBaskets
from basketry.operators.candidates import positions
from basketry.session import discard, materialize, materialize_bucketed, materialize_counted

# Baskets that a group holds on average; an item in more baskets is counted in several groups.
BASKETS_PER_GROUP = 16_384
# Edges that go to the tasks at once (8 bytes each); more take several scans of the baskets.
EDGES_AT_ONCE = 4_000_000


def _total(partial: DataFrame, k: int) -> DataFrame:
    return partial.groupBy(*positions(k)).agg(F.sum("n").alias("count"))


def _schema(k: int) -> str:
    return ", ".join(f"{c} int" for c in positions(k)) + ", n bigint"


def count_pairs(encoded: EncodedBaskets) -> DataFrame:
    """``i1, i2, count`` of every pair that occurs together at least once: one scan of the baskets."""
    items = encoded.baskets.filter(F.col("n_basket_items") >= 2).select("items")
    return _total(items.mapInArrow(pair_counter(encoded.n_items), _schema(2)), 2)


def _edges(encoded: EncodedBaskets, edges: DataFrame, n_edges: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``last, item, shares`` of ``(item, last)`` edges in rounds of a bounded size, all of a last item in one round."""
    rounds = max(1, -(-n_edges // EDGES_AT_ONCE))
    shares = F.ceil(F.col("count") / BASKETS_PER_GROUP).cast("int").alias("shares")
    if encoded.most <= BASKETS_PER_GROUP:
        known = edges.select("last", "item", F.lit(1).alias("shares"))
    else:
        known = edges.join(encoded.dictionary.select(F.col("id").alias("last"), shares), "last").select("last", "item", "shares")
    for turn in range(rounds):
        table = known.filter(F.pmod(F.hash("last"), F.lit(rounds)) == turn).toArrow()
        columns = [table.column(c).to_numpy().astype(np.int64) for c in ("last", "item", "shares")]
        order = np.lexsort((columns[1], columns[0]))
        yield tuple(c[order] for c in columns)


def heads(encoded: EncodedBaskets, edges: DataFrame, n_edges: int) -> tuple[DataFrame, bool]:
    """``last, share, shares, head, n``: the heads of all baskets for ``(item, last)`` edges, and whether any item has several groups.

    A basket of L items sends at most its items that end a candidate, each with the earlier items it has an edge to.
    """
    # the baskets are a written table, so a repeated task numbers its rows alike
    number = F.xxhash64(F.monotonically_increasing_id())
    baskets = encoded.baskets.filter(F.col("n_basket_items") >= 3).select(number.alias("number"), "items")
    parts, split = [], False
    for last, item, shares in _edges(encoded, edges, n_edges):
        parts.append(baskets.mapInArrow(head_finder(last, item.astype(np.int32), shares, encoded.n_items), HEADS))
        split |= bool((shares > 1).any())
    return reduce(DataFrame.unionByName, parts), split


def _dealt(encoded: EncodedBaskets, found: DataFrame) -> DataFrame:
    """Heads by group, written once and co-partitioned for every later use."""
    return materialize_bucketed(found, encoded.tasks, "last", "share")


def _count_sets(encoded: EncodedBaskets, dealt: DataFrame, sets: DataFrame) -> DataFrame:
    """``number, n`` of the given sets (``number, last, items``) that occur; every set goes to all groups of its last item."""
    groups = F.ceil(F.col("count") / BASKETS_PER_GROUP).cast("int")
    ends = encoded.dictionary.select(F.col("id").alias("last"), groups.alias("shares"))
    spread = sets.join(ends, "last").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    asked = spread.select("number", "last", "share", "items").repartition(encoded.tasks, "last", "share")
    partial = (
        dealt.select("last", "share", "head", "n")
        .groupBy("last", "share")
        .cogroup(asked.groupBy("last", "share"))
        .applyInArrow(set_counter(), "number bigint, n bigint")
    )
    return partial.groupBy("number").agg(F.sum("n").alias("count"))


def mine_long_sets(encoded: EncodedBaskets, pairs: DataFrame, n_pairs: int, max_k: int | None) -> DataFrame:
    """``items, count`` of all frequent sets of three items and more, from the frequent ``pairs`` (``i1, i2``).

    Heads are shuffled once and each group is mined to the end where it lies. What an item of several groups ends is
    found by its groups' shares of the threshold, a superset, and then counted in all of them, from the same written heads.
    """
    edges = pairs.select(F.col("i1").alias("item"), F.col("i2").alias("last"))
    found, split = heads(encoded, edges, n_pairs)
    miner = group_miner(encoded.min_count, max_k)
    if not split:
        groups = found.repartition(encoded.tasks, "last", "share").sortWithinPartitions("last", "share")
        return materialize(groups.mapInArrow(miner, MINED).select("items", F.col("n").alias("count")))
    dealt = _dealt(encoded, found)
    mined = materialize(dealt.groupBy("last", "share").applyInArrow(whole_groups(miner), MINED))
    guessed = mined.filter("shares > 1").select("last", "items").distinct()
    guessed = materialize(guessed.select(F.monotonically_increasing_id().alias("number"), "last", "items"))
    counts = _count_sets(encoded, dealt.filter("shares > 1"), guessed).filter(F.col("count") >= encoded.min_count)
    exact = mined.filter("shares = 1").select("items", F.col("n").alias("count"))
    whole = materialize(exact.unionByName(guessed.join(counts, "number").select("items", "count")))
    discard(dealt, mined, guessed)
    return whole


def count_candidates(encoded: EncodedBaskets, candidates: DataFrame, k: int, min_count: int = 1) -> DataFrame:
    """``i1..ik, count`` of any set of candidates (k of 3 and above) that occur ``min_count`` times.

    A basket sends heads made of items that stand in a candidate with their last item. Nothing passes the driver but
    edges, in rounds of a bounded number.
    """
    names = positions(k)
    last = F.col(names[-1]).alias("last")
    listed = materialize(
        candidates.select(F.monotonically_increasing_id().alias("number"), last, F.array(*names).alias("items"))
    )
    before = F.explode(F.slice("items", 1, k - 1)).alias("item")
    edges, n_edges = listed.select(before, "last").distinct(), listed.count() * (k - 1)
    if n_edges > EDGES_AT_ONCE:
        edges, n_edges = materialize_counted(edges)
    found, _ = heads(encoded, edges, n_edges)
    dealt = found.repartition(encoded.tasks, "last", "share")
    counts = _count_sets(encoded, dealt, listed).filter(F.col("count") >= min_count)
    ids = [F.col("items")[j].alias(c) for j, c in enumerate(names)]
    table = materialize(listed.join(counts, "number").select(*ids, "count"))
    discard(listed)
    return table


def frequent(counts: DataFrame, min_count: int) -> tuple[DataFrame, int]:
    """Keep and write what reaches the threshold; also how many sets that is."""
    return materialize_counted(counts.filter(F.col("count") >= min_count))
