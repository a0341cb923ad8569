"""Level-wise mining, and the single steps of it as tables."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.text import itemset_text, levels_text
from basketry.operators.baskets import (
    EncodedBaskets,
    Transactions,
    decode_itemsets,
    encode_baskets,
    item_counts,
)
from basketry.operators.candidates import (
    overlap_candidates,
    pair_candidates,
    positions,
    join_candidates,
)
from basketry.operators.counting import count_candidates, count_pairs, frequent, mine_long_sets
from basketry.session import discard, materialize


@dataclass(frozen=True)
class MiningResult:
    """``itemsets``: ``k, itemset, itemset_text, count, support``, every level in one table.

    ``sets``: the same in encoded form, ``k, items, count``. ``max_k``: the depth that was given, if any.
    """

    itemsets: DataFrame
    sets: DataFrame
    n_items: int
    n: int
    min_count: int
    max_k: int | None = None

    @property
    def cut_off(self) -> bool:
        """Whether the given depth ended the run although longer sets may be frequent: a set of k+1 items needs k+1 frequent subsets."""
        return self.max_k is not None and self.itemsets.filter(F.col("k") == self.max_k).count() > self.max_k


def _as_list(level: DataFrame, k: int) -> DataFrame:
    return level.select(F.lit(k).alias("k"), F.array(*positions(k)).alias("items"), "count")


def _finish(decoded: DataFrame, n: int) -> DataFrame:
    return decoded.select(
        "k",
        "itemset",
        itemset_text(F.col("itemset")).alias("itemset_text"),
        "count",
        (F.col("count") / F.lit(float(n or 1))).alias("support"),
    )


def mine_sets(encoded: EncodedBaskets, max_k: int | None = None) -> DataFrame:
    """``k, items, count`` of all frequent sets, ids ascending, or of those of up to ``max_k`` items.

    Items come from the dictionary, pairs from one scan of the baskets, all longer sets from one shuffle of heads. Each
    step ends in a written table, so a lost executor costs at most the running one.
    """
    sets = [_as_list(encoded.dictionary.select(F.col("id").alias("i1"), "count"), 1)]
    if encoded.n_items > 1 and (max_k is None or max_k > 1):
        pairs, n_pairs = frequent(count_pairs(encoded), encoded.min_count)
        sets.append(_as_list(pairs, 2))
        # a set of three items needs three frequent pairs
        if n_pairs > 2 and (max_k is None or max_k > 2):
            longer = mine_long_sets(encoded, pairs, n_pairs, max_k)
            sets.append(longer.select(F.size("items").alias("k"), "items", "count"))
    return reduce(DataFrame.unionByName, sets)


def level_of(sets: DataFrame, k: int) -> DataFrame:
    """Level ``k`` of mined sets as a table ``i1..ik, count``."""
    ids = [F.col("items")[j].alias(c) for j, c in enumerate(positions(k))]
    return sets.filter(F.col("k") == k).select(*ids, "count")


def mine_itemsets(
    tx: Transactions, min_count: int, max_k: int | None = None
) -> MiningResult:
    """All frequent itemsets, or those of up to ``max_k`` items; empty when no item is."""
    encoded = encode_baskets(tx, min_count)
    result = mine_encoded(encoded, max_k)
    discard(encoded.baskets)
    return result


def mine_encoded(encoded: EncodedBaskets, max_k: int | None = None) -> MiningResult:
    """:func:`mine_itemsets` on baskets that are encoded already and are kept."""
    sets = mine_sets(encoded, max_k)
    itemsets = materialize(_finish(decode_itemsets(sets, encoded.dictionary, encoded.name_bytes), encoded.n))
    return MiningResult(itemsets, sets, encoded.n_items, encoded.n, encoded.min_count, max_k)


def candidate_counts(result: MiningResult) -> DataFrame:
    """``k, n_candidates``: the sets of k items that level k - 1 admits; levels without any are left out."""
    spark = result.itemsets.sparkSession
    sizes = dict(result.sets.groupBy("k").count().collect())
    levels = [spark.createDataFrame([(2, result.n_items * (result.n_items - 1) // 2)], "k int, n_candidates bigint")]
    for k in range(2, max(sizes, default=0) + 1):
        if sizes[k] > k:
            admitted = join_candidates(level_of(result.sets, k), k + 1)
            levels.append(admitted.agg(F.lit(k + 1).alias("k"), F.count(F.lit(1)).alias("n_candidates")))
    return reduce(DataFrame.unionByName, levels).filter("n_candidates > 0")


def level_funnel(result: MiningResult) -> DataFrame:
    """``k, n_candidates, n_frequent``; level 1 has no candidate step."""
    deepest = result.itemsets.agg(F.max("k")).first()[0] or 0
    tried = candidate_counts(result)
    if result.cut_off:
        tried = tried.filter(F.col("k") <= deepest)
    found = result.itemsets.groupBy("k").agg(F.count("*").alias("n_frequent"))
    return (
        found.join(tried, "k", "full_outer")
        .select("k", "n_candidates", F.coalesce("n_frequent", F.lit(0)).cast("long").alias("n_frequent"))
        .orderBy("k")
    )


def run_totals(result: MiningResult) -> DataFrame:
    """One row: deepest level, number of sets, sets per level as a map and as text."""
    per_level = result.itemsets.groupBy("k").agg(F.count("*").alias("sets"))
    return per_level.agg(
        F.coalesce(F.max("k"), F.lit(0)).alias("max_k"),
        F.coalesce(F.sum("sets"), F.lit(0)).cast("long").alias("total_freq"),
        F.map_from_entries(F.collect_list(F.struct("k", "sets"))).alias("per_k"),  # one per level
    ).withColumn("per_k_text", levels_text(F.col("per_k")))


@dataclass(frozen=True)
class LevelSteps:
    """The stepwise tables: candidates and survivors of levels 1 to 3.

    ``c2`` holds every pair of frequent items that occurs, ``c3`` every three-item union of two frequent pairs with
    a count that may be 0. Each table is lazy except for what counting had to write.
    """

    c1: DataFrame
    l1: DataFrame
    dropped_l1: DataFrame
    c2: DataFrame
    l2: DataFrame
    c3: DataFrame
    l3: DataFrame


def _by_count(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("count"), F.desc("support"), F.asc("itemset_text"))


def item_levels(tx: Transactions, min_count: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C1, L1 and the items that L1 drops."""
    c1 = _by_count(
        item_counts(tx).select(
            F.array("item").alias("itemset"), F.col("item").alias("itemset_text"), "count", "support"
        )
    )
    enough = F.col("count") >= min_count
    return c1, c1.filter(enough), c1.filter(~enough).select("itemset", "itemset_text", "count")


def _shown(encoded: EncodedBaskets, counted: DataFrame, k: int) -> DataFrame:
    decoded = decode_itemsets(_as_list(counted, k), encoded.dictionary, encoded.name_bytes)
    return _by_count(_finish(decoded, encoded.n).drop("k"))


def pair_level(encoded: EncodedBaskets, absent: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C2 and L2 as shown, and the encoded L2.

    C2 lists the pairs that occur. ``absent`` adds the others with a count of 0: as many rows as there are
    pairs of frequent items.
    """
    counts = materialize(count_pairs(encoded))
    level2 = counts.filter(F.col("count") >= encoded.min_count)
    shown = counts
    if absent:
        pairs = pair_candidates(encoded.dictionary, encoded.n_items)
        shown = pairs.join(counts, positions(2), "left").fillna(0, ["count"])
    return _shown(encoded, shown, 2), _shown(encoded, level2, 2), level2


def triple_level(encoded: EncodedBaskets, level2: DataFrame) -> DataFrame:
    """L3: the frequent triples, from the pruned candidates."""
    counted = count_candidates(encoded, join_candidates(level2, 3), 3, encoded.min_count)
    return _shown(encoded, counted, 3)


def overlap_level(encoded: EncodedBaskets, level2: DataFrame) -> DataFrame:
    """C3 from overlapping frequent pairs, 0 where a triple never occurs.

    The table itself has a row for any two pairs that share an item, so it grows with the square of a best
    seller's pairs; frequent triples come from :func:`triple_level`.
    """
    candidates = materialize(overlap_candidates(level2))
    counted = count_candidates(encoded, candidates, 3)
    return _shown(encoded, candidates.join(counted, positions(3), "left").fillna(0, ["count"]), 3)


def level_steps(tx: Transactions, min_count: int) -> LevelSteps:
    c1, l1, dropped = item_levels(tx, min_count)
    encoded = encode_baskets(tx, min_count)
    c2, l2, level2 = pair_level(encoded)
    c3, l3 = overlap_level(encoded, level2), triple_level(encoded, level2)
    discard(encoded.baskets)  # everything is counted
    return LevelSteps(c1, l1, dropped, c2, l2, c3, l3)
