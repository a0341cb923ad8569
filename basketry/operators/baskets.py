"""From cleaned lines to baskets: presence, item counts, dictionary, encoded baskets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import discard, materialize, new_table_path


def presence(lines: DataFrame) -> DataFrame:
    """Long form of the basket-by-item matrix: each ``(basket_id, item)`` once.

    Shuffled on both columns after a map-side combine, so neither a huge basket nor a best-selling
    item ends up in one task.
    """
    return lines.select("basket_id", "item").distinct()


def presence_matrix(lines: DataFrame, items: Sequence[str]) -> DataFrame:
    """Wide form for a short list of items: one row per basket, one boolean column per item.

    A plain aggregate with map-side combine; the long form is what everything else works on.
    """
    columns = [F.bool_or(F.col("item") == item).alias(item) for item in items]
    return lines.groupBy("basket_id").agg(*columns)


@dataclass(frozen=True)
class PresenceVectors:
    """``vectors``: ``basket_id, features``, one sparse binary vector of length ``n_items`` each; ``dictionary``: ``id, item, count``."""

    vectors: DataFrame
    dictionary: DataFrame
    n_items: int
    path: str

    def entries(self) -> DataFrame:
        """``basket_id, item`` of the non-zeros, read from the written vectors."""
        stored = self.vectors.sparkSession.read.schema(f"basket_id string, features {_VECTOR}").parquet(self.path)
        ids = stored.select("basket_id", F.explode("features.indices").alias("id"))
        return ids.join(self.dictionary, "id").select("basket_id", "item")


# How a vector column is stored; type 0 is sparse.
_VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def presence_vectors(lines: DataFrame) -> PresenceVectors:
    """The basket-by-item matrix as a column of sparse vectors, ready for MLlib estimators.

    Names stay in the dictionary table; a basket's vector is put together from item ids, written in a vector's stored form and
    read back as vectors. A row is bounded by the catalogue.
    """
    from pyspark.ml.linalg import VectorUDT

    pairs = materialize(presence(lines))
    dictionary, n_items, *_ = item_dictionary(pairs.groupBy("item").agg(F.count(F.lit(1)).alias("count")))
    indices = F.sort_array(F.collect_list("id"))
    rows = encode_items(pairs, dictionary).groupBy("basket_id").agg(indices.alias("indices"))
    ones = F.transform("indices", lambda _: F.lit(1.0))
    features = F.struct(F.lit(0).cast("tinyint"), F.lit(n_items), "indices", ones).cast(_VECTOR)
    spark, path = lines.sparkSession, new_table_path(lines.sparkSession)
    rows.select("basket_id", features.alias("features")).write.parquet(path)
    schema = T.StructType([T.StructField("basket_id", T.StringType()), T.StructField("features", VectorUDT())])
    return PresenceVectors(spark.read.schema(schema).parquet(path), dictionary, n_items, path)


def build_baskets(lines: DataFrame) -> DataFrame:
    """One row per basket with its sorted distinct items.

    Repeats are removed before the grouping, so a row is bounded by the catalogue. Mining does not use
    this table but the trimmed integer form of :func:`encode_baskets`.
    """
    return (
        presence(lines)
        .groupBy("basket_id")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )


def dataset_counts(lines: DataFrame) -> DataFrame:
    """One row: transactions and distinct items of the cleaned lines."""
    return distinct_counts(lines, {"n_transactions": "basket_id", "n_items": "item"})


def distinct_counts(lines: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row with the number of distinct values of each column, under the given names.

    Each column is counted on its own and the single rows are put together; counted in one aggregate, every
    line would be shuffled once for each column.
    """
    rows = [
        lines.select(F.col(column).alias("value"))
        .distinct()
        .agg(*[(F.count("value") if n == name else F.lit(None).cast("long")).alias(n) for n in names])
        for name, column in names.items()
    ]
    return reduce(DataFrame.unionByName, rows).agg(*[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in names])


@dataclass(frozen=True)
class Transactions:
    """Distinct ``(basket_id, item)`` rows, written once, and the number of baskets."""

    presence: DataFrame
    n: int

    def release(self) -> None:
        """Delete the written rows once no more results are wanted from them."""
        discard(self.presence)


def transactions(lines: DataFrame) -> Transactions:
    pairs = materialize(presence(lines))
    return Transactions(pairs, pairs.select("basket_id").distinct().count())


def item_counts(tx: Transactions) -> DataFrame:
    """C1: ``item, count, support``."""
    return (
        tx.presence.groupBy("item")
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("support", F.col("count") / F.lit(float(tx.n)))
    )


def item_dictionary(counts: DataFrame) -> tuple[DataFrame, int, int, int, int]:
    """``id, item, count`` with ids 0, 1, 2… by count descending, then item.

    Also the number of items, the sum of their counts, the bytes of their names, and the largest count. Ranked without a one-task window: rows are range
    partitioned, numbered inside their partition, and shifted by the sizes of the earlier partitions. Only
    those sizes, one per partition, are collected.
    """
    order = [F.desc("count"), F.asc("item")]
    numbered = materialize(
        counts.select("item", "count")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "item",
            "count",
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("position"),
        )
    )
    parts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("items"), F.sum("count").alias("entries"), F.sum(F.octet_length("item")).alias("bytes"), F.max("count").alias("most"))
    sizes = {row["part"]: row for row in parts.collect()}
    by_part = [sizes[part]["items"] if part in sizes else 0 for part in range(max(sizes, default=0))]
    shifts = ", ".join(map(str, accumulate(by_part, initial=0)))
    shift = F.expr(f"element_at(array({shifts}), part + 1)")
    dictionary = numbered.select((F.col("position") + shift).cast("int").alias("id"), "item", "count")
    n_items, entries, name_bytes = (sum(row[c] for row in sizes.values()) for c in ("items", "entries", "bytes"))
    return dictionary, n_items, entries, name_bytes, max((row["most"] for row in sizes.values()), default=0)


@dataclass(frozen=True)
class EncodedBaskets:
    """Baskets trimmed to the frequent items, as sorted id lists, with the dictionary to read them.

    A list is never longer than ``n_items``, the number of frequent items, which is at most the mean
    basket length divided by the support ratio, however large one basket is in the raw lines.
    """

    baskets: DataFrame
    dictionary: DataFrame
    n_items: int
    n: int
    min_count: int
    #: tasks that counting is worth, from the number of entries
    tasks: int = 1
    #: bytes of the item names
    name_bytes: int = 0
    #: baskets of the most frequent item
    most: int = 1 << 62


def restrict(encoded: EncodedBaskets, min_count: int) -> EncodedBaskets:
    """The same baskets for a higher threshold: ids run by count, so its items are the first ids. No shuffle."""
    dictionary = encoded.dictionary.filter(F.col("count") >= min_count)
    n_items = dictionary.count()
    items = F.filter("items", lambda item: item < n_items)
    baskets = encoded.baskets.select(items.alias("items")).select("items", F.size("items").alias("n_basket_items"))
    baskets = baskets.filter(F.col("n_basket_items") >= 2)
    return EncodedBaskets(baskets, dictionary, n_items, encoded.n, min_count, encoded.tasks, encoded.name_bytes, encoded.most)


def encode_items(pairs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``(basket_id, item)`` to ``(basket_id, id)``; items outside the dictionary fall away."""
    return pairs.join(dictionary.select("item", "id"), "item").select("basket_id", "id")


# Bytes of item names up to which they travel inside the plan; more names are joined by position.
NAMES_IN_PLAN = 1 << 20


def decode_itemsets(encoded: DataFrame, dictionary: DataFrame, name_bytes: int | None = None) -> DataFrame:
    """Replace ``items ARRAY<INT>`` by ``itemset ARRAY<STRING>``, sorted.

    ``name_bytes``: measured size of the names. A small dictionary becomes one constant of the plan and needs no
    shuffle; a large one is joined item by item and put together by row number, never by the array.
    """
    others = [c for c in encoded.columns if c != "items"]
    if name_bytes is not None and name_bytes <= NAMES_IN_PLAN:
        names = [item for _, item in sorted(dictionary.select("id", "item").collect())]
        joint = _absent(names)
        known = F.split(F.lit(joint.join(names)), joint)
        decoded = F.transform("items", lambda id_: F.get(known, id_))
        return encoded.select(*others, F.sort_array(decoded).alias("itemset"))
    numbered = materialize(encoded.withColumn("number", F.monotonically_increasing_id()))
    names = numbered.select("number", F.explode("items").alias("id")).join(dictionary.select("id", "item"), "id")
    lists = names.groupBy("number").agg(F.sort_array(F.collect_list("item")).alias("itemset"))
    return numbered.join(lists, "number").select(*others, "itemset")


def _absent(names: list[str]) -> str:
    """A character that no name holds, to keep them apart in one text."""
    used = set().union(*names) if names else set()
    return next(chr(c) for c in range(0xE000, 0x110000) if chr(c) not in used)


# Entries of the trimmed matrix per task. Counting is bound by CPU, not bytes, so tasks are sized by the
# number of entries, known exactly from the dictionary, and small inputs still use every core.
ENTRIES_PER_TASK = 20_000_000
SMALLEST_TASK = 50_000


def _counting_tasks(entries: int, cores: int) -> int:
    return max(-(-entries // ENTRIES_PER_TASK), min(cores, -(-entries // SMALLEST_TASK)), 1)


def encode_baskets(tx: Transactions, min_count: int) -> EncodedBaskets:
    counts = tx.presence.groupBy("item").agg(F.count(F.lit(1)).alias("count"))
    dictionary, n_items, entries, name_bytes, most = item_dictionary(counts.filter(F.col("count") >= min_count))
    tasks = _counting_tasks(entries, tx.presence.sparkSession.sparkContext.defaultParallelism)
    baskets = materialize(
        encode_items(tx.presence, dictionary)
        .repartition(tasks, "basket_id")
        .groupBy("basket_id")
        .agg(F.sort_array(F.collect_list("id")).alias("items"))
        .select("items", F.size("items").alias("n_basket_items"))
        .filter(F.col("n_basket_items") >= 2)
    )
    return EncodedBaskets(baskets, dictionary, n_items, tx.n, min_count, tasks, name_bytes, most)
