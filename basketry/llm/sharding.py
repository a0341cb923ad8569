"""Pack indivisible groups of rows into shards of a fixed capacity, best fit decreasing.

Groups (rows of equal text) go from the largest to the smallest into the open bin whose remaining capacity is tightest,
found in a balanced search tree, and into a new bin where none fits. It is done on two levels. Each task packs the
groups dealt to it, streamed in descending size, into *parcels* of 1/64 of a shard; the driver packs the parcels
into shards. All bins of a task but one are at least half full, so the driver sees at most 2 * 64 parcels for each
shard and one for each task, never groups or rows. For a given number of shards the least capacity that needs no
more shards is searched by bisection, which only repeats the second level.

A group larger than a shard fits nowhere and is cut into parts of about a parcel by the number of its row, whatever ids its
rows have; there are fewer such groups than shards. A single row larger than a shard has one of its own, and the others
share what is left. *Bound.* With capacity C, groups above C/64 are placed first and as by one global best fit decreasing; if a parcel
opens a new shard after them, every other shard is filled above 63/64. So two levels need at most the shards of one global
best fit decreasing, or 64/63 of all bytes by C plus one. A row's size is its bytes of UTF-8 plus 1; a null text has none and stands with empty texts. Slots count
a shard's rows by id (nulls last). Columns other than id and text are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.ranks import ranked
from basketry.session import discard, materialize

PARCELS = 64


class Capacities:
    """Remaining capacities of open bins in a treap; the priorities are a hash of the bin's number."""

    def __init__(self) -> None:
        self._root: list | None = None  # [key, priority, left, right]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, room: int, number: int) -> None:
        left, right = self._split(self._root, (room, number))
        priority = (number * 0x9E3779B97F4A7C15 + room * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        node = [(room, number), (priority ^ priority >> 29) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF, None, None]
        self._root = self._merge(self._merge(left, node), right)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the least remaining capacity of ``size`` or more, with its bin."""
        left, right = self._split(self._root, (size, -1))
        if right is None:
            self._root = left
            return None
        if right[2] is None:
            found, right = right[0], right[3]
        else:
            parent = right
            while parent[2][2] is not None:
                parent = parent[2]
            found, parent[2] = parent[2][0], parent[2][3]
        self._root = self._merge(left, right)
        return found


class BestFit:
    """Bins of one capacity; a larger item gets a bin of its own."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.bins, self._open = capacity, 0, Capacities()

    def place(self, size: int) -> int:
        found = self._open.take(size) if size <= self.capacity else None
        if found is None:
            room, number = self.capacity, self.bins
            self.bins += 1
        else:
            room, number = found
        if room > size:
            self._open.add(room - size, number)
        return number


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item, in the order given."""
    packer, out = BestFit(capacity), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        out[i] = packer.place(sizes[i])
    return out


def _into(sizes: list[int], shards: int) -> list[int]:
    """Bins of the least capacity of which ``shards`` are enough; an item above the others' share has a bin of its own."""
    largest = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    alone: list[int] = []
    rest = sum(sizes)
    while len(alone) < shards - 1 and len(alone) < len(sizes) and sizes[largest[len(alone)]] * (shards - len(alone)) > rest:
        rest -= sizes[largest[len(alone)]]
        alone.append(largest[len(alone)])
    others = largest[len(alone) :]
    out = [0] * len(sizes)
    for number, i in enumerate(alone):
        out[i] = number
    for i, number in zip(others, _evenly([sizes[i] for i in others], shards - len(alone)), strict=True):
        out[i] = len(alone) + number
    return out


def _evenly(sizes: list[int], shards: int) -> list[int]:
    low = max([1, math.ceil(sum(sizes) / shards), *sizes])
    high = 2 * low  # all bins but one are then more than half of it
    while low < high:
        middle = (low + high) // 2
        if max(best_fit_decreasing(sizes, middle), default=0) < shards:
            high = middle
        else:
            low = middle + 1
    return best_fit_decreasing(sizes, low)


def pack_groups(groups: DataFrame, parcel: int, capacity: int | None, shards: int | None) -> DataFrame:
    """Add ``shard`` to ``groups`` (``size`` and key columns): bins of ``capacity``, or ``shards`` bins."""
    keys = [c for c in groups.columns if c != "size"]

    def parcels(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        here, packer = TaskContext.get().partitionId(), BestFit(parcel)
        for batch in batches:
            yield batch.assign(part=here, parcel=[packer.place(int(s)) for s in batch["size"]])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in groups.schema)
    dealt = groups.repartition(*keys).sortWithinPartitions(F.col("size").desc(), *keys)
    packed = materialize(dealt.mapInPandas(parcels, f"{fields}, part int, parcel int"))
    totals = packed.groupBy("part", "parcel").agg(F.sum("size").alias("size"))
    rows = sorted((r.size, r.part, r.parcel) for r in totals.toPandas().itertuples())
    sizes = [r[0] for r in rows]
    bins = best_fit_decreasing(sizes, capacity) if shards is None else _into(sizes, shards)
    spark = groups.sparkSession
    placed = [(int(p), int(b), s) for (_, p, b), s in zip(rows, bins, strict=True)]
    # bounded: one row for each parcel
    table = F.broadcast(spark.createDataFrame(placed, "part int, parcel int, shard int"))
    return packed.join(table, ["part", "parcel"]).select(*groups.columns, "shard")


def shard_documents(documents: DataFrame, shards: int = 8) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` under the law of near-equal bytes."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("same"),
    )
    rows = materialize(rows)
    groups = materialize(rows.groupBy("same").agg(F.sum("size").alias("size")))
    total = groups.agg(F.sum("size")).first()[0] or 0
    share = max(1, math.ceil(total / shards))
    parcel = max(1, math.ceil(share / PARCELS))
    # fewer than ``shards`` of them
    large = F.broadcast(
        groups.where(F.col("size") > share).select("same", F.ceil(F.col("size") / parcel).alias("parts"))
    )
    # rows of a large group by number: ids may be null or equal
    cut = ranked(rows.join(large, "same"), ["same"], [F.col("doc_id").asc_nulls_last(), F.col("size")], "number")
    cut = cut.select(*rows.columns, F.pmod("number", "parts").alias("part_of"))
    rows = materialize(rows.join(large, "same", "left_anti").withColumn("part_of", F.lit(0).cast("long")).unionByName(cut))
    units = rows.groupBy("same", "part_of").agg(F.sum("size").alias("size"))
    units = materialize(pack_groups(units, parcel, None, shards).drop("size"))
    placed = rows.join(units, ["same", "part_of"]).select("doc_id", "size", "text_crc32", "shard")
    order = [F.col("doc_id").asc_nulls_last(), F.col("text_crc32")]
    result = ranked(placed, ["shard"], order, "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("slot") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
    discard(groups)
    return result
