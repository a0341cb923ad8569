"""Prefix trie of conversations, its totals by time-forward processing.

*Rebuilding.* A conversation ``c`` begins with the first ``h`` turns of conversation ``c - c % 20`` (all if it has fewer, none if there is
no such), ``h`` being the CRC-32 of its decimal id modulo 4, and goes on with its own turns after the first ``h``. Turns are
ordered by ``turn`` (nulls first), then role and text; null roles and texts are empty. Rows without a ``conv_id``
belong to no conversation. Repeated rows are turns of their own. No conversation: no node, not even a root.

*Nodes.* A node is a sequence of first turns, known by its depth and 128 bits: the exclusive-or of a hash of each turn with its
place, which running aggregates over range partitions give for a conversation of any length. Depth and smallest member
(``conv_id``) name a node as well; that is its number below.

*Totals.* Children have to be done before their parents. Inside a shard, nodes are sorted externally in reverse level order, and each
sends its totals forward to its parent through a priority queue that spills sorted runs; the parent takes them out when its turn
comes. A shard is the tree below a node of at most ``LIMIT`` members whose parent has more; totals of shard roots are summed
for their parents and go into the next phase, whose nodes have ``LIMIT`` times as many members, until the root is done. Hence no
shard has more than ``LIMIT`` nodes on a level, whatever turns conversations share. Nodes of one member are paths and
need no queue: one leaf, nothing saved.

The ids that end at a node are hashed as a sorted stream, one node in one task with bounded memory, since SHA-256 reads in order.
Queues spill to unnamed files of their task, which vanish with it, as Spark's own sorts do.
"""

from __future__ import annotations

import hashlib
import heapq
import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.ranks import ranked
from basketry.session import materialize

GROUP = 20
HEADS = 4
WORD = r"[^\x20\x09-\x0D]+"
#: members up to which a tree is one shard, and nodes on a level of a later shard
LIMIT = 4096
#: messages that a queue keeps in memory
HELD = 1 << 18
EMPTY_SHA256 = hashlib.sha256().hexdigest()


def _heads(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % HEADS


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conv_id, depth, total, c1, c2, words`` of every rebuilt turn, and ``conv_id, total`` of every conversation.

    ``c1, c2``: 128 bits of role and text; ``total``: the conversation's number of rebuilt turns.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text"))
    own = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role, text)
    order = [F.asc_nulls_first("turn"), F.asc("role"), F.asc("text")]
    content = [F.xxhash64(F.lit(i), "role", "text").alias(f"c{i}") for i in (1, 2)]
    own = materialize(
        ranked(own, ["conv_id"], order, "at").select("conv_id", "at", *content, F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"))
    )
    base = (F.col("conv_id") - F.pmod("conv_id", F.lit(GROUP))).alias("base")
    counts = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own"))
    counts = materialize(counts.select("conv_id", "n_own", base, _heads(F.col("conv_id")).alias("h")))
    first = counts.where(F.col("conv_id") == F.col("base")).select("base", F.col("n_own").alias("n_base"))
    taken = F.least("h", F.coalesce("n_base", F.lit(0)))
    conversations = materialize(
        counts.join(first, "base", "left").select(
            "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("total")
        )
    )
    heads = own.where((F.pmod("conv_id", F.lit(GROUP)) == 0) & (F.col("at") < HEADS)).withColumnRenamed("conv_id", "base")
    rest = ["c1", "c2", "words"]
    prefix = conversations.join(heads, "base").where("at <= taken").select("conv_id", F.col("at").alias("depth"), "total", *rest)
    tail = own.join(conversations, "conv_id").where("at > h")
    tail = tail.select("conv_id", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "total", *rest)
    return prefix.unionByName(tail), conversations.select("conv_id", "total")


def memberships(turns: DataFrame) -> DataFrame:
    """Adds the key ``x1, x2`` of the node that each turn leads to, and ``p1, p2``, the key of the node it comes from.

    A running exclusive-or, range by range: one conversation of a third of all turns spreads over many tasks.
    """
    lanes = {f"l{i}": F.xxhash64(F.lit(i), "depth", "c1", "c2") for i in (1, 2)}
    turns = turns.withColumns(lanes).drop("c1", "c2")
    dealt = materialize(turns.repartitionByRange("conv_id", "depth").withColumn("range", F.spark_partition_id()))
    sums = dealt.groupBy("conv_id", "range").agg(*[F.bit_xor(f"l{i}").alias(f"s{i}") for i in (1, 2)])
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("conv_id", "range", *[F.coalesce(F.bit_xor(f"s{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)])
    inside = Window.partitionBy("range", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = dealt.withColumns({f"r{i}": F.bit_xor(f"l{i}").over(inside) for i in (1, 2)})
    keyed = run.join(offsets, ["conv_id", "range"])
    x = {f"x{i}": F.col(f"r{i}").bitwiseXOR(F.col(f"o{i}")) for i in (1, 2)}
    keyed = keyed.withColumns(x).withColumns({f"p{i}": F.col(f"x{i}").bitwiseXOR(F.col(f"l{i}")) for i in (1, 2)})
    return materialize(keyed.select("conv_id", "depth", "total", "words", "x1", "x2", "p1", "p2"))


KEY = ["depth", "x1", "x2"]


def _nodes(members: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for each node: its key, ``conv_id``, ``n_convs``, ``n_ends``, ``own`` (words saved), and its parent's name and members."""
    ends = F.sum((F.col("depth") == F.col("total")).cast("long"))
    below = members.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        ends.alias("n_ends"),
        F.max("words").alias("words"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
    )
    none = F.lit(0).cast("long")
    root = conversations.agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum((F.col("total") == 0).cast("long")).alias("n_ends")
    ).where("n_convs > 0")
    root = root.select(none.alias("depth"), none.alias("x1"), none.alias("x2"), "conv_id", "n_convs", "n_ends", none.alias("words"), *[none.alias(p) for p in ("p1", "p2")])
    nodes = materialize(below.withColumn("depth", F.col("depth").cast("long")).unionByName(root))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_convs").alias("parent_n")
    )
    return materialize(
        nodes.join(parents, ["depth", "p1", "p2"], "left").select(
            *KEY, "conv_id", "n_convs", "n_ends", ((F.col("n_convs") - 1) * F.col("words")).alias("own"), "parent_conv_id", "parent_n"
        )
    )


class SpillingQueue:
    """A priority queue of messages ``(level, parent, children, leaves, saved)``, least first; sorted runs go to unnamed files."""

    _ROWS = 4096

    def __init__(self, held: int = HELD) -> None:
        self._held = held
        self._heap: list[tuple[int, int, int, int, int]] = []
        self._runs: list[tuple[tuple[int, int, int, int, int], int, Iterator]] = []
        self.spilled = 0

    def __len__(self) -> int:
        return len(self._heap) + len(self._runs)

    def push(self, message: tuple[int, int, int, int, int]) -> None:
        heapq.heappush(self._heap, message)
        if len(self._heap) > self._held:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        file.write(np.array(sorted(self._heap), np.int64).tobytes())
        file.seek(0)
        self._heap = []
        self.spilled += 1
        rows = self._read(file)
        heapq.heappush(self._runs, (next(rows), self.spilled, rows))

    def _read(self, file) -> Iterator[tuple[int, int, int, int, int]]:
        with file:
            while part := file.read(40 * self._ROWS):
                yield from map(tuple, np.frombuffer(part, np.int64).reshape(-1, 5).tolist())

    def take(self, level: int, node: int) -> tuple[int, int, int]:
        """Sums of all messages to this node."""
        to, children, leaves, saved = (level, node), 0, 0, 0
        while self._heap and self._heap[0][:2] == to:
            _, _, c, n, s = heapq.heappop(self._heap)
            children, leaves, saved = children + c, leaves + n, saved + s
        while self._runs and self._runs[0][0][:2] == to:
            (_, _, c, n, s), number, rows = self._runs[0]
            children, leaves, saved = children + c, leaves + n, saved + s
            following = next(rows, None)
            if following is None:
                heapq.heappop(self._runs)
            else:
                heapq.heapreplace(self._runs, (following, number, rows))
        return children, leaves, saved


_TOTALS = ["depth", "conv_id", "parent_conv_id", "parent_n", "n_children", "n_leaves", "saved_tokens"]
_TOTALS_SCHEMA = pa.schema([(c, pa.int64()) for c in _TOTALS])


def time_forward(limit: int, held: int = HELD):
    """Totals of the nodes of one task's shards, which come in reverse level order, level by level in order of name.

    ``limit``: a node whose parent has more members is a shard's root; its totals are not sent here.
    """

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(held)
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("depth", "conv_id", "parent_conv_id", "parent_n", "own", "children", "leaves", "saved")]
            out = []
            for depth, node, parent, parent_n, own, children, leaves, saved in zip(*columns):
                c, n, s = queue.take(-depth, node)
                children += c
                leaves = leaves + n if children else 1
                saved += s + own
                out.append((depth, node, parent, parent_n, children, leaves, saved))
                if parent_n is not None and parent_n <= limit:
                    queue.push((1 - depth, parent, 1, leaves, saved))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=_TOTALS_SCHEMA)
        if len(queue):
            raise ValueError("totals were sent to a node that its shard does not have")

    return forward


def _messages(totals: DataFrame, limit: int) -> DataFrame:
    """What shard roots pass on, summed for each parent."""
    sent = totals.where(F.col("parent_n") > limit)
    return sent.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_conv_id").alias("conv_id")).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )


def subtree_totals(nodes: DataFrame, members: DataFrame, limit: int = LIMIT, held: int = HELD) -> DataFrame:
    """``depth, conv_id, n_children, n_leaves, saved_tokens`` of every node."""
    most = nodes.agg(F.max("n_convs")).first()[0] or 0
    one = F.lit(1).cast("long")
    paths = nodes.where("n_convs = 1").select(
        "depth", "conv_id", "parent_conv_id", "parent_n", (1 - F.col("n_ends")).alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens")
    )
    done, least, top = [paths], 1, limit
    waiting = _messages(paths, 1)
    while least < most:
        here = nodes.where((F.col("n_convs") > least) & (F.col("n_convs") <= top))
        if top < most:
            roots = nodes.where((F.col("n_convs") <= top) & (F.col("n_convs") > least) & (F.col("parent_n") > top))
            shards = members.join(roots.select(*KEY), KEY).select("conv_id", F.xxhash64(*KEY).alias("shard"))
            here = here.join(shards, "conv_id")
        else:
            here = here.withColumn("shard", F.lit(0).cast("long"))
        filled = [F.coalesce(c, F.lit(0)).alias(c) for c in ("children", "leaves", "saved")]
        here = here.join(waiting, ["depth", "conv_id"], "left").select("depth", "conv_id", "parent_conv_id", "parent_n", "own", *filled, "shard")
        ordered = here.repartition("shard").sortWithinPartitions(F.desc("depth"), F.asc("conv_id"))
        totals = materialize(ordered.mapInArrow(time_forward(top, held), ", ".join(f"{c} bigint" for c in _TOTALS)))
        done.append(totals)
        # parents may also wait for children done in earlier phases
        waiting = reduce(DataFrame.unionByName, [_messages(t.where(F.col("parent_n") <= top * limit), top) for t in done])
        waiting = waiting.groupBy("depth", "conv_id").agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
        least, top = top, top * limit
    return reduce(DataFrame.unionByName, done).select("depth", "conv_id", "n_children", "n_leaves", "saved_tokens")


def hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the sorted ids of each node, as a stream: ``depth, x1, x2, ends_sha256``."""
    schema = pa.schema([*((c, pa.int64()) for c in KEY), ("ends_sha256", pa.string())])
    node, digest = None, None
    for batch in batches:
        out = []
        for *key, conv in zip(*(batch.column(c).to_pylist() for c in [*KEY, "conv_id"])):
            if key != node:
                if digest:
                    out.append((*node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(str(conv).encode())
            else:
                digest.update(f",{conv}".encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    if digest:
        yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((*node, digest.hexdigest()), schema.types)], schema=schema)


def prefix_trie(conversations: DataFrame, limit: int = LIMIT, held: int = HELD) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations."""
    turns, known = rebuilt_turns(conversations)
    members = memberships(turns.withColumn("depth", F.col("depth").cast("long")))
    nodes = _nodes(members, known)
    totals = subtree_totals(nodes, members, limit, held)
    none = F.lit(0).cast("long")
    ends = members.where("depth = total").select(*KEY, "conv_id").unionByName(
        known.where("total = 0").select(none.alias("depth"), none.alias("x1"), none.alias("x2"), "conv_id")
    )
    digests = ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv_id").mapInArrow(hash_ends, "depth bigint, x1 bigint, x2 bigint, ends_sha256 string")
    return (
        nodes.join(totals, ["depth", "conv_id"])
        .join(digests, KEY, "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        )
    )


#: DuckDB has no CRC-32: its register over the characters of the decimal id, bit by bit (polynomial 0xEDB88320)
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda r, i: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)"""

ORACLE = f"""
WITH own AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS spot
  FROM conversations WHERE conv_id IS NOT NULL
), counted AS (
  SELECT conv_id, count(*) AS n_own FROM own GROUP BY conv_id
), convs AS (
  SELECT a.conv_id, a.h, least(a.h, coalesce(b.n_own, 0)) AS taken, a.base
  FROM (SELECT conv_id, n_own, {_CRC} % 4 AS h, conv_id - (conv_id % 20 + 20) % 20 AS base FROM counted) a
  LEFT JOIN counted b ON b.conv_id = a.base
), rebuilt AS (
  SELECT c.conv_id, o.spot AS depth, o.role, o.text FROM convs c JOIN own o ON o.conv_id = c.base WHERE o.spot <= c.taken
  UNION ALL
  SELECT c.conv_id, o.spot - c.h + c.taken, o.role, o.text FROM convs c JOIN own o USING (conv_id) WHERE o.spot > c.h
), paths AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words,
         md5(string_agg(md5(role) || md5(text), '') OVER (PARTITION BY conv_id ORDER BY depth)) AS path
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
), members AS (
  SELECT conv_id, depth, words, min(conv_id) OVER n AS node, count(*) OVER n AS n_convs,
         max(depth) OVER (PARTITION BY conv_id) AS total
  FROM paths WINDOW n AS (PARTITION BY depth, path)
), nodes AS (
  SELECT node, depth, any_value(n_convs) AS n_convs, (any_value(n_convs) - 1) * any_value(words) AS own_words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = total), '')) AS ends_sha256
  FROM members GROUP BY node, depth
), parents AS (
  SELECT n.*, p.node AS parent FROM nodes n LEFT JOIN members p ON p.conv_id = n.node AND p.depth = n.depth - 1
), children AS (
  SELECT parent, depth - 1 AS depth, count(*) AS n FROM parents WHERE parent IS NOT NULL GROUP BY ALL
), below AS (
  SELECT a.node, a.depth, sum(n.own_words) AS saved, count(*) FILTER (WHERE c.n IS NULL) AS leaves
  FROM nodes n JOIN members a ON a.conv_id = n.node AND a.depth <= n.depth
  LEFT JOIN children c ON c.parent = n.node AND c.depth = n.depth GROUP BY a.node, a.depth
)
SELECT n.node AS conv_id, n.depth::BIGINT AS depth, n.parent AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children,
       b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM parents n JOIN below b USING (node, depth) LEFT JOIN children c ON c.parent = n.node AND c.depth = n.depth
"""
