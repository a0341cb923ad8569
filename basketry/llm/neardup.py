"""Near-duplicate documents: fast similarity sketching, banding, exact verification.

A document is the set of its distinct five-word shingles (A-Z lower-cased, words are runs without white space; a
text of fewer words is one shingle; one without words has none and is linked with nothing). Two documents are
linked when ``100 * intersection >= 85 * union`` (the percentage is a parameter, 80 or more).

*Sketch.* In round i every shingle is thrown into one of t bins by a hash of its own; a coordinate keeps the least
value of the first round that reached it. After t random rounds, round t + b throws all shingles into bin b, so no
coordinate stays empty; a set of t log t shingles fills them in about one round. A coordinate agrees in two
documents with the probability of their Jaccard similarity, and agreement is concentrated as with independent
minima. Bands of 6 of the 192 coordinates make 32 bucket keys: a pair at 0.85 misses all with 3e-7. At 0.80 bands of 5 make
38, and the miss is 3e-7 as well; ``layout`` takes both bounds from the percentage.

*Groups.* Documents of equal sets are one class from the start. Within a bucket pairs are not written out: members
are tried against one leader of each bucket, twice, with components formed after each time. Only members of
different components that still share a bucket are then paired. Pairs are confirmed on the full sets unless a link is
ruled out before: by the sizes, by 384 bits of the sketch (the agreement of a pair at the threshold falls below the bound with
6e-7 at most), or by maps of 2,048 bits, of which each set only on one side stands for a shingle that the other side lacks.

A null text is empty. Rows of equal id and text give equal rows; of texts that share an id each is a document of its
own. A null id is larger than all others: it names a component only if no member has an id. An empty table gives
an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm._columns import packed
from basketry.llm._text import chunks, flat, give_back, mix, word_bounds, word_hashes
from basketry.llm.components import connected_components
from basketry.session import discard, materialize

WORDS = 5
#: coordinates of a sketch, and of a band at most
BINS, ROWS = 192, 6
#: chance of a pair at the threshold to share no band, and to agree in too few bits
MISS = 1e-6
MAP_BITS = 2048
#: members of a bucket that are paired with each other in one group
BLOCK = 2048
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_WEIGHTS = mix(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)
_SEEDS = mix(np.arange(1000, 1000 + 2 * BINS, dtype=np.uint64))
_BAND_WEIGHTS = mix(np.arange(50, 50 + ROWS, dtype=np.uint64)) | np.uint64(1)


def shingles(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    starts, ends, rows = word_bounds(data, offsets)
    hashes = word_hashes(data, starts, ends)
    first = np.searchsorted(rows, np.arange(len(offsets)))
    runs = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= WORDS:
        n = len(hashes) - WORDS + 1
        for k in range(WORDS):
            runs[:n] += hashes[k : k + n] * _WEIGHTS[k]
        runs = mix(runs)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= WORDS:
            yield np.unique(runs[a : b - WORDS + 1])
        elif b > a:
            whole = hashes[a:b] * _WEIGHTS[: b - a]
            yield mix(np.array([whole.sum() + np.uint64(b - a)], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def sketch(items: np.ndarray) -> np.ndarray:
    """The ``BINS`` coordinates of a set of hashes: round and value of the first item that came."""
    out = np.full(BINS, _EMPTY, np.uint64)
    step = max(1, 2048 // max(1, len(items)))
    for lo in range(0, BINS, step):
        seeds = _SEEDS[lo : min(BINS, lo + step)]
        thrown = mix((items[:, None] ^ seeds).ravel())
        bins = ((thrown >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        order = np.tile(np.arange(lo, lo + len(seeds), dtype=np.uint64) << np.uint64(32), len(items))
        np.minimum.at(out, bins.astype(np.int64), (thrown & np.uint64(0xFFFFFFFF)) | order)
        if not (out == _EMPTY).any():
            return out
    for b in np.flatnonzero(out == _EMPTY):
        out[b] = (mix(items ^ _SEEDS[BINS + b]) & np.uint64(0xFFFFFFFF)).min() | np.uint64((BINS + b) << 32)
    return out


def layout(percent: int) -> tuple[int, int]:
    """Coordinates of a band, and how many coordinates must agree in their two bits, for links from ``percent``."""
    same = percent / 100
    rows = max(r for r in range(1, ROWS + 1) if (1 - same**r) ** (BINS // r) <= MISS)
    p = same + (1 - same) / 4
    missed = np.cumsum([math.comb(BINS, k) * p**k * (1 - p) ** (BINS - k) for k in range(BINS)])
    return rows, int(np.searchsorted(missed, MISS, "right"))


def _profile(coordinates: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys of the bands, and two bits of each coordinate in six integers."""
    whole = coordinates[: BINS // rows * rows].reshape(-1, rows)
    bands = (whole * _BAND_WEIGHTS[:rows]).sum(axis=1, dtype=np.uint64)
    bands = mix(bands + np.arange(len(bands), dtype=np.uint64))
    bits = (mix(coordinates) >> np.uint64(62)).reshape(-1, 32) << (np.arange(32, dtype=np.uint64) * np.uint64(2))
    return bands, np.bitwise_or.reduce(bits, axis=1)


def _set_key(items: np.ndarray) -> bytes:
    return hashlib.blake2b(items.tobytes(), digest_size=16).digest()


def _map(items: np.ndarray) -> np.ndarray:
    """Which of the 2,048 values of their leading 11 bits the items have."""
    flags = np.zeros(MAP_BITS, np.uint8)
    flags[(items >> np.uint64(53)).astype(np.int64)] = 1
    return np.packbits(flags).view(np.uint64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    values = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))


def _sketches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        for lo, hi in chunks(offsets):
            at = offsets[lo : hi + 1]
            sizes, keys, bands, bits = [], [], [], []
            for items in shingles(data[at[0] : at[-1]], at - at[0]):
                sizes.append(len(items))
                keys.append(_set_key(items))
                band, bit = _profile(sketch(items), rows) if len(items) else (items, items)
                bands.append(band)
                bits.append(bit)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(lo, hi - lo),
                    batch.column("row_hash").slice(lo, hi - lo),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    _lists(bands),
                    _lists(bits),
                ],
                ["doc_id", "row_hash", "n", "key", "bands", "bits"],
            )
    give_back()


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = flat(batch.column("text"))
        for lo, hi in chunks(offsets):
            at = offsets[lo : hi + 1]
            items = list(shingles(data[at[0] : at[-1]], at - at[0]))
            keys = pa.array([_set_key(i) for i in items], pa.binary())
            maps = _lists([_map(i) for i in items])
            yield pa.RecordBatch.from_arrays([keys, _lists(items), maps], ["key", "items", "map"])
    give_back()


def _only(left: str, right: str) -> Column:
    """Bits of one map that the other lacks; a loop, as compiled code for every word would be too long to run fast."""
    lacking = F.zip_with(left, right, lambda a, b: F.bit_count(a.bitwiseAND(F.bitwise_not(b))))
    return F.aggregate(lacking, F.lit(0), lambda total, n: total + n)


def _may_link(percent: int) -> Column:
    """Bounds on a link from the sizes, the sketch bits and the maps of two classes x and y."""
    agree = F.lit(0)
    for k in range(BINS // 32):
        # the two bits of a coordinate agree where neither bit of the exclusive or is set
        differ = F.col("x.bits")[k].bitwiseXOR(F.col("y.bits")[k])
        differ = differ.bitwiseOR(F.shiftright(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))
        agree += F.lit(32) - F.bit_count(differ)
    near = F.least("x.n", "y.n") * 100 >= F.greatest("x.n", "y.n") * percent
    only_x, only_y = _only("x.map", "y.map"), _only("y.map", "x.map")
    most = F.least(F.col("x.n") - only_x, F.col("y.n") - only_y)
    return near & (agree >= layout(percent)[1]) & (most * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row for each row of ``documents`` (``doc_id``, ``text``)."""
    placed = components(documents, percent)
    named = placed.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    out = placed.join(named, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(documents: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each component, that of the smallest id (then of the smallest text hash), with all its columns.

    Texts without words are linked with nothing and all stay.
    """
    placed = components(documents, percent)
    rows = placed.groupBy("label", "doc_id", "row_hash", (F.col("n") > 0).alias("words")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_hash", "rows")).alias("first")
    winners = rows.where("words").groupBy("label").agg(first).select(
        "first.doc_id", "first.row_hash", (F.col("first.rows") > 1).alias("more")
    )
    wordless = rows.where("NOT words").select("doc_id", "row_hash", F.lit(False).alias("more"))
    winners = materialize(winners.unionByName(wordless))
    keyed = packed(documents, key=F.xxhash64("text"), id=F.col("doc_id"))
    joined = keyed.join(winners, (F.col("key") == F.col("row_hash")) & F.col("id").eqNullSafe(F.col("doc_id")))
    repeated = joined.where("more").dropDuplicates(["key", "id"])
    return joined.where("NOT more").unionByName(repeated).select("row.*")


def components(documents: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, row_hash, n, label``: the shingles of each row and its component, named by one of its sets."""
    if percent < 80:
        raise ValueError("the bands are laid out for links of 80 percent and above")
    band, _ = layout(percent)
    texts = documents.select("doc_id", "text", F.xxhash64("text").alias("row_hash"))
    docs = materialize(
        texts.mapInArrow(
            lambda batches: _sketches(batches, band), "doc_id long, row_hash long, n long, key binary, bands array<long>, bits array<long>"
        )
    )
    classes = docs.where("n > 0").select("key", "n", "bands", "bits").dropDuplicates(["key"])
    classes = materialize(classes)

    rows = classes.select(F.explode("bands").alias("bucket"), "key")
    shared = rows.groupBy("bucket").agg(F.min("key").alias("leader"), F.max("key").alias("last"))
    shared = shared.where("leader != last")
    members = materialize(rows.join(shared, "bucket").select("bucket", "leader", "key"))

    wanted = members.select("key").distinct().join(docs.select("key", "doc_id"), "key")
    wanted = wanted.groupBy("key").agg(F.min("doc_id").alias("doc_id")).select("doc_id").distinct()
    chosen = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi")
    sets = materialize(
        chosen.mapInArrow(_sets, "key binary, items array<long>, map array<long>").dropDuplicates(["key"])
    )
    profiles = materialize(classes.select("key", "n", "bits").join(sets.select("key", "map"), "key"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs ``a, b``, those linked by their full sets."""
        left = sets.select(F.col("key").alias("a"), F.col("items").alias("xs"))
        right = sets.select(F.col("key").alias("b"), F.col("items").alias("ys"))
        both = pairs.join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("xs", "ys"))
        union = F.size("xs") + F.size("ys") - common
        return materialize(both.where(common * 100 >= union * percent).select("a", "b"))

    def star(spokes: DataFrame) -> DataFrame:
        """Links between leaders and members (``a``, ``b``)."""
        pairs = spokes.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        near = (
            pairs.join(profiles.alias("x"), F.col("a") == F.col("x.key"))
            .join(profiles.alias("y"), F.col("b") == F.col("y.key"))
            .where(_may_link(percent))
        )
        return confirmed(near.select("a", "b"))

    first = star(members.select(F.col("leader").alias("a"), F.col("key").alias("b")))
    labelled, mixed = _mixed(members, connected_components(first))
    leaders = mixed.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("key"), "key", "label")).alias("l"))
    again = mixed.join(leaders, "bucket").where("label != l.label")
    second = star(again.select(F.col("l.key").alias("a"), F.col("key").alias("b")))

    links = first.unionByName(second)
    labelled, mixed = _mixed(members, connected_components(links))
    rest = materialize(mixed.join(profiles, "key"))
    apart = _met(rest).where(_may_link(percent))
    third = confirmed(apart.select(F.col("x.key").alias("a"), F.col("y.key").alias("b")).distinct())
    labels = connected_components(links.unionByName(third))

    placed = docs.select("doc_id", "row_hash", "n", "key").join(
        labels.select(F.col("node").alias("key"), "label"), "key", "left"
    )
    result = materialize(placed.select("doc_id", "row_hash", "n", F.coalesce("label", "key").alias("label")))
    discard(docs, classes, members, sets, profiles, first, second, third, rest, labels)
    return result


def _met(rest: DataFrame, block: int = BLOCK) -> DataFrame:
    """``x``, ``y``: any two members of a bucket in different components, the smaller key first.

    A bucket's members are cut into blocks of about ``block`` and block meets block, so that no task pairs a whole bucket of
    documents on one template; a bucket of one block, nearly all, is joined as it is.
    """
    sizes = rest.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    dealt = rest.join(sizes, "bucket").select(
        *rest.columns,
        F.pmod(F.xxhash64("key"), "blocks").cast("int").alias("own"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("meets"),
    )
    x, y = dealt.alias("x"), dealt.alias("y")
    same = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.own") == F.col("y.meets")) & (F.col("x.meets") == F.col("y.own"))
    return x.join(y, same & (F.col("x.key") < F.col("y.key")) & (F.col("x.label") != F.col("y.label")))


def _mixed(members: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members with their components, and those of buckets that hold more than one component."""
    labelled = members.join(labels, F.col("key") == F.col("node"), "left").select(
        "bucket", "key", F.coalesce("label", "key").alias("label")
    )
    labelled = materialize(labelled)
    split = labelled.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return labelled, labelled.join(split.where("lo != hi").select("bucket"), "bucket")
