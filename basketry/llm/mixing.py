"""Mix sources to target weights by systematic sampling.

Sources share the words of all documents by weight; a source's target stops at ``limit`` times its own words and the
excess is shared again by weight until none is above. That level is found in closed form from the sources sorted by
the point at which they stop. A document of a source is then expected ``target / source words`` times: the expected
copies are summed along the source from one random offset, and a document is emitted once for each whole number its
own interval crosses. The sum runs in order of size, so what a source takes differs from its target by the size of
its largest document at most.

Sizes are runs of characters other than space, tab to carriage return; a null text has none. Sources are ranked by
code point, null last. Offsets come from the seed and the source's name, so reruns agree. Rows of one id are told
apart by their texts; repeated rows take their copies in any order. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm._columns import packed
from basketry.llm.ranks import ranked
from basketry.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
LIMIT = 3
SEED = 17
#: offsets are multiples of this fraction, so that sums of whole expected copies stay exact
GRID = 1 << 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """``source, source_size, target`` from ``source, size`` rows; windows over one row for each source."""
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = sources.withColumn("weight", weight).withColumn("most", F.col("source_size") * limit)
    sources = sources.withColumn("stops", F.col("most") / F.col("weight"))
    by_stop = Window.orderBy("stops", F.col("source").asc_nulls_last())
    below = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    above = by_stop.rowsBetween(0, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    rest = F.sum("source_size").over(everywhere) - F.coalesce(F.sum("most").over(below), F.lit(0))
    sources = sources.withColumn("level", rest / F.sum("weight").over(above))
    # the first source that its share leaves below its stop sets the level of all after it
    settled = F.min(F.when(F.col("level") <= F.col("stops"), F.struct("stops", "level"))).over(everywhere)
    target = F.least(F.col("weight") * settled["level"], F.col("most").cast("double"))
    return sources.select("source", "source_size", target.alias("target"))


def _offset(source: Column, seed: int) -> Column:
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")))), 1, 5)
    return F.conv(digits, 16, 10).cast("long") / GRID


def _row_hash() -> Column:
    return F.xxhash64("doc_id", "source", "text")


def copies(
    documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT, seed: int = SEED
) -> DataFrame:
    """Per row of ``documents`` (``doc_id, text, source``): ``doc_id, source, row_hash, size, source_size, target, copies``."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sizes = materialize(documents.select("doc_id", "source", size.alias("size"), _row_hash().alias("row_hash")))
    order = [F.col("size"), F.col("doc_id").asc_nulls_last(), F.col("row_hash")]
    placed = ranked(sizes, ["source"], order, "place")
    targets = materialize(source_targets(sizes, weights, limit)).withColumnRenamed("source", "of")
    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    upto = F.floor(_offset(F.col("source"), seed) + rate * F.col("place"))
    before = F.floor(_offset(F.col("source"), seed) + rate * (F.col("place") - 1))
    # rounding of the product may add one at the edge of a whole rate
    taken = F.least(upto - before, F.ceil(rate))
    return placed.join(targets, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "row_hash", "size", "source_size", "target", taken.alias("copies")
    )


def mix(documents: DataFrame, **options) -> DataFrame:
    """The mixed documents: each row of ``documents``, with all its columns, as often as it is taken."""
    drawn = copies(documents, **options).groupBy("row_hash", "doc_id")
    drawn = materialize(drawn.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n_rows"))).where("copies > 0")
    keyed = packed(documents, key=_row_hash(), id=F.col("doc_id"))
    joined = keyed.join(drawn, (F.col("key") == F.col("row_hash")) & F.col("id").eqNullSafe(F.col("doc_id")))
    # repeated rows share the copies they take together
    single = joined.where("n_rows = 1")
    repeated = joined.where("n_rows > 1").dropDuplicates(["key", "id"])
    emitted = single.unionByName(repeated).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return emitted.select("row.*")


def mixed_sizes(documents: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: the words that the mix takes of each document."""
    return copies(documents, **options).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


ORACLE = rf"""
WITH sizes AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sizes GROUP BY source
), stops AS (
  SELECT *, (source_size * 3)::DOUBLE / weight AS stops FROM sources
), levels AS (
  SELECT *, ((sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (ORDER BY stops, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(weight) OVER (ORDER BY stops, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))) AS level
  FROM stops
), settled AS (
  SELECT level AS settled FROM levels WHERE level <= stops ORDER BY stops, level LIMIT 1
), targets AS (
  SELECT source, source_size, least(weight * settled, (source_size * 3)::DOUBLE) AS target,
         ('0x' || substr(md5('{SEED}:' || coalesce(source, '')), 1, 5))::BIGINT::DOUBLE / {GRID} AS start
  FROM levels, settled
), placed AS (
  SELECT s.*, t.source_size, t.target, t.start, coalesce(t.target / nullif(t.source_size, 0), 0) AS rate,
         row_number() OVER (PARTITION BY s.source ORDER BY s.size, s.doc_id NULLS LAST) AS place
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (least(floor(start + rate * place) - floor(start + rate * (place - 1)), ceil(rate)) * size)::BIGINT AS taken
FROM placed
"""
