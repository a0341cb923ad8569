"""Session factory and the one place where intermediate tables are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_scopes: list[list[str]] = []


def create_session(app_name: str = "basketry", **conf: str) -> SparkSession:
    """Return the active session or build one.

    The master is left to ``spark-submit`` or to ``conf``; nothing here pins the job to one machine.
    """
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        # a mining run compiles a few stages per level; keep them for the next run
        "spark.sql.codegen.cache.maxEntries": "1000",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # collect_list stays hash based for this many baskets per task before it turns to sorting
        "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "50000",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's setting, else (local mode only) our own."""
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="basketry-"))
    return spark.sparkContext.getCheckpointDir()


def new_table_path(spark: SparkSession) -> str:
    path = f"{checkpoint_root(spark)}/basketry/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    for paths in _scopes[-1:]:
        paths.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at its end, every intermediate table written inside.

    Results are lazy and read those tables, so a caller writes or collects them before the scope ends.
    """
    _scopes.append([])
    try:
        yield
    finally:
        _delete(spark, _scopes.pop())


def _delete(spark: SparkSession, paths: list[str]) -> None:
    context = spark.sparkContext
    for name in paths:
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and read it back.

    This cuts the lineage like ``checkpoint()`` and survives lost executors, and the columnar copy
    keeps column pruning, filter pushdown and true file sizes, from which Catalyst picks its joins.
    """
    spark = df.sparkSession
    path = new_table_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame) -> tuple[DataFrame, int]:
    """:func:`materialize` plus the number of rows, which Parquet keeps in its footers."""
    table = materialize(df)
    return table, table.count()


def materialize_bucketed(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """Write ``df`` dealt by ``keys`` into ``n`` buckets, one file each, and read it as a table that knows so.

    Joins and groups on these keys then read it without another exchange, as often as they like.
    """
    spark = df.sparkSession
    path = new_table_path(spark)
    name = f"basketry_{path.rsplit('/', 1)[1]}"
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    table = spark.table(name)
    # the plan knows the buckets; the files stay, as the path is ours
    spark.sql(f"DROP TABLE {name}")
    return table


def discard(*tables: DataFrame) -> None:
    """Delete written tables that nothing will read again; files from elsewhere are left alone."""
    for table in tables:
        own = f"/basketry/{table.sparkSession.sparkContext.applicationId}/"
        folders = {path.rsplit("/", 1)[0] for path in table.inputFiles() if own in path}
        _delete(table.sparkSession, sorted(folders))
