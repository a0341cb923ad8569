"""Transaction lines from files, and the columnar copy of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lines(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    columns: list[str] | None = None,
    recursive: bool = False,
) -> DataFrame:
    """Lines with a header, every CSV column as text.

    ``columns`` (the full header, in file order) saves the one extra read of the header line.
    An unquoted or quoted empty field is null; the text ``NA`` stays text.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    if fmt == "csv":
        reader = reader.option("header", True).option("inferSchema", False)
        if recursive:
            reader = reader.option("pathGlobFilter", "*.csv")
        if columns:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return reader.format(fmt).load(path)


def first_csv(spark: SparkSession, directory: str) -> str:
    """First CSV below ``directory``, ordered folder by folder; the file contents are not read."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv")
        .load(directory)
        .select("path")
    )
    first = listing.agg(F.min_by("path", F.split("path", "/")).alias("path")).first()["path"]
    if first is None:
        raise FileNotFoundError(f"No CSV files found under {directory}")
    return first


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def profile(df: DataFrame) -> DataFrame:
    """One row: how many rows and columns."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns")
    )


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """Print the schema and hand back the first rows."""
    df.printSchema()
    return df.limit(rows)
