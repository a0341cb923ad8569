"""A training corpus from ``documents``: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontaminate, mixing, neardup, tokens, weaklabels
from basketry.llm.queries import vocabulary
from basketry.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier, fitted on ``docs``, does not reject."""
    return weaklabels.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8 and more."""
    return neardup.deduplicate(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids written to files, one row for each document in them, as read back."""
    return tokens.tokenize(docs, vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing to target weights", mixture),
    ("token ids", token_ids),
]

# models and hashed sketches have no SQL; the tests hold the stages against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
