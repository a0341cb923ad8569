"""The registered queries of the training-text operators, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import alignment, decontaminate, fingerprints, linedup, mixing, neardup, prefixtrie, repeats, secrets, sharding, tokens, warc, weaklabels
from basketry.session import new_table_path

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of a tokenizer file; by default the one that the token queries use."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_context_mixed_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokenize(_table(spark, sf_dir, "documents"), vocabulary())


def op2_systematic_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, sf_dir, "documents"))


def op3_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    versions = documents.select(F.col("doc_id").alias("path"), F.lit(0).alias("version"), "text")
    addressed, findings = secrets.scan_versions(versions, new_table_path(spark))
    kinds = tuple(r.kind for r in secrets.BASE)
    return secrets.span_digests(secrets.spans_by_version(addressed, findings, kinds))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.deduplicate_pages(_table(spark, sf_dir, "pages"))


def op5_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linedup.remove_repeated_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("cleaned_sha256"))


def op6_fast_sketch_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"))


def op7_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op8_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("row_hash")


def op9_quartile_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_likeness(_table(spark, sf_dir, "documents"))


def op10_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weaklabels.classify(_table(spark, sf_dir, "documents"))


def op11_gustavson_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_digests(_table(spark, sf_dir, "documents"), vocabulary(), vocabulary("piece_bpe_32k.model"))


def op12_run_length_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"), with_bytes=False).drop("text")


def op13_time_forward_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_context_mixed_tokens": op1_context_mixed_tokens,
    "op2_systematic_mix": op2_systematic_mix,
    "op3_blob_ledger_secrets": op3_blob_ledger_secrets,
    "op4_warc_revisits": op4_warc_revisits,
    "op5_line_windows": op5_line_windows,
    "op6_fast_sketch_neardup": op6_fast_sketch_neardup,
    "op7_best_fit_shards": op7_best_fit_shards,
    "op8_latent_decontamination": op8_latent_decontamination,
    "op9_quartile_fingerprints": op9_quartile_fingerprints,
    "op10_weak_label_quality": op10_weak_label_quality,
    "op11_gustavson_alignment": op11_gustavson_alignment,
    "op12_run_length_repeats": op12_run_length_repeats,
    "op13_time_forward_trie": op13_time_forward_trie,
}

ORACLES: dict[str, str] = {
    "op2_systematic_mix": mixing.ORACLE,
    "op5_line_windows": linedup.ORACLE,
    "op12_run_length_repeats": repeats.ORACLE,
    "op13_time_forward_trie": prefixtrie.ORACLE,
}
