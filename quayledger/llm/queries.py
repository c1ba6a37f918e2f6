"""The operators' queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayledger.llm import binary, chat, codes, decontaminate, licenses, packing, quality, resampling, rules, simhash, suffixes, toxicity, vectors
from quayledger.llm.shared import Workspace


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return packing.pack(docs, Workspace(spark), with_ids=False).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents, with up to a fifth of their words edited."""
    return decontaminate.leaks(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and texts in all documents."""
    return licenses.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op4_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose fingerprints are within three bits, over all documents."""
    return simhash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark))


def op5_chat_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All maximal conversations, rendered."""
    return chat.chat_texts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op6_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that stand in several documents."""
    return suffixes.repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), Workspace(spark))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by clauses."""
    return toxicity.with_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality by the byte network."""
    return quality.with_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written to token files and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return binary.token_files(docs, Workspace(spark)).select("doc_id", "start", "n_tokens", "ids_crc32")


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors with a cosine of 0.95 or more, over all embeddings."""
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Workspace(spark))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in eight bytes each, by codebooks fitted on all of them."""
    found = codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), Workspace(spark)).rows
    return found.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts and the verdict of the rules."""
    return rules.report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by the benchmark's word runs, the best twentieth ranked."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resampling.resample(docs, target, Workspace(spark)).select("doc_id", "n_features", "weight", "score", "rank")


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of this subpackage, by name."""
    found = [op1_best_fit_packing, op2_benchmark_leaks, op3_license_scan, op4_simhash_groups, op5_chat_texts, op6_suffix_repeats, op7_toxicity, op8_quality, op9_token_files, op10_near_vectors, op11_vector_codes, op12_quality_rules, op13_target_resampling]
    return {f.__name__: f for f in found}


def llm_oracle() -> dict[str, str]:
    """The same results in DuckDB's SQL where it can express them."""
    return {"op3_license_scan": licenses.scan_sql(), "op5_chat_texts": chat.CHAT_SQL, "op11_vector_codes": codes.compress_sql(), "op12_quality_rules": rules.report_sql(), "op13_target_resampling": resampling.resample_sql()}
