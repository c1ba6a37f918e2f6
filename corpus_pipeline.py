"""The corpus pipeline: its stages in order, and run() over a folder of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayledger.llm import decontaminate, packing, quality, simhash, suffixes
from quayledger.llm.shared import Workspace, batch_rows, lean_workers

#: Rows of an Arrow batch in stages that read whole texts, and Spark's own number.
TEXT_ROWS, SPARK_ROWS = 1000, 10_000


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network accepts."""
    lean_workers(spark)  # before the first worker starts, for all stages
    batch_rows(spark, TEXT_ROWS)
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near fingerprints."""
    batch_rows(spark, TEXT_ROWS)
    return simhash.one_of_each(docs, Workspace(spark))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has."""
    batch_rows(spark, SPARK_ROWS)
    return suffixes.cut_repeats(docs, Workspace(spark))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    batch_rows(spark, TEXT_ROWS)
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), Workspace(spark))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequences and places."""
    batch_rows(spark, TEXT_ROWS)
    return packing.pack(docs, Workspace(spark))


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("repeats", without_repeats),
    ("benchmark", without_benchmark),
    ("packing", packed),
]

#: Near-duplicate groups, a trained model and edit distances are beyond SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    ws = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = ws.save(stage(spark, docs, sf_dir), name)
    return docs
