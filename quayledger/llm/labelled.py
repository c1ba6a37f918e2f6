"""Bounded samples of labelled documents, and the fold that is held out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayledger.llm.shared import texts_of


def fold(doc_id: str, folds: int) -> F.Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def sample(docs: DataFrame, labels: DataFrame, column: str, folds: int, held_out: int, rows: int, chars: int) -> list[tuple[bytes, int]]:
    """(text, label) of at most `rows` labelled documents of each class outside the held-out fold, those of the smallest hashes of
    their ids among texts of at most `chars` characters; at most 8 * rows * chars bytes come to the driver."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", folds) != held_out))
    short = texts_of(docs).where(F.length("text") <= chars)
    ids = known.join(short.select("doc_id"), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), "doc_id"]
    chosen = ids.where("label = 0").orderBy(*order).limit(rows).unionByName(ids.where("label = 1").orderBy(*order).limit(rows))
    found = short.join(F.broadcast(chosen), "doc_id").orderBy(*order, "text").limit(2 * rows).select("text", "label")  # at most 2 * rows ids
    return [(r["text"].encode(), r["label"]) for r in found.collect()]
