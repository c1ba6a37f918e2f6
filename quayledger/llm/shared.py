"""Helpers of the operators: tables in the shared folder, Arrow batches, connected components."""

from __future__ import annotations

import os
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package; on a cluster it is installed or given with --py-files."""
    settings = spark.sparkContext.environment
    known = settings.get("PYTHONPATH", "")
    if ROOT not in known.split(os.pathsep):
        settings["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)
    if ROOT not in sys.path:
        sys.path.insert(0, ROOT)


#: glibc and Arrow settings by which large arrays are mapped, and given back when they are freed, whatever sizes came before.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "4194304", "MALLOC_TRIM_THRESHOLD_": "4194304", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def lean_workers(spark: SparkSession) -> None:
    """Let workers that start from now on give freed memory back. They live as long as their executor, and without this a stage's
    memory stays with those after it: 427 against 256 MB in a worker after scoring, hashing and tokenizing 40 MB of Parquet."""
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


def batch_rows(spark: SparkSession, rows: int) -> None:
    """Rows of an Arrow batch from the next job on. Whole texts go in batches of fewer rows, which the executor and its workers
    each hold twice; stages on small rows keep Spark's number."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def text_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs run inside send whole texts to lean workers, in Arrow batches of at most `rows` rows; the session's own number comes back after."""
    lean_workers(spark)
    before = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    batch_rows(spark, min(before, rows) if before > 0 else rows)
    try:
        yield
    finally:
        batch_rows(spark, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; in local mode, where it is unset, a folder of this session's own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Workspace:
    """Tables of one run in the shared folder. A written table cuts the lineage, and a lost executor costs only what it
    was computing. `drop` removes tables no later step reads; the rest stays for the lazy result."""

    def __init__(self, spark: SparkSession):
        ship(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
        self._paths: dict[int, str] = {}
        self._made = 0

    def path(self, name: str) -> str:
        self._made += 1
        return f"{self.folder}/{self._made:03d}-{name}"

    def save(self, df: DataFrame, name: str = "table") -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for table in tables:
            if path := self._paths.pop(id(table), None):
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Rows of a side that is sent to all executors, about 16 bytes each; a larger side is shuffled like any.
MOST_SENT = 1_000_000


def sent_if_small(side: DataFrame, rows: int, most: int = MOST_SENT) -> DataFrame:
    """The side of a join with a broadcast hint if it has at most `most` rows (as counted by the caller), so that whole texts
    need no shuffle; else as it is."""
    return F.broadcast(side) if rows <= most else side


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id as long and whole text, null texts empty; columns of other names are left behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def slices(batches: Iterator[pa.RecordBatch], most_bytes: int = 2 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts as UTF-8 bytes) of a frame (id, text), in runs of at most most_bytes or one text."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
        start = held = 0
        for k in range(len(ids)):
            size = len(texts[k].as_buffer()) if texts[k].is_valid else 0
            if held and held + size > most_bytes:
                yield ids[start:k], texts.slice(start, k - start).to_pylist()
                start, held = k, 0
            held += size
        if start < len(ids):
            yield ids[start:], texts.slice(start).to_pylist()


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by `keys`; a group is held back until its last row has come."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        last = {k: table[k][-1] for k in keys}
        same = np.ones(table.num_rows, bool)
        for k in keys:
            same &= table[k].combine_chunks().to_numpy(zero_copy_only=False) == last[k].as_py()
        cut = table.num_rows - int(same[::-1].argmin() if not same.all() else table.num_rows)
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None:
        yield held.combine_chunks()


def ranges(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Starts of the groups of a sorted table, and its length at the end."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in keys:
        column = table[k].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(new), table.num_rows)


def forest(count: int, linked: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Tree edges over 0..count-1; linked(i, others) says which others i is linked with. No more than count - 1 edges,
    however many links there are."""
    edges, open_ = [], np.arange(count)
    while open_.size:
        front, open_ = [int(open_[0])], open_[1:]
        while front and open_.size:
            i = front.pop()
            hit = linked(i, open_)
            if hit.any():
                found = open_[hit]
                edges += [(i, int(j)) for j in found]
                front += found.tolist()
                open_ = open_[~hit]
    return edges


def components(edges: DataFrame, ws: Workspace) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), root the smallest node reachable; nodes without links are absent.

    Each node points to its smallest smaller neighbour, the pointers are halved until they end at nodes without one, and
    the links are redrawn between those. Every round removes all nodes that have a smaller neighbour, so few rounds
    remain even for long chains. All joins read written tables on both sides, so a hot node is split by the skew join."""
    links = ws.save(edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct(), "links")
    roots: list[DataFrame] = []
    while not links.isEmpty():
        up = ws.save(links.groupBy("hi").agg(F.min("lo").alias("up")), "up")
        while True:
            p, q = up.alias("p"), up.select(F.col("hi").alias("at"), F.col("up").alias("next")).alias("q")
            jumped = ws.save(p.join(q, F.col("p.up") == F.col("q.at"), "left").select("hi", F.coalesce("next", "up").alias("up"), F.col("next").isNotNull().alias("moved")), "jumped")
            done = jumped.where("moved").isEmpty()
            ws.drop(up)
            up = jumped
            if done:
                break
        up_ = up.select("hi", "up")
        roots.append(up_)
        to = lambda side: up_.select(F.col("hi").alias(f"{side}_at"), F.col("up").alias(f"{side}_up"))
        redrawn = links.join(to("h"), F.col("hi") == F.col("h_at")).join(to("l"), F.col("lo") == F.col("l_at"), "left").select(F.col("h_up").alias("x"), F.coalesce("l_up", "lo").alias("y"))
        fresh = ws.save(redrawn.select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).where("hi <> lo").distinct(), "links")
        ws.drop(links)
        links = fresh
    if not roots:
        return links.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    found = roots[0].select(F.col("hi").alias("node"), F.col("up").alias("root"))
    for k, level in enumerate(roots[1:]):
        step = level.select(F.col("hi").alias(f"at{k}"), F.col("up").alias(f"up{k}"))
        found = found.join(step, F.col("root") == F.col(f"at{k}"), "left").select("node", F.coalesce(f"up{k}", "root").alias("root"))
        found = found.unionByName(step.select(F.col(f"at{k}").alias("node"), F.col(f"up{k}").alias("root")))
    return ws.save(found, "roots") if len(roots) > 1 else found
