"""Near-duplicate vectors: sign hashing over random hyperplanes in several tables, exact cosines, components."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayledger.llm.shared import Workspace, components, forest, grouped, ranges, sent_if_small
from quayledger.llm.simhash import dealt

#: Rows of one bucket compared in one block.
BLOCK = 1024


def shape(rows: int, cosine: float, recall: float) -> tuple[int, int]:
    """Bits of a key and number of tables. The bits follow the logarithm of the rows, so that a bucket of unrelated vectors stays
    small; the tables follow from the bits, so that a pair at the least cosine is found with probability `recall` at any size."""
    bits = max(4, round(math.log2(max(rows, 2))) - 4)
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - recall) / math.log(1 - same))


def planes_for(length: int, bits: int, tables: int, seed: int) -> np.ndarray:
    """Random hyperplanes of all tables; every task draws the same."""
    return np.random.default_rng([seed, length]).standard_normal((length, bits * tables))


def signs(vector: np.ndarray, planes: np.ndarray, bits: int) -> np.ndarray:
    """A vector's key in each table. One vector at a time, so that the same sums are formed wherever it is hashed."""
    return (vector @ planes > 0).reshape(-1, bits) @ (1 << np.arange(bits))


def near_vectors(vectors: DataFrame, ws: Workspace, cosine: float = 0.95, recall: float = 0.998, seed: int = 11, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector (vec_id, embedding).

    Equal vectors are one node with a size and a number of its own, so a vector that a third of the rows repeat is one row in the
    search. Nodes of one bucket are compared in blocks; a pair is counted in the first table that joins it, so links are counted
    without listing them, and a block gives tree edges only. A node travels once per table, as vector and number; its keys in the
    other tables are drawn anew where it is linked. Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing; so do vectors of different lengths, and a null vec_id. Rows are told apart by their vectors: rows of one
    vec_id and vector are links of each other, rows of one vec_id and different vectors have links of their own, and are not tied
    by the id; each row's component is the smallest vec_id its own vector reaches."""
    rows = ws.save(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")), "vectors")
    plain = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf))
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.forall("vector", plain) & F.exists("vector", lambda x: x != 0), F.lit(False))
    # Minus zero and zero are equal numbers but other bytes: adding zero makes them one.
    good = rows.where(usable).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    nodes = good.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    nodes = ws.save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # numbers that the written table fixes
    bits, tables = shape(nodes.count(), cosine, recall)

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                batch = whole.slice(at, 2048)
                keys = np.zeros((batch.num_rows, tables), np.int64)
                for k, x in enumerate(batch.column(0).to_numpy(zero_copy_only=False)):
                    if len(x) not in planes:
                        planes[len(x)] = planes_for(len(x), bits, tables, seed)
                    keys[k] = signs(x, planes[len(x)], bits)
                out = batch.take(pa.array(np.repeat(np.arange(batch.num_rows), tables)))
                keys += np.arange(tables) << 48
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(keys.ravel())], names=["vector", "node", "size", "key"])

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ["key", "i", "j"]
        planes: dict[int, np.ndarray] = {}
        for table in grouped(batches, keys):
            bounds = ranges(table, keys)
            columns = {c: table[c].to_numpy() for c in ("key", "i", "j", "part", "node", "size")}
            vectors = table["vector"].combine_chunks()
            out: list[tuple[np.ndarray, ...]] = []
            for a, b in zip(bounds, bounds[1:]):
                lengths = np.diff(vectors.offsets.to_numpy()[a : b + 1])
                for length in np.unique(lengths).tolist():
                    at = a + np.flatnonzero(lengths == length)
                    if len(at) < 2:
                        continue
                    raw = np.stack([vectors[int(k)].values.to_numpy() for k in at])
                    x = raw / np.abs(raw).max(1, keepdims=True)  # no overflow in the squares
                    x /= np.sqrt((x * x).sum(1, keepdims=True))
                    linked = x @ x.T >= cosine
                    np.fill_diagonal(linked, False)
                    first = int(columns["key"][a]) >> 48
                    new = linked.copy()
                    some = np.flatnonzero(linked.any(1))
                    if first and len(some):
                        if length not in planes:
                            planes[length] = planes_for(length, bits, tables, seed)
                        known = np.stack([signs(raw[k], planes[length], bits) for k in some])
                        here = linked[np.ix_(some, some)]
                        for t in range(first):
                            here &= known[:, t][:, None] != known[:, t][None, :]
                        new[np.ix_(some, some)] = here
                    if columns["i"][a] != columns["j"][a]:  # pairs within a part are counted in its own block
                        part = columns["part"][at]
                        new &= part[:, None] != part[None, :]
                    found, size = columns["node"][at], columns["size"][at]
                    links = new @ size
                    hit = np.flatnonzero(links)
                    out.append((found[hit], np.full(len(hit), -1), links[hit]))
                    edges = np.array(forest(len(at), lambda i, others: linked[i, others]), np.int64).reshape(-1, 2)  # noqa: B023
                    out.append((found[edges[:, 0]], found[edges[:, 1]], np.zeros(len(edges), np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=["a", "b", "n"])

    keyed = nodes.select("vector", "node", "size").mapInArrow(hashed, "vector array<double>, node long, size long, key long")
    found = ws.save(dealt(keyed, ws, block, "node").select("key", "i", "j", "part", "vector", "node", "size").mapInArrow(compare, "a long, b long, n long"), "found")
    roots = components(found.where("n = 0").select("a", "b"), ws)
    outer = found.where("n > 0").groupBy("a").agg(F.sum("n").alias("outer"))
    linked = nodes.join(outer, F.col("node") == F.col("a"), "left").join(roots.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left")
    linked = ws.save(linked.select("vector", "least", "size", F.coalesce("outer", F.lit(0)).alias("outer"), F.coalesce("root", "node").alias("root")), "linked")
    names = ws.save(linked.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component")), "names")
    names = sent_if_small(names, names.count())
    groups = linked.join(names, F.col("root") == F.col("of"))
    groups = ws.save(groups.select(F.col("vector").alias("of"), (F.col("size") - 1 + F.col("outer")).alias("links"), "component"), "groups")
    shown = rows.withColumn("lookup", F.when(usable, F.transform("vector", lambda x: x + F.lit(0.0))))
    out = shown.join(groups, F.col("lookup") == F.col("of"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
