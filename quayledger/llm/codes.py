"""Vector code compression: codebooks per part, with distances looked up by per-dimension value dictionaries."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayledger.llm.shared import Workspace, sent_if_small

#: Numbers of a block: its rows times their length.
BLOCK_CELLS = 1 << 19

BLOCK_ROWS = "length int, ids array<long>, labels array<string>, sizes array<int>, numbers array<long>, codes binary"


@dataclass
class Compressed:
    """rows: vec_id, label, code, error, label_error, codebooks_sha256; books: by length of a vector, its entries (entries x length)."""

    rows: DataFrame
    books: dict[int, np.ndarray]


def edges(length: int, parts: int) -> list[int]:
    """First positions of the parts, and the length; equal parts where the length allows."""
    return [k * length // parts for k in range(parts + 1)]


def integers(vectors: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), held within what keeps a vector's squared distance in a long."""
    most = math.isqrt(((1 << 63) - 1) // max(1, vectors.shape[1])) // 2
    with np.errstate(over="ignore"):
        return np.clip(np.floor(vectors * scale), -most, most).astype(np.int64)


def _blocks(rows: DataFrame, scale: float) -> DataFrame:
    """Vectors in blocks: for every dimension the sorted distinct integers of the block, and each row's place among them."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = np.diff(lists.offsets.to_numpy())
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                step = max(1, min(1 << 16, BLOCK_CELLS // max(1, int(length))))
                for k in range(0, len(at), step):
                    part = batch.take(pa.array(at[k : k + step]))
                    x = integers(part.column(1).flatten().to_numpy().reshape(len(part.column(0)), int(length)), scale)
                    sizes, numbers, codes = [], [], []
                    for d in range(int(length)):
                        distinct, place = np.unique(x[:, d], return_inverse=True)
                        sizes.append(len(distinct))
                        numbers.append(distinct)
                        codes.append(place.astype("<u2"))
                    whole = lambda c: pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([length], pa.int32()),
                            whole(part.column(0)),
                            whole(part.column(2)),
                            whole(pa.array(sizes, pa.int32())),
                            whole(pa.array(np.concatenate([np.zeros(0, np.int64), *numbers]))),
                            pa.array([b"".join(c.tobytes() for c in codes)], pa.binary()),
                        ],
                        names=["length", "ids", "labels", "sizes", "numbers", "codes"],
                    )

    return rows.mapInArrow(pack, BLOCK_ROWS)


class Block:
    """A block of vectors: per dimension its distinct integers, and codes into them."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.length = batch.column("length")[k].as_py()
        self.ids, self.labels = batch.column("ids")[k].values, batch.column("labels")[k].values
        ends = np.cumsum(batch.column("sizes")[k].values.to_numpy(), dtype=np.int64)
        self.distinct = np.split(batch.column("numbers")[k].values.to_numpy(), ends[:-1]) if self.length else []
        self.codes = np.frombuffer(batch.column("codes")[k].as_buffer(), "<u2").reshape(self.length, len(self.ids))

    def nearest(self, book: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Of every row, the entry nearest to its dimensions first to last - 1 (ties: the lower index) and the squared distance.

        The squared differences of each distinct integer to all entries are tabulated once; rows gather and add them."""
        dims = range(first, last)
        far = max((int(abs(self.distinct[d][[0, -1], None] - book[:, d]).max()) for d in dims), default=0)
        kind = np.int32 if far * far * len(dims) < 1 << 31 else np.int64
        total = np.zeros((len(self.ids), len(book)), kind)
        for d in dims:
            away = self.distinct[d][:, None] - book[:, d]
            total += (away * away).astype(kind)[self.codes[d]]
        best = total.argmin(1)
        return best, total[np.arange(len(best)), best].astype(np.int64)


def _blocks_of(batches: Iterable[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Block(batch, k)


def _sums(blocks: DataFrame, books: dict[int, np.ndarray], parts: int) -> DataFrame:
    """length, entry, dim, total and n: sums of the vectors' integers by the entry nearest to their part, added up in each task first."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for block in _blocks_of(batches):
            book = books[block.length]
            total, n = held.setdefault(block.length, (np.zeros(book.shape, np.int64), np.zeros(book.shape, np.int64)))
            bounds = edges(block.length, parts)
            for a, b in zip(bounds, bounds[1:]):
                best, _ = block.nearest(book, a, b)
                n[:, a:b] += np.bincount(best, minlength=len(book))[:, None]
                for d in range(a, b):  # how often each distinct integer goes to each entry
                    by = np.bincount(block.codes[d].astype(np.int64) * len(book) + best, minlength=len(block.distinct[d]) * len(book))
                    total[:, d] += block.distinct[d] @ by.reshape(-1, len(book))
        for length, (total, n) in held.items():
            entry, dim = np.indices(total.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(total.size, length), pa.int32()), *(pa.array(c.ravel().astype(np.int64)) for c in (entry, dim, total, n))],
                names=["length", "entry", "dim", "total", "n"],
            )

    found = blocks.mapInArrow(add, "length int, entry long, dim long, total long, n long").where("n > 0")
    return found.groupBy("length", "entry", "dim").agg(F.sum(F.col("total").cast("decimal(20,0)")).alias("total"), F.sum("n").alias("n"))


def digest(book: np.ndarray, parts: int) -> str:
    """sha256 of all entries' integers by part, entry and place in the part."""
    bounds = edges(book.shape[1], parts)
    return hashlib.sha256(",".join(str(x) for a, b in zip(bounds, bounds[1:]) for x in book[:, a:b].ravel().tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, ws: Workspace, parts: int = 8, entries: int = 16, rounds: int = 6, scale: float = 4096) -> Compressed:
    """Codes of all vectors (vec_id, embedding, label) by codebooks of whole numbers.

    A component x becomes floor(scale * x). Vectors are written once as blocks that hold, for every dimension, the block's distinct
    integers and 16-bit codes into them, so memory and dictionaries follow the block, not the table. A round tabulates the squared
    difference of each distinct integer to all entries; distances are gathers and adds over the codes. Tasks send sums by
    entry and dimension only; the driver holds the codebooks, `entries` x length numbers.

    Rows whose vector is null or holds null or non-finite components are dropped. The first codebooks are the vectors of the smallest
    (vec_id, vector), null ids last; repeated rows count as often as they stand, and fewer rows than `entries` make fewer
    entries. Vectors of another length have codebooks of their own; a length that the parts don't divide is cut as evenly as it
    goes, and parts without a component are at distance 0 of entry 0. Integers beyond what keeps a squared distance in a long
    (2**28 at 64 components) are held at that bound. A label's sum beyond a long is null; null labels are summed together. An
    empty table gives no rows."""
    label = F.col("label").cast("string") if "label" in vectors.columns else F.lit(None).cast("string")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), label.alias("label"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    rows = rows.where(F.coalesce(finite, F.lit(False)))
    blocks = ws.save(_blocks(rows, scale), "blocks")
    books: dict[int, np.ndarray] = {}
    for r in blocks.select("length").distinct().collect():
        same = rows.where(F.size("vector") == r["length"])
        least = same.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).select("vector").collect()
        books[r["length"]] = integers(np.array([x["vector"] for x in least], float).reshape(len(least), r["length"]), scale)
    for _ in range(rounds):
        moved = {length: book.copy() for length, book in books.items()}
        for r in _sums(blocks, books, parts).collect():  # at most entries x length rows of a length
            moved[r["length"]][r["entry"], r["dim"]] = int(r["total"]) // r["n"]
        books = moved
    digests = {length: digest(book, parts) for length, book in books.items()}

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches):
            bounds = edges(block.length, parts)
            found = [block.nearest(books[block.length], a, b) for a, b in zip(bounds, bounds[1:])]
            digits = np.stack([best for best, _ in found], 1).astype(np.uint8).tobytes().hex()
            codes = [digits[k : k + 2 * parts] for k in range(0, len(digits), 2 * parts)]
            sums = np.sum([away for _, away in found], 0)
            n = len(block.ids)
            yield pa.RecordBatch.from_arrays(
                [block.ids, block.labels, pa.array(codes, pa.string()), pa.array(sums), pa.array([digests[block.length]] * n, pa.string())],
                names=["vec_id", "label", "code", "error", "codebooks_sha256"],
            )

    coded = ws.save(blocks.mapInArrow(code, "vec_id long, label string, code string, error long, codebooks_sha256 string"), "coded")
    totals = ws.save(coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error")), "totals")
    totals = sent_if_small(totals, totals.count())
    out = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return Compressed(out.select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256"), books)


def compress_sql(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same over `embeddings` in DuckDB's SQL, for vectors of one length that the parts divide."""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""cells AS MATERIALIZED (SELECT vec_id, i // (len(v) // {parts}) AS part, i % (len(v) // {parts}) AS pos, v[i + 1] AS x
  FROM (SELECT vec_id, v, unnest(range(len(v))) AS i FROM kept))""",
        f"first_rows AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY row_number() OVER (ORDER BY vec_id) <= {entries})",
        "book0 AS MATERIALIZED (SELECT part, e, pos, x AS b FROM cells JOIN first_rows USING (vec_id))",
    ]
    for k in range(rounds + 1):
        steps.append(
            f"""near{k} AS MATERIALIZED (SELECT vec_id, part, e, away FROM (SELECT vec_id, part, e, sum((x - b) * (x - b)) AS away
  FROM cells JOIN book{k} USING (part, pos) GROUP BY vec_id, part, e) QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY away, e) = 1)"""
        )
        if k < rounds:
            steps.append(
                f"""book{k + 1} AS MATERIALIZED (SELECT part, e, pos, coalesce(m, b) AS b FROM book{k} LEFT JOIN
  (SELECT part, e, pos, floor(sum(x) / count(*))::BIGINT AS m FROM cells JOIN near{k} USING (vec_id, part) GROUP BY ALL) USING (part, e, pos))"""
            )
    return f"""WITH {", ".join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY part) AS code, sum(away)::BIGINT AS error FROM near{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(b::VARCHAR, ',' ORDER BY part, e, pos)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""
