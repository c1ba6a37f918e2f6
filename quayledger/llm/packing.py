"""Best-fit packing of token pieces into sequences of a fixed length by linear grouping."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayledger.llm.shared import Workspace, slices, text_batches, texts_of
from quayledger.llm.tokens import RUN_BYTES, words_of

#: Size classes of the large lengths, and the shares of a sequence from which a length may count as large.
GROUPS, LARGE = 120, (0.4, 0.5)

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def token_pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """A row per piece of every document: its ids (little-endian unsigned 32-bit) and their place in the document."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = words_of(path), end_id.to_bytes(4, "little")
        for ids, texts in slices(batches, RUN_BYTES):
            rows = []
            for doc, data in zip(ids, words.encode_all(texts)):
                data += end
                n = len(data) // 4
                first = (n - 1) % capacity + 1
                edges = [0, *range(first, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    part = data[4 * a : 4 * b]
                    rows.append((doc, k, a, b - a, zlib.crc32(part), part))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return texts_of(docs).mapInArrow(cut, PIECES)


def _configurations(sizes: list[int], capacity: int) -> np.ndarray:
    """All multisets of the sizes that fit into one sequence, as counts by size."""
    out = []
    for n in range(1, capacity // min(sizes) + 1):
        out += [np.bincount(c, minlength=len(sizes)) for c in combinations_with_replacement(range(len(sizes)), n) if sum(sizes[i] for i in c) <= capacity]
    return np.array(out, float)


def _cutting_stock(configs: np.ndarray, demand: np.ndarray) -> dict[int, int]:
    """Whole uses of configurations by the linear programme of least sequences, by column exchange; rounded down."""
    n = len(demand)
    single = [max((r for r in range(len(configs)) if configs[r, i] and configs[r].sum() == configs[r, i]), key=lambda r: configs[r, i]) for i in range(n)]
    basis, inverse = list(single), np.diag(1 / configs[single].max(1))
    moved = demand * (1 + 1e-7 * np.arange(1, n + 1)) + 1e-6 * np.arange(1, n + 1)  # unequal ratios: no exchange is undone
    for _ in range(5 * n):  # whatever it leaves unused goes to best fit, so an early end costs little
        gain = configs @ inverse.sum(0)
        enter = int(gain.argmax())
        if gain[enter] <= 1 + 1e-6:
            break
        x, step = inverse @ moved, inverse @ configs[enter]
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[out] = enter
        inverse[out] /= step[out]
        step[out] = 0
        inverse -= np.outer(step, inverse[out])
    uses: dict[int, int] = defaultdict(int)
    for r, x in zip(basis, inverse @ demand):
        uses[r] += int(max(0.0, x) + 1e-9)
    return {r: x for r, x in uses.items() if x}


def plan(counts: dict[int, int], capacity: int = 2048, groups: int = GROUPS, large: float = LARGE[0]) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Where each length goes, from the number of pieces of each length alone, and the number of sequences.

    Rows (length, first, last, sequence, offset): the pieces of that length with rank first to last - 1 go to the sequences
    from `sequence` on, one each, at `offset`. At most `capacity` lengths go in, and each step ends a length or a run of
    equal sequences, so the rows stay within a small multiple of capacity times the pieces of a sequence."""
    left = {n: c for n, c in counts.items() if c > 0}
    rank: dict[int, int] = defaultdict(int)
    rows: list[tuple[int, int, int, int, int]] = []
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: runs (first sequence, number)
    made = 0

    def put(n: int, many: int, sequence: int, offset: int) -> None:
        rows.append((n, rank[n], rank[n] + many, sequence, offset))
        rank[n] += many
        left[n] -= many

    big = sorted((n for n in left if capacity * large < n < capacity), reverse=True)
    total = sum(left[n] for n in big)
    if total:
        size_of, members, seen = [], [], 0  # equal-cardinality classes; a class's size is its longest member
        for n in big:
            rest = left[n]
            while rest:
                if not members or sum(c for _, c in members[-1]) >= -(-total // groups):
                    size_of.append(n)
                    members.append([])
                take = min(rest, -(-total // groups) - sum(c for _, c in members[-1]))
                members[-1].append([n, take])
                rest -= take
                seen += take
        same: dict[int, list] = {}
        for n, m in zip(size_of, members):
            same.setdefault(n, []).extend(m)
        sizes, members = list(same), list(same.values())
        configs = _configurations(sizes, capacity)
        for r, uses in _cutting_stock(configs, np.array([sum(c for _, c in m) for m in members], float)).items():
            slots = [i for i, c in enumerate(configs[r].astype(int)) for _ in range(c)]
            while uses:
                slots_of = [next(((k, x) for k, x in enumerate(members[i]) if x[1] > 0), None) for i in slots]
                if any(x is None for x in slots_of):
                    break
                need: dict[tuple[int, int], int] = defaultdict(int)
                for i, (k, _) in zip(slots, slots_of):
                    need[i, k] += 1
                run = min(uses, *(members[i][k][1] // c for (i, k), c in need.items()))
                if run == 0:  # a class's next length doesn't fill the slots of one sequence: leave it to best fit
                    i, k = next(key for key, c in need.items() if members[key[0]][key[1]][1] < c)
                    members[i][k][1] = 0
                    continue
                at = 0
                for i, (k, x) in zip(slots, slots_of):
                    put(x[0], run, made, at)
                    at += x[0]
                for (i, k), c in need.items():
                    members[i][k][1] -= run * c
                free[capacity - at].append((made, run))
                made, uses = made + run, uses - run
    for n in sorted((n for n in left if left[n]), reverse=True):
        while left[n]:
            room = next((r for r in range(n, capacity + 1) if free[r]), None)
            if room is None:
                many = -(-left[n] // (capacity // n))
                free[capacity].append((made, many))
                made += many
                continue
            # The fullest sequence takes pieces until none fits, before the next one of its run does.
            sequence, run = free[room].pop()
            per = room // n
            filled = min(run, left[n] // per)
            for k in range(per if filled else 0):
                put(n, filled, sequence, capacity - room + k * n)
            if filled:
                free[room - per * n].append((sequence, filled))
            rest = left[n] if filled < run else 0
            for k in range(rest):
                put(n, 1, sequence + filled, capacity - room + k * n)
            if rest:
                free[room - rest * n].append((sequence + filled, 1))
            if filled + (rest > 0) < run:
                free[room].append((sequence + filled + (rest > 0), run - filled - (rest > 0)))
    return rows, made


def best_plan(counts: dict[int, int], capacity: int = 2048) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """The plan with the fewest sequences over the bounds between large and small; with a half of a sequence as the bound it has no
    more sequences than best fit by decreasing length."""
    return min((plan(counts, capacity, large=x) for x in LARGE), key=lambda p: p[1])


def pack(docs: DataFrame, ws: Workspace, capacity: int = 2048, end_id: int = 0, path: str | None = None, with_ids: bool = True) -> DataFrame:
    """Every token piece with its sequence and the place in it, as columns sequence_id and offset beside those of PIECES; the ids
    themselves are left out without `with_ids`.

    The driver sees a count per length, at most `capacity` of them; pieces of one length are alike, so the plan gives runs
    of ranks a place and the cluster ranks the pieces. Ranks are counted within (length, salt) and shifted by the salts
    before, with as many salts as the square root of the most frequent length's pieces, so one length may hold all rows.
    Null texts are empty documents of one id, null doc_ids and repeated rows are packed like any, an empty table gives
    no rows."""
    with text_batches(ws.spark):
        pieces = token_pieces(docs, capacity, end_id, path)
        pieces = ws.save(pieces if with_ids else pieces.drop("ids"), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    rows, _ = best_plan(counts, capacity)
    salts = max(1, round(max(counts.values(), default=1) ** 0.5))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = before.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("shift"))
    ranked = salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1).join(before, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("shift"))
    places = ws.spark.createDataFrame(rows, "at_length long, first long, last long, sequence long, offset long")
    fits = (F.col("length") == F.col("at_length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    placed = ranked.join(F.broadcast(places), fits)  # a few rows a length: 11,600 for 100 million pieces of 2048 lengths
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset", *(["ids"] if with_ids else []))
