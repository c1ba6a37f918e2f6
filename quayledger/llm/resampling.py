"""Documents drawn towards a target's word runs: scored weights, then a distributed radix sort for the ranks."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType
from pyspark.sql.window import Window

from quayledger.llm.shared import Workspace, grouped, ranges, ship, slices, texts_of
from quayledger.llm.words import MARKS

#: Words of the longest run, and the bytes of a text that are read at once.
RUN, PIECE = 3, 1 << 20
#: Words up to this size are hashed together, and steps of so many bytes have a table of their own.
SHORT, STEPS = 256, 64
#: Bits of a digit of the sort, and the least and most rows of its blocks.
DIGIT, LEAST_BLOCK, MOST_BLOCK = 10, 1024, 1 << 18
#: The polynomial of CRC-32, a fixed value.
CRC32 = 0xEDB88320


@lru_cache(maxsize=1)
def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table of one byte; of 0 to STEPS zero bytes after a checksum; and of 2**k zero bytes: (.., 4, 256) by the checksum's bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(CRC32), one >> 1)
    byte = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    steps = [byte]
    for _ in range(STEPS):
        steps.append(one[steps[-1] & 255] ^ (steps[-1] >> 8))
    doubled = [steps[1]]
    for _ in range(40):
        doubled.append(_through(doubled[-1], doubled[-1]))
    return one, np.array(steps), np.array(doubled)


def _through(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def advanced(crc: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Checksums moved on by `sizes` zero bytes: crc32(a + b) = advanced(crc32(a), len(b)) ^ crc32(b)."""
    _, steps, doubled = _crc_tables()
    near = np.minimum(sizes, STEPS)
    out = steps[near, 0, crc & 255] ^ steps[near, 1, crc >> 8 & 255] ^ steps[near, 2, crc >> 16 & 255] ^ steps[near, 3, crc >> 24]
    far = np.flatnonzero(sizes > STEPS)
    if len(far):
        rest, moved = sizes[far] - STEPS, out[far]
        for k in range(int(rest.max()).bit_length()):
            on = rest >> k & 1 > 0
            moved[on] = _through(doubled[k], moved[on])
        out[far] = moved
    return out


def word_crcs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Checksums and sizes of all words of all texts (A-Z lowered), and how many each text has."""
    one, _, _ = _crc_tables()
    joined = b"\n".join([*texts, b""]).lower()
    data = np.frombuffer(joined, np.uint8)
    edge = np.flatnonzero(np.diff(~MARKS[data], prepend=False, append=False))
    first, sizes = edge[0::2], edge[1::2] - edge[0::2]
    short = np.minimum(sizes, SHORT + 1).astype(np.uint16)
    order = np.argsort(SHORT + 1 - short, kind="stable")  # longest first
    at, crc = first[order], np.full(len(order), 0xFFFFFFFF, np.uint32)
    longer = np.cumsum(np.bincount(short, minlength=SHORT + 2)[::-1])[::-1]  # words of so many bytes or more
    for k in range(min(SHORT, int(sizes.max(initial=0)))):
        n = longer[k + 1]
        crc[:n] = one[(crc[:n] ^ data[at[:n] + k]) & 255] ^ (crc[:n] >> 8)
    out = np.empty(len(order), np.uint32)
    out[order] = ~crc
    for k in np.flatnonzero(sizes > SHORT):
        out[k] = zlib.crc32(joined[first[k] : first[k] + sizes[k]])
    return out, sizes, np.diff(np.searchsorted(first, np.cumsum([0, *(len(t) + 1 for t in texts)])))


def run_crcs(crc: np.ndarray, sizes: np.ndarray, text: np.ndarray, skip: int = 0) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For 1 to RUN words: text numbers and checksums of all runs of so many words of one text, joined by a space, that end at
    word `skip` or later."""
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    after = advanced(space, sizes) ^ crc  # of the word with a space before it
    run = crc
    yield 1, text[skip:], crc[skip:]
    for n in range(1, RUN):
        run = advanced(run[:-1], sizes[n:] + 1) ^ after[n:]
        whole = text[n:] == text[: len(text) - n]
        whole[: max(0, skip - n)] = False
        yield n + 1, text[n:][whole], run[whole]


_BETWEEN = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in runs of about PIECE bytes that end between two words."""
    start = 0
    while len(text) - start > PIECE and (cut := _BETWEEN.search(text, start + PIECE)):
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def bucketed(texts: list[bytes], buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words of a run, text numbers, buckets) of all runs of all texts; a long text is read by pieces that share their border's words."""
    short = [k for k, t in enumerate(texts) if len(t) <= PIECE]
    if short:
        crc, sizes, n = word_crcs([texts[k] for k in short])
        for words, owner, found in run_crcs(crc, sizes, np.repeat(np.array(short), n)):
            yield words, owner, found % buckets
    for k, t in enumerate(texts):
        held = (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        for piece in pieces(t) if len(t) > PIECE else ():
            crc, sizes, _ = word_crcs([piece])
            skip = len(held[0])
            crc, sizes = np.concatenate([held[0], crc]), np.concatenate([held[1], sizes])
            for words, owner, found in run_crcs(crc, sizes, np.full(len(crc), k), skip):
                yield words, owner, found % buckets
            held = crc[1 - RUN :], sizes[1 - RUN :]


def bucket_counts(docs: DataFrame, buckets: int = 10_000) -> np.ndarray:
    """How many runs of all texts fall into each bucket; a task sends a number per bucket."""
    ship(docs.sparkSession)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in slices(batches):
            for _, _, found in bucketed(texts, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts_of_any(docs).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most `buckets` rows
        out[r["bucket"]] = r["n"]
    return out


def texts_of_any(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of a table with any or no doc_id."""
    return texts_of(docs if "doc_id" in docs.columns else docs.select(F.lit(None).alias("doc_id"), "text"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of how much likelier each bucket is in the target, with one added to every bucket."""
    buckets, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def chance(doc_id: int, seed: int) -> int:
    """The document's part of a score that is left to chance: a Gumbel number from the hash of its id, in thousandths, rounded down."""
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row of docs, and its place: the task's number and the row's in it."""
    ship(docs.sparkSession)
    names = ["doc_id", "n_words", "n_features", "weight", "score", "part", "row"]

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row = TaskContext.get().partitionId(), 0
        for ids, texts in slices(batches):
            words, features, weight = (np.zeros(len(ids), np.int64) for _ in range(3))
            for run, owner, found in bucketed(texts, len(gain)):
                here = np.bincount(owner, minlength=len(ids))
                features += here
                words += here if run == 1 else 0
                weight += np.rint(np.bincount(owner, gain[found], len(ids))).astype(np.int64)  # whole numbers below 2**53
            scores = [None if d is None else int(w) + chance(d, seed) for d, w in zip(ids, weight.tolist())]
            columns = [pa.array(ids, pa.int64()), pa.array(words), pa.array(features), pa.array(weight), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(ids), part, np.int64)), pa.array(np.arange(row, row + len(ids)))], names=names)
            row += len(ids)

    return texts_of(docs).mapInArrow(score, ", ".join(f"{c} long" for c in names))


def radix_ranks(rows: DataFrame, keys: Sequence[tuple[str, bool]], order: Sequence[str], ws: Workspace, digit_bits: int = DIGIT, block_rows: int | None = None) -> DataFrame:
    """rows with `rank`, from 1, by the long columns `keys` (name, descending), the first counting most: a distributed radix sort.

    `order`: (part, row) columns, the input's order; equal keys keep it. Keys are shifted to begin at zero and cut into digits, and a
    stable counting sort runs for each digit, the lowest first: rows are counted by (block, digit); a running sum over digits
    and, within one, over blocks gives the first place of each pair; each block then goes to one task, which gives its rows
    their places in turn. Places make the next pass's blocks, all of one size, so no key makes a task larger than another. Every
    pass writes its rows, so a lost executor costs that pass's tasks. No key may be null. Only a number per digit comes to
    the driver."""
    part, row = order
    ends = rows.agg(F.count("*").alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for c, _ in keys for f in (F.min, F.max)]).first()
    size = block_rows or min(MOST_BLOCK, max(LEAST_BLOCK, ends["n"] // 64))
    held = [f.name for f in rows.schema.fields if f.name not in order]
    numbered = rows.withColumn("_at", F.row_number().over(Window.partitionBy(part, F.floor(F.col(row) / size)).orderBy(row)) - 1)
    # Blocks of the input's order: part and run of `size` rows, as one number that sorts like the pair.
    now = numbered.select(*held, (F.shiftleft(F.col(part), 32) + F.floor(F.col(row) / size)).alias("_block"), F.col("_at").cast("long").alias("_at"))
    passes = []
    for name, descending in reversed(keys):
        low, high = ends[f"min_{name}"], ends[f"max_{name}"]
        if low is None or low == high:
            continue
        if high - low < 1 << 63:
            key, bits = (F.lit(high) - F.col(name) if descending else F.col(name) - F.lit(low)), (high - low).bit_length()
        else:  # as unsigned numbers of 64 bits
            key, bits = F.col(name).bitwiseXOR(F.lit(-(1 << 63)).cast("long")), 64
            key = F.bitwise_not(key) if descending else key
        passes += [F.shiftrightunsigned(key, shift).bitwiseAND(F.lit((1 << digit_bits) - 1)) for shift in range(0, bits, digit_bits)]
    spark = ws.spark
    now = ws.save(now, "unsorted")

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["_block"]):
            bounds = ranges(table, ["_block"])
            for a, b in zip(bounds, bounds[1:]):
                block = table.slice(a, b - a)
                at, digit, first = (block[c].to_numpy() for c in ("_at", "_digit", "_first"))
                firsts = np.zeros(1 << digit_bits, np.int64)
                head = at < 0
                firsts[digit[head]] = first[head]
                mine = np.flatnonzero(~head)
                turn = np.empty(len(mine), np.int64)  # the rows of the block in their order: each has a place of its own
                turn[at[mine]] = mine
                n = np.bincount(digit[turn], minlength=1 << digit_bits)
                by = np.argsort(digit[turn].astype(np.uint16), kind="stable")
                places = np.empty(len(turn), np.int64)
                places[by] = firsts[digit[turn][by]] + np.arange(len(turn)) - np.repeat(np.cumsum(n) - n, n)
                out = block.select(held).take(pa.array(turn)).combine_chunks()
                yield from pa.table([*out.columns, pa.array(places // size), pa.array(places % size)], names=[*held, "_block", "_at"]).to_batches()

    schema = StructType([*rows.select(*held).schema.fields, StructField("_block", LongType()), StructField("_at", LongType())])
    for digit in passes:
        seen = ws.save(now.groupBy("_block", digit.alias("_digit")).agg(F.count("*").alias("n")), "seen")
        totals = sorted((r["_digit"], r["n"]) for r in seen.groupBy("_digit").agg(F.sum("n").alias("n")).collect())  # at most 2**digit_bits rows
        before, base = [], 0
        for d, n in totals:
            before.append((d, base))
            base += n
        within = F.sum("n").over(Window.partitionBy("_digit").orderBy("_block")) - F.col("n")
        firsts = seen.join(F.broadcast(spark.createDataFrame(before, "_of long, _base long")), F.col("_digit") == F.col("_of"))
        firsts = firsts.select("_block", F.lit(-1).cast("long").alias("_at"), "_digit", (F.col("_base") + within).alias("_first"))
        both = now.select(*held, "_block", "_at", digit.alias("_digit"), F.lit(0).cast("long").alias("_first")).unionByName(firsts, allowMissingColumns=True)
        moved = both.repartition("_block").sortWithinPartitions("_block").mapInArrow(place, schema)
        after = ws.save(moved, "sorted")
        ws.drop(now, seen)
        now = after
    if not passes:  # all keys are equal: the input's order counts
        counts = ws.save(now.groupBy("_block").agg(F.count("*").alias("n")), "seen")
        firsts = counts.select(F.col("_block").alias("_of"), (F.sum("n").over(Window.orderBy("_block")) - F.col("n")).alias("_base"))
        return now.join(firsts, F.col("_block") == F.col("_of")).select(*held, (F.col("_base") + F.col("_at") + 1).alias("rank"))
    return now.select(*held, (F.col("_block") * size + F.col("_at") + 1).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, ws: Workspace, per_hundred: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of docs (doc_id, text), drawn towards the texts of `target`.

    The runs of 1 to 3 words of all texts are counted by bucket, in docs and in the target; a document's weight is the sum of its
    runs' gains, its score the weight and a chance fixed by the seed and its id. Of the N documents with `least_words` words
    or more the floor(per_hundred * N / 100) best scores are drawn, ties to the smaller doc_id, and ranked from 1; the others'
    rank is null. Null and empty texts have no runs and weight 0. A null doc_id has no chance: its score is null and it is neither
    drawn nor among the N. Rows of one id and score keep the input's order. No rows give no rows; an empty target leaves
    every gain to the smoothing."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = ws.save(scored(docs, gain, seed), "scored")
    fit = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    drawn = rows.where(fit).count() * per_hundred // 100
    ranked = radix_ranks(rows.where(fit), [("score", True), ("doc_id", False)], ("part", "row"), ws)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    rest = rows.where(~F.coalesce(fit, F.lit(False))).drop("part", "row").withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest)


def resample_sql(per_hundred: int = 5, least_words: int = 20, buckets: int = 10_000, seed: int = 42) -> str:
    """The same over `documents` and `benchmark` in DuckDB's SQL. It has no CRC-32: words are summed byte by byte through the table of
    one byte, longer runs by moving a checksum on by the next word's bytes."""
    step = "xor(c >> 8, t[(c & 255) + 1])"
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    nibble = lambda at: f"(strpos('0123456789ABCDEF', substr(h, {at}, 1)) - 1)"
    moved = lambda crc, size: f"list_reduce(range({size}), lambda c, k: {step}, {crc})"
    return f"""WITH crc AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1
  THEN xor(c >> 1, {CRC32}) ELSE c >> 1 END, i) AS v FROM range(256) s(i))),
texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text, side
  FROM (SELECT doc_id, text, 's' AS side FROM documents UNION ALL SELECT NULL, text, 't' FROM benchmark)),
words AS MATERIALIZED (SELECT r, side, unnest(w) AS w, unnest(range(len(w))) AS p FROM (SELECT r, side, regexp_extract_all(text, '{word}') AS w FROM texts)),
known AS MATERIALIZED (SELECT w, size, xor(list_reduce(bytes, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS crc,
  xor(list_reduce(list_prepend(32, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS after
  FROM (SELECT w, len(h) // 2 AS size, list_transform(range(len(h) // 2), lambda k: ({nibble("2 * k + 1")} * 16 + {nibble("2 * k + 2")})::BIGINT) AS bytes
    FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM words)), crc),
next AS MATERIALIZED (SELECT r, side, p, crc AS c1, lead(size) OVER o AS z2, lead(after) OVER o AS a2, lead(size, 2) OVER o AS z3, lead(after, 2) OVER o AS a3
  FROM words JOIN known USING (w) WINDOW o AS (PARTITION BY r ORDER BY p)),
pairs AS MATERIALIZED (SELECT next.*, xor({moved("c1", "z2 + 1")}, a2) AS c2 FROM next, crc WHERE z2 IS NOT NULL),
runs AS MATERIALIZED (SELECT r, side, c1 % {buckets} AS b FROM next UNION ALL SELECT r, side, c2 % {buckets} FROM pairs
  UNION ALL SELECT r, side, xor({moved("c2", "z3 + 1")}, a3) % {buckets} FROM pairs, crc WHERE z3 IS NOT NULL),
gains AS MATERIALIZED (SELECT b, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT count(*) FROM runs WHERE side = 's') + {buckets})::DOUBLE
  / ((s + 1)::DOUBLE * ((SELECT count(*) FROM runs WHERE side = 't') + {buckets})::DOUBLE)))::BIGINT AS gain
  FROM (SELECT b, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM runs GROUP BY b)),
sums AS (SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM runs JOIN gains USING (b) WHERE side = 's' GROUP BY r),
sizes AS (SELECT r, count(*) AS n_words FROM words GROUP BY r),
hashed AS (SELECT r, doc_id, list_reduce(list_transform(range(8), lambda k: (strpos('0123456789abcdef', substr(s, k + 1, 1)) - 1)::BIGINT), lambda a, b: a * 16 + b) AS h
  FROM (SELECT r, doc_id, sha256('{seed}:' || doc_id) AS s FROM texts WHERE side = 's')),
scores AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score,
  doc_id IS NOT NULL AND coalesce(n_words, 0) >= {least_words} AS fit FROM hashed LEFT JOIN sums USING (r) LEFT JOIN sizes USING (r)),
ranks AS (SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id) AS k, count(*) FILTER (fit) OVER () AS n FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND k <= {per_hundred} * n // 100 THEN k END AS rank FROM ranks"""
