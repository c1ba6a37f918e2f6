"""Near-duplicates by SimHash fingerprints, with the pigeonring filter before the Hamming test."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quayledger.llm.shared import Workspace, components, forest, grouped, ranges, sent_if_small, slices, texts_of

#: Differing bits of a link, and the segments of a fingerprint that stand in a ring.
MOST_BITS, SEGMENTS = 3, 4
#: Fingerprints of one key compared in one block; a key with more is dealt to pairs of blocks.
BLOCK = 2048
SEED = 42


def shingles(text: bytes, words: int) -> list[bytes]:
    """Space-joined runs of words of an ASCII-lower-cased text, repeats included; of fewer words, the one run of all."""
    found = text.lower().split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.concatenate([[0], np.cumsum(sizes[:-1] + 1)])
    ends = starts + sizes
    return [joined[a:b] for a, b in zip(starts[: len(found) - words + 1].tolist(), ends[words - 1 :].tolist())]


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id and 64-bit fingerprint of every whole text: a bit is set if more than half of the shingle hashes set it."""

    def of(hashes: list[int]) -> int:
        set_, n = np.zeros(64, np.int64), len(hashes)
        for a in range(0, n, 1 << 16):
            part = np.array(hashes[a : a + (1 << 16)], "<u8").view(np.uint8).reshape(-1, 8)
            set_ += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
        return int(np.packbits(2 * set_ > n, bitorder="little").view("<u8")[0])

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for ids, texts in slices(batches):
            marks = np.array([of([digest(s, SEED) for s in shingles(t, words)]) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(marks.view(np.int64))], names=["doc_id", "mark"])

    return texts_of(docs).mapInArrow(make, "doc_id long, mark long")


def ring_keys(mark: F.Column) -> F.Column:
    """20 keys of 32 bits that two fingerprints within 3 bits share at least one of.

    In the ring of four 16-bit segments, some segment starts a chain whose differences stay within 3/4 of a bit for each of
    its segments: none in the first, one in the first two, two in the first three. So the first segment is equal, and with
    the next two cut in halves, either both halves of the second are equal, or one of them and one of the third's."""
    half = [F.shiftrightunsigned(mark, 8 * k).bitwiseAND(F.lit(255)) for k in range(8)]
    keys, tag = [], 0
    for start in range(0, 8, 2):
        a, b, c, d, e, f = (half[(start + k) % 8] for k in range(6))
        for x, y in ((c, d), (c, e), (c, f), (d, e), (d, f)):
            bits = F.shiftleft(a, 24).bitwiseOR(F.shiftleft(b, 16)).bitwiseOR(F.shiftleft(x, 8)).bitwiseOR(y)
            keys.append(F.lit(tag << 32).bitwiseOR(bits))
            tag += 1
    return F.array(*keys)


def ring_links(x: np.ndarray) -> np.ndarray:
    """Which differences (as XOR of fingerprints) are links: the chain condition first, the whole count on what is left."""
    boxes = np.stack([np.bitwise_count(x >> np.uint64(16 * k) & np.uint64(0xFFFF)) for k in range(SEGMENTS)]).astype(np.int8)
    left = np.zeros(x.shape, bool)
    for start in range(SEGMENTS):
        chain, total = np.ones(x.shape, bool), np.zeros(x.shape, np.int8)
        for k in range(SEGMENTS):
            total = total + boxes[(start + k) % SEGMENTS]
            chain &= total <= (k + 1) * MOST_BITS // SEGMENTS
        left |= chain
    left[left] = np.bitwise_count(x[left]) <= MOST_BITS
    return left


def block_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tree edges within each block (key, i, j) of sorted rows: pairs of positions in small blocks, a search in large ones."""
    keys = ["key", "i", "j"]
    for table in grouped(batches, keys):
        bounds, marks, nodes = ranges(table, keys), table["mark"].to_numpy().view(np.uint64), table["node"].to_numpy()
        sizes = np.diff(bounds)
        group = np.repeat(np.arange(len(sizes)), sizes)
        small = sizes[group] <= 8
        a, b = [], []
        for gap in range(1, min(8, len(marks))):
            at = np.flatnonzero((group[gap:] == group[:-gap]) & small[gap:])
            if not at.size:
                break
            at = at[ring_links(marks[at] ^ marks[at + gap])]
            a.append(nodes[at])
            b.append(nodes[at + gap])
        for g in np.flatnonzero(sizes > 8):
            own, names = marks[bounds[g] : bounds[g + 1]], nodes[bounds[g] : bounds[g + 1]]
            edges = np.array(forest(len(own), lambda i, others: ring_links(own[others] ^ own[i])), np.int64).reshape(-1, 2)
            a.append(names[edges[:, 0]])
            b.append(names[edges[:, 1]])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (a, b)], names=["a", "b"])


def dealt(keyed: DataFrame, ws: Workspace, block: int, salt: str) -> DataFrame:
    """Rows with a `key` that others have too, dealt to blocks (key, i, j): all rows of a key, or where it has more than
    `block`, those of two parts of it. Each pair of a key's rows meets in one block at least."""
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(F.col("key").alias("of"), F.ceil(F.col("n") / block).cast("int").alias("parts"))
    shared = ws.save(shared, "shared")  # read again, both sides of the join are shuffled, so a hot key can be split
    rows = keyed.join(shared, F.col("key") == F.col("of")).drop("of")
    rows = rows.withColumn("part", F.pmod(F.xxhash64(F.lit(7), salt), F.col("parts")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = rows.withColumn("i", F.least("part", "other")).withColumn("j", F.greatest("part", "other")).drop("other", "parts")
    return rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def near_duplicates(docs: DataFrame, ws: Workspace, words: int = 3, block: int = BLOCK) -> DataFrame:
    """doc_id, fingerprint and component_id of every document.

    Equal fingerprints are one node, named by their smallest doc_id, so a group of copies is one row in the search whatever
    its size. Nodes that share a ring key are compared in blocks that give tree edges only. Rows of one doc_id are one
    document: they share a component. Null and empty texts have fingerprint zero, linked like any other. A null doc_id has
    no smallest name: its row keeps its fingerprint, gets a null component and links nothing. No rows give no rows."""
    marks = ws.save(fingerprints(docs, words), "marks")
    nodes = ws.save(marks.where("doc_id is not null").groupBy("mark").agg(F.min("doc_id").alias("node")), "nodes")
    keyed = nodes.select("mark", "node", F.explode(ring_keys(F.col("mark"))).alias("key"))
    links = dealt(keyed, ws, block, "mark").select("key", "i", "j", "mark", "node").mapInArrow(block_links, "a long, b long")
    named = marks.where("doc_id is not null").join(nodes, "mark")
    repeated = named.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a <> b")
    # A doc_id with several fingerprints ties all of them to its smallest node.
    ties = repeated.select("doc_id", "a").join(named.select("doc_id", "node"), "doc_id").where("a <> node").select("a", F.col("node").alias("b"))
    roots = components(links.unionByName(ties), ws)
    found = ws.save(nodes.join(roots.withColumnRenamed("node", "at"), F.col("node") == F.col("at"), "left").select(F.col("mark").alias("of"), F.coalesce("root", "node").alias("component")), "components")
    out = marks.join(found, F.col("mark") == F.col("of"), "left")
    shown = F.lower(F.lpad(F.hex("mark"), 16, "0"))
    return out.select("doc_id", shown.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"))


def one_of_each(docs: DataFrame, ws: Workspace, words: int = 3) -> DataFrame:
    """The rows of docs that name their group: one document of each stays, and one row of a repeated doc_id, that of the smallest
    text hash. A row of a null doc_id stays."""
    groups = ws.save(near_duplicates(docs, ws, words).select("doc_id", "component_id"), "groups")
    gone = ws.save(groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct(), "gone")
    gone = sent_if_small(gone, gone.count())
    stays = docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti")
    repeated = ws.save(groups.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again")), "repeated")
    if repeated.isEmpty():
        return stays
    order = next(n for n in (f"order_{k}" for k in range(len(docs.columns) + 1)) if n not in {c.lower() for c in docs.columns})
    again = stays.join(repeated, stays["doc_id"].cast("long") == repeated["again"], "left_semi")
    again = again.withColumn(order, F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text"))).where(F.col(order) == 1).drop(order)
    return stays.join(repeated, stays["doc_id"].cast("long") == repeated["again"], "left_anti").unionByName(again)
