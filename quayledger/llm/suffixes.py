"""Passages that repeat across documents, by a sparse suffix array over minimiser positions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayledger.llm.shared import Workspace, grouped, ranges, sent_if_small, slices, texts_of
from quayledger.llm.words import BASE, mixed, runs, words_of

#: Words of a passage that counts, words of the gram that chooses positions, and positions of which one is chosen.
LEAST, GRAM, WINDOW = 50, 4, 25
#: Words to the right of a chosen position that are equal in its class, and words carried left of it and right of those.
RIGHT = LEAST - WINDOW + 1
AROUND = WINDOW - 1
#: Rows of one class that are compared at once; more are parted, and their parts' windows joined.
SEGMENT = 10_000


def minimisers(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions with the smallest gram hash of any WINDOW neighbouring ones of their text, the leftmost of equals. Two texts
    that share LEAST words choose the same position among the first WINDOW of these."""
    n = len(hashes) - GRAM - WINDOW + 2
    if n <= 0:
        return np.zeros(0, np.int64)
    at = np.arange(len(hashes) - GRAM + 1)
    low = np.uint64((1 << 20) - 1)
    score = runs(hashes, at, at + GRAM) & ~low | at.astype(np.uint64) & low
    least, span = score, 1
    while 2 * span <= WINDOW:
        least, span = np.minimum(least[:-span], least[span:]), 2 * span
    least = np.minimum(least[: len(score) - WINDOW + 1], least[WINDOW - span :][: len(score) - WINDOW + 1])
    window = np.arange(len(least))
    end = np.repeat(starts[1:], np.diff(starts))[: len(least)]
    window = window[window + WINDOW - 1 + GRAM <= end[window]]
    chosen = window + ((least[window] & low).astype(np.int64) - window & int(low))
    return np.unique(chosen)


def candidates(texts: DataFrame) -> DataFrame:
    """doc_id, which, place and class of every chosen position with RIGHT words at least; the class hashes those words."""

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches, 1 << 20):
            ids, which = ([r[c] for r in rows] for c in ("doc_id", "which"))
            hashes, _, _, starts = words_of(texts)
            at = minimisers(hashes, starts)
            text = np.searchsorted(starts, at, "right") - 1
            whole = at + RIGHT <= starts[text + 1]
            at, text = at[whole], text[whole]
            rows = (pa.array(x, pa.int64()).take(pa.array(text)) for x in (ids, which))
            yield pa.RecordBatch.from_arrays([*rows, pa.array((at - starts[text]).astype(np.int32)), pa.array(runs(hashes, at, at + RIGHT).view(np.int64))], names=["doc_id", "which", "place", "key"])

    return texts.select(F.struct("doc_id", "which").alias("row"), "text").mapInArrow(choose, "doc_id long, which long, place int, key long")


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, text, places, keys, which): a row per place with the word hashes around it; zero beyond the text's ends."""
    for batch in batches:
        for k in range(batch.num_rows):
            hashes, *_ = words_of([batch.column(1)[k].as_buffer().to_pybytes()])
            short = np.maximum(hashes >> np.uint64(32), np.uint64(1)).astype(">u4")
            padded = np.concatenate([np.zeros(AROUND, ">u4"), short, np.zeros(AROUND + RIGHT, ">u4")])
            places, keys = (batch.column(c)[k].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
            around = np.arange(AROUND)
            left = padded[places[:, None] + AROUND - 1 - around]
            right = padded[places[:, None] + AROUND + RIGHT + around]
            size = 4 * AROUND
            rows = [pa.array([x[a : a + size] for a in range(0, len(x), size)], pa.binary()) for x in (left.tobytes(), right.tobytes())]
            doc, which = (pa.array(np.full(len(places), batch.column(c)[k].as_py(), np.int64)) for c in (0, 4))
            yield pa.RecordBatch.from_arrays([pa.array(keys), rows[1], rows[0], doc, pa.array(places.astype(np.int32)), which], names=["key", "right", "left", "doc_id", "place", "which"])


def _equal(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of leading equal words, of words that are there."""
    same = (a == b) & (a != 0)
    return np.where(same.all(1), same.shape[1], same.argmin(1))


def _smaller_above(docs: list[int], first: list[bool]) -> list[int]:
    """For each row the nearest row above it, of its class, that has a smaller doc_id, else -1."""
    out, stack = [], []
    for k, doc in enumerate(docs):
        if first[k]:
            stack.clear()
        while stack and docs[stack[-1]] >= doc:
            stack.pop()
        out.append(stack[-1] if stack else -1)
        stack.append(k)
    return out


def _nearest(docs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest rows of smaller doc_id above and below."""
    above = np.array(_smaller_above(docs.tolist(), first.tolist()), np.int64)
    last = np.append(first[1:], True)
    below = np.array(_smaller_above(docs[::-1].tolist(), last[::-1].tolist()), np.int64)[::-1]
    return above, np.where(below >= 0, len(docs) - 1 - below, -1)


def _windows(keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of LEAST words that begin 0 to AROUND words left of each position, and which of them the text has."""
    powers = np.multiply.accumulate(np.full(AROUND, BASE))
    sums, there = [], []
    for words in (left, right):
        sums.append(np.pad(np.cumsum(words.astype(np.uint64) * powers, axis=1, dtype=np.uint64), ((0, 0), (1, 0))))
        there.append(np.pad(words != 0, ((0, 0), (1, 0)), constant_values=True))
    return mixed(mixed(sums[0] + keys.view(np.uint64)[:, None]) + sums[1][:, ::-1]), there[0] & there[1][:, ::-1]


def _extremes(hashes: np.ndarray, there: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the smallest and the largest doc_id of the rows that have it; where there is none, the row's own."""
    by_doc = np.argsort(docs, kind="stable")
    i, offset = np.nonzero(there[by_doc])
    i = by_doc[i]
    order = np.argsort(hashes[i, offset], kind="stable")
    i, offset = i[order], offset[order]
    least, most = np.repeat(docs[:, None], there.shape[1], 1), np.repeat(docs[:, None], there.shape[1], 1)
    if len(i):
        h = hashes[i, offset]
        at = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        sizes = np.diff(np.append(at, len(h)))
        least[i, offset] = np.repeat(docs[i[at]], sizes)
        most[i, offset] = np.repeat(docs[i[at + sizes - 1]], sizes)
    return least, most


def _joined(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first and last columns of the runs of set fields in each row."""
    step = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(step == 1)
    return row, first, np.nonzero(step == -1)[1] - 1


FOUND = "doc_id long, start int, words int, kept boolean, first_doc_id long, key long, right binary, left binary, place int, which long"


def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted suffixes: the passages that a document shares with a neighbour of smaller doc_id, for both documents; the windows
    of LEAST words that it shares with any other row of the segment, whatever lies between. For the classes that may go on in
    another segment: with kept null, the windows that no smaller document of this segment has, key their hash; and, with start
    null, the ends and the smallest doc_id of each segment, compared once more."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int32()), ("words", pa.int32()), ("kept", pa.bool_()), ("first_doc_id", pa.int64()), ("key", pa.int64()), ("right", pa.binary()), ("left", pa.binary()), ("place", pa.int32()), ("which", pa.int64())])
    for table, begun, goes_on in _segments(batches):
        n = table.num_rows
        bounds = ranges(table, ["key"])
        first = np.zeros(n, bool)
        first[bounds[:-1]] = True
        docs, places = table["doc_id"].to_numpy(), table["place"].to_numpy().astype(np.int64)
        which = table["which"].to_numpy() if "which" in table.column_names else np.zeros(n, np.int64)
        left, right = (np.frombuffer(b"".join(table[c].to_pylist()), ">u4").reshape(n, AROUND) for c in ("left", "right"))
        best, other, reach = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n, np.int64)
        offsets = np.arange(AROUND + 1)
        for near in _nearest(docs, first):
            i = np.flatnonzero(near >= 0)
            before = _equal(left[i], left[near[i]])
            total = before + RIGHT + _equal(right[i], right[near[i]])
            better = total > best[i]
            best[i[better]], other[i[better]], reach[i[better]] = total[better], near[i[better]], before[better]
        i = np.flatnonzero(best >= LEAST)
        j = other[i]
        doc = np.concatenate([docs[i], docs[j]])
        empty = pa.nulls(len(doc))
        yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(np.concatenate([places[i] - reach[i], places[j] - reach[i]]).astype(np.int32)), pa.array(np.tile(best[i], 2).astype(np.int32)), pa.array(np.repeat([False, True], len(i))), pa.array(np.tile(docs[j], 2))] + [empty.cast(t) for t in schema.types[5:-1]] + [pa.array(np.concatenate([which[i], which[j]]))], schema=schema)
        # Windows that a smaller document of the segment has and the neighbours didn't show, and those of the smallest document.
        hashes, there = _windows(table["key"].to_numpy(), left, right)
        least, most = _extremes(hashes, there, docs)
        shown = (offsets <= reach[:, None]) & (AROUND - offsets <= (best - RIGHT - reach)[:, None])
        for mask, kept in (((least < docs[:, None]) & ~shown, False), ((least == docs[:, None]) & (most > least), True)):
            i, a, b = _joined(mask)
            empty = pa.nulls(len(i))
            yield pa.RecordBatch.from_arrays([pa.array(docs[i]), pa.array((places[i] - b).astype(np.int32)), pa.array((LEAST + b - a).astype(np.int32)), pa.array(np.full(len(i), kept)), pa.array(least[i, a])] + [empty.cast(t) for t in schema.types[5:-1]] + [pa.array(which[i])], schema=schema)
        # Classes that may go on in the segment before or after, in this task or another.
        ends, open_ = [], np.zeros((n, 1), bool)
        edges = [(int(bounds[0]), int(bounds[1]))] * begun + [(int(bounds[-2]), int(bounds[-1]))] * goes_on
        if not edges:
            continue
        for a, b in set(edges):
            ends += [a, b - 1, a + int(docs[a:b].argmin())]
            open_[a:b] = True
        i, offset = np.nonzero(open_ & there & (least == docs[:, None]))
        # The places of one window in one text that overlap or touch are one row, so a text of few words again and again is few rows.
        start, h = places[i] - offset, hashes[i, offset]
        by = np.lexsort((start, which[i], h))
        i, start, h = i[by], start[by], h[by]
        new = np.ones(len(i), bool)
        new[1:] = (h[1:] != h[:-1]) | (which[i][1:] != which[i][:-1]) | (start[1:] > start[:-1] + LEAST)
        at = np.flatnonzero(new)
        words = start[np.append(at[1:], len(i)) - 1] - start[at] + LEAST if len(at) else start
        i = i[at]
        empty = pa.nulls(len(i))
        columns = {"doc_id": pa.array(docs[i]), "start": pa.array(start[at].astype(np.int32)), "words": pa.array(words.astype(np.int32)), "key": pa.array(h[at].view(np.int64)), "which": pa.array(which[i])}
        yield pa.RecordBatch.from_arrays([columns.get(f.name, empty.cast(f.type)) for f in schema], schema=schema)
        ends = sorted(set(ends))
        rows = table.take(pa.array(ends))
        nothing = pa.nulls(rows.num_rows)
        yield pa.RecordBatch.from_arrays([rows["doc_id"].combine_chunks(), nothing.cast(pa.int32()), nothing.cast(pa.int32()), nothing.cast(pa.bool_()), nothing.cast(pa.int64()), *(rows[c].combine_chunks() for c in ("key", "right", "left", "place")), pa.array(which[ends])], schema=schema)


def _segments(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Table, bool, bool]]:
    """Runs of whole classes, and whether the first class may have begun before and the last may go on after.

    A batch's last class is held back for the next batch, so only the first and last of a task, and one of more than SEGMENT
    rows, are open."""
    held, begun = None, True
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        keys = table["key"].to_numpy()
        if cut := int(np.searchsorted(keys, keys[-1], "left")):
            yield table.slice(0, cut).combine_chunks(), begun, False
            begun = False
        held = table.slice(cut)
        while held.num_rows > SEGMENT:
            yield held.slice(0, SEGMENT).combine_chunks(), begun, True
            held, begun = held.slice(SEGMENT), True
    if held is not None and held.num_rows:
        yield held.combine_chunks(), begun, True


def _merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlapping and touching passages of one text and kind as one; rows come sorted by doc_id, which, kept and start."""
    for table in grouped(batches, ["doc_id", "which", "kept"]):
        bounds = ranges(table, ["doc_id", "which", "kept"])
        start, words, first = (table[c].to_numpy().astype(np.int64) for c in ("start", "words", "first_doc_id"))
        group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        wide = int((start + words).max()) + 2
        end = np.maximum.accumulate(start + words + group * wide)
        new = np.ones(len(start), bool)
        new[1:] = (start + group * wide)[1:] > end[:-1]
        at = np.flatnonzero(new)
        last = end[np.append(at[1:], len(start)) - 1] - group[at] * wide
        yield pa.RecordBatch.from_arrays([table["doc_id"].take(pa.array(at)).combine_chunks(), pa.array(start[at].astype(np.int32)), pa.array((last - start[at]).astype(np.int32)), table["kept"].take(pa.array(at)).combine_chunks(), pa.array(np.minimum.reduceat(first, at)), table["which"].take(pa.array(at)).combine_chunks()], names=["doc_id", "start", "words", "kept", "first_doc_id", "which"])


def repeats(docs: DataFrame, ws: Workspace) -> DataFrame:
    """doc_id, start, words, kept and first_doc_id of every passage of LEAST words or more that stands in several documents.

    start and words count words between white space. kept is true where a document of larger doc_id has been found to have the
    passage, false where one of smaller doc_id has it; those may be cut out, first_doc_id names a document that has it too. Copies of a whole text are
    one text in the search, named by the smallest doc_id, and each copy is one passage. Suffixes are dealt by ranges of
    (class, words to the right, words to the left, document), so a passage in a third of the documents is split; the ends of
    the parts are compared in a second, small pass. Neighbours show most passages whole; what unrelated rows part is found by
    grouping the windows of LEAST words around each position of a class by 64-bit hashes, in each part first, then over the
    parts that a class may lie in. Words are told apart by a 64-bit hash of 26 and 32-bit hashes of the others.

    Null and short texts have no passage; a null doc_id can't be named and is left out; rows of one doc_id count as one
    document, its passages by each row's own words; an empty table gives no rows."""
    return _spans(docs, ws).drop("which")


def _spans(docs: DataFrame, ws: Workspace) -> DataFrame:
    """The rows of `repeats`, and which of an id's texts each stands in: zero, or a text's hash where an id has several."""
    texts = texts_of(docs).where("doc_id is not null")
    marks = ws.save(texts.select("doc_id", F.xxhash64("text").alias("x"), F.xxhash64(F.lit(1), "text").alias("y"), F.regexp_count("text", F.lit(r"[^\x09-\x0D\x20]+")).alias("words")), "marks")
    several = ws.save(marks.groupBy("doc_id").agg(F.min("x").alias("x"), F.max("x").alias("y")).where("x <> y").select(F.col("doc_id").alias("of")), "several")
    many = several.count()

    def told_apart(rows: DataFrame, x: Column) -> DataFrame:
        if not many:
            return rows.withColumn("which", F.lit(0).cast("long"))
        joined = rows.join(sent_if_small(several, many), F.col("doc_id") == F.col("of"), "left")
        return joined.withColumn("which", F.when(F.col("of").isNull(), F.lit(0)).otherwise(x)).drop("of")

    marks, texts = told_apart(marks, F.col("x")), told_apart(texts, F.xxhash64("text"))
    groups = marks.where(F.col("words") >= LEAST).groupBy("x", "y").agg(F.min("doc_id").alias("first_doc_id"), F.count_distinct("doc_id").alias("copies"))
    groups = ws.save(groups.where("copies > 1").drop("copies"), "copies")
    copies = ws.save(marks.join(groups, ["x", "y"]).select("doc_id", "which", "words", "first_doc_id").distinct(), "copied")
    whole = copies.select("doc_id", F.lit(0).alias("start"), "words", (F.col("doc_id") == F.col("first_doc_id")).alias("kept"), "first_doc_id", "which")
    later = copies.where("doc_id <> first_doc_id").select("doc_id", "which").distinct()
    found = candidates(texts).join(later, ["doc_id", "which"], "left_anti").distinct()
    found = ws.save(found, "places")
    shared = ws.save(found.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a <> b").select(F.col("key").alias("of")), "shared")
    places = found.join(shared, F.col("key") == F.col("of"), "left_semi").groupBy("doc_id", "which").agg(F.collect_list(F.struct("place", "key")).alias("at"))
    places = ws.save(places.select(F.col("doc_id").alias("of"), F.col("which").alias("of_which"), F.col("at.place").alias("places"), F.col("at.key").alias("keys")), "places")
    # Places grow with the texts, so both are shuffled at every size.
    around = texts.join(places.hint("merge"), (F.col("doc_id") == F.col("of")) & (F.col("which") == F.col("of_which"))).select("doc_id", "text", "places", "keys", "which")
    suffixes = ws.save(around.mapInArrow(_contexts, "key long, right binary, left binary, doc_id long, place int, which long"), "suffixes")
    ws.drop(found, shared)
    order = ["key", "right", "left", "doc_id", "place", "which"]
    passages = ws.save(suffixes.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compared, FOUND), "passages")
    ends = passages.where("start is null").select(*order).distinct()
    again = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(compared, FOUND)
    # Each segment sends a window of its open classes for its smallest document alone, so no window is hot.
    windows = passages.where("kept is null and start is not null").select("key", "doc_id", "start", "words", "which")
    several = windows.groupBy("key").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last")).where("first_doc_id <> last").drop("last")
    across = windows.join(several, "key").withColumn("kept", F.col("doc_id") == F.col("first_doc_id"))
    columns = ["doc_id", "start", "words", "kept", "first_doc_id", "which"]
    spans = passages.unionByName(again).where("kept is not null").select(*columns).unionByName(across.select(*columns)).unionByName(whole).distinct()
    return spans.repartition("doc_id").sortWithinPartitions("doc_id", "which", "kept", "start").mapInArrow(_merged, "doc_id long, start int, words int, kept boolean, first_doc_id long, which long")


def cut_repeats(docs: DataFrame, ws: Workspace) -> DataFrame:
    """docs without the passages that a document of smaller doc_id has too; a text left without a word goes as a whole.

    A passage goes from its first word up to the next word that stays. Other columns stay as they are, but for n_chars, the
    text's length, where it is there. Rows without such a passage, and rows of a null doc_id, are untouched."""
    spans = ws.save(_spans(docs, ws).where("not kept").groupBy("doc_id", "which").agg(F.collect_list(F.struct("start", "words")).alias("s")), "cuts")
    many = spans.agg(F.coalesce(F.sum(F.size("s")), F.lit(0))).first()[0]
    taken = {c.lower() for c in docs.columns}
    of, which, cut = (next(n for n in (f"{x}_{k}" for k in range(len(taken) + 1)) if n not in taken) for x in ("of", "which", "cut"))
    spans = sent_if_small(spans.select(F.col("doc_id").alias(of), F.col("which").alias(which), F.col("s").alias(cut)), many)
    # A null text has no passage, so its hash isn't asked for; an id of one text has which 0.
    same = (F.col(which) == 0) | (F.col(which) == F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    joined = docs.join(spans, (F.col("doc_id").cast("long") == F.col(of)) & same, "left").drop(of, which)
    text, cuts = joined.columns.index("text"), joined.columns.index(cut)
    chars = joined.columns.index("n_chars") if "n_chars" in joined.columns else None

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lists, stays = batch.column(text), batch.column(cuts), np.ones(batch.num_rows, bool)
            changed = {}
            for k in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False)):
                data = texts[int(k)].as_py().encode() if texts[int(k)].is_valid else b""
                _, first, _, _ = words_of([data])
                gone = np.zeros(len(data), bool)
                for s in lists[int(k)].as_py():
                    a, b = s["start"], s["start"] + s["words"]
                    if a < len(first):
                        gone[first[a] : first[b] if b < len(first) else len(data)] = True
                left = np.frombuffer(data, np.uint8)[~gone].tobytes().decode()
                stays[k] = bool(left.split())
                changed[int(k)] = left
            columns = batch.columns[:cuts] + batch.columns[cuts + 1 :]
            if changed:
                columns[text] = pa.array([changed.get(k, x) for k, x in enumerate(texts.to_pylist())], texts.type)
                if chars is not None:
                    columns[chars] = pa.array([len(changed[k]) if k in changed else x for k, x in enumerate(batch.column(chars).to_pylist())]).cast(batch.column(chars).type)
            names = [n for k, n in enumerate(batch.schema.names) if k != cuts]
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stays))

    return joined.mapInArrow(apply, docs.schema)
