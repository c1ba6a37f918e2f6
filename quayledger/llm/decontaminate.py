"""Benchmark decontamination: CGK embedding, bit sampling over item-sized windows, exact edit distances."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayledger.llm.shared import Workspace, sent_if_small, ship, slices, texts_of
from quayledger.llm.words import MARKS, mixed, words_of

#: Least similarity: 1 less the edit distance in words over the item's words.
SIMILARITY = 0.8
#: Independent random walks, tables of each, sampled places of a table. tests/llm measures the recall at the least similarity.
WALKS, TABLES, PLACES = 16, 32, 2
#: Characters and number of benchmark items that go to the tasks at once; more go in several passes over the documents. An item's
#: keys take 8.7 KB whatever its length.
BLOCK_CHARS, BLOCK_ITEMS = 8_000_000, 20_000
#: Numbers of an array that windows, and then pairs of windows and items, are worked on at once.
MOST_NUMBERS = 1_000_000
#: Codes of a word that no item has, and of what follows a window's end.
UNKNOWN, PAST = 0, 1


def edits(n: int, similarity: float = SIMILARITY) -> int:
    return math.floor((1 - similarity) * n + 1e-9)


def walk(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """The CGK embedding of the windows codes[start:end]: at every step the word at the pointer is written, and a random bit
    of (step, word) tells if the pointer moves on. Strings at a small edit distance stay in step and differ in few places."""
    at, out = starts.copy(), np.empty((len(starts), steps), np.int64)
    for k in range(steps):
        here = np.where(at < ends, codes[np.minimum(at, len(codes) - 1)], PAST)
        out[:, k] = here
        at += (mixed(here.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed * 65_536 + k)) >> np.uint64(17) & np.uint64(1)).astype(np.int64)
    return out


def distances(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """For each pair the least edit distance of the item to a beginning of the text, and the length of that beginning."""
    sizes, ends = np.array([*map(len, items)]), np.array([*map(len, texts)])
    a, b = np.full((len(items), sizes.max()), -1), np.full((len(items), ends.max()), -2)
    for k, (x, y) in enumerate(zip(items, texts)):
        a[k, : len(x)], b[k, : len(y)] = x, y
    ramp = np.arange(b.shape[1] + 1)
    row = np.tile(ramp, (len(a), 1))
    best, length = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in range(1, a.shape[1] + 1):
        step = np.empty_like(row)
        step[:, 0] = k
        step[:, 1:] = np.minimum(row[:, 1:] + 1, row[:, :-1] + (b != a[:, k - 1 : k]))
        row = np.minimum.accumulate(step - ramp, axis=1) + ramp
        done = np.flatnonzero(sizes == k)
        if done.size:
            inside = np.where(ramp <= ends[done, None], row[done], np.iinfo(np.int64).max)
            length[done] = inside.argmin(1)
            best[done] = inside.min(1)
    return best, length


def runs_of(widths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """First and end of runs of rows that, all as wide as the widest, hold at most `most` numbers, one row at least; widths ascend."""
    at = 0
    while at < len(widths):
        full = widths[at : at + most] * np.arange(1, len(widths[at : at + most]) + 1) > most
        end = at + max(1, int(full.argmax()) if full.any() else len(full))
        yield at, end
        at = end


class Items:
    """Benchmark items ready for the search, grouped by their number of words."""

    def __init__(self, items: list[tuple[int, bytes]], similarity: float = SIMILARITY):
        hashes, _, _, first = words_of([t.lower() for _, t in items], MARKS)
        self.vocabulary = np.unique(hashes)
        self.ids = [i for i, _ in items]
        self.words = [self.codes(hashes[a:b]) for a, b in zip(first, first[1:])]
        self.similarity = similarity
        # An edit loses one word of an item, so of any m of its words a match has all but as many as the edits. m takes the words
        # that fewest items have; places without enough of one item's are left out without loss.
        spread = Counter(w for x in self.words for w in set(x.tolist()))
        self.need, self.wide, posts, whole = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64), [], []
        for k, x in enumerate(self.words):
            if n := len(x):
                e = edits(n, similarity)
                rarest = sorted(x.tolist(), key=lambda w: (spread[w], w))
                m = min(n, max(e + 1, n // 3))
                picked = set(rarest[:m])
                self.need[k], self.wide[k] = sum(w in picked for w in x.tolist()) - e, n + e
                posts += [(w, k) for w in picked]
                whole += [(k, w) for w in set(x.tolist())]
        self.sizes = np.array([len(x) for x in self.words], np.int64)
        self.posts = np.array(sorted(posts), np.int64).reshape(-1, 2)
        self.whole = np.array(sorted(k * (len(self.vocabulary) + 2) + w for k, w in whole), np.int64)
        self.places = np.random.default_rng(3).random((WALKS, TABLES, PLACES))
        self.tables = self._tables()

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.vocabulary, hashes)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == hashes[known]
        return np.where(known, at + 2, UNKNOWN)

    def _keys(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """Of each table, the keys of the windows of so many words: sampled places of their embedding."""
        steps = max(1, math.ceil(1.6 * int(sizes.max())))
        for w in range(WALKS):
            out = walk(codes, starts, np.minimum(starts + sizes, ends), steps, w)
            for t in range(TABLES):
                key, row = mixed(sizes.astype(np.uint64)), np.arange(len(starts))
                for p in range(PLACES):
                    place = (self.places[w, t, p] * np.ceil(1.6 * sizes)).astype(np.int64)
                    key = mixed(key + out[row, place].astype(np.uint64) + np.uint64(1))
                yield key

    def _tables(self) -> list[tuple[np.ndarray, np.ndarray]]:
        names = np.flatnonzero(self.sizes)
        if not len(names):
            return []
        # By size, so that a few very long items don't widen the embedding of the others.
        names = names[np.argsort(self.sizes[names], kind="stable")]
        flat, sizes = np.concatenate([self.words[k] for k in names]), self.sizes[names]
        ends = np.cumsum(sizes)
        keys = np.empty((WALKS * TABLES, len(names)), np.uint64)
        for a, b in runs_of(2 * sizes, MOST_NUMBERS):
            for t, key in enumerate(self._keys(flat, ends[a:b] - sizes[a:b], sizes[a:b], ends[a:b])):
                keys[t, a:b] = key
        orders = (np.argsort(key, kind="stable") for key in keys)
        return [(key[order], names[order]) for key, order in zip(keys, orders)]

    def _starts(self, codes: np.ndarray, first: np.ndarray, text_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a match may begin, and the words of the items it may match: at a word of an item, with enough of its rarest words ahead."""
        lo, hi = np.searchsorted(self.posts[:, 0], codes, "left"), np.searchsorted(self.posts[:, 0], codes, "right")
        many = hi - lo
        place = np.repeat(np.arange(len(codes)), many)
        item = self.posts[np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(lo, many), 1]
        order = np.argsort(item, kind="stable")
        item, place = item[order], place[order]
        last = np.arange(len(item)) + np.maximum(self.need[item], 1) - 1
        good = last < len(item)
        k, last = np.flatnonzero(good), last[good]
        k, last = k[item[k] == item[last]], last[item[k] == item[last]]
        near = (place[last] - place[k] < self.wide[item[k]]) & (text_of[place[k]] == text_of[place[last]])
        k, last = k[near], last[near]
        # The match ends at or after the last of them, so begins less than its width before; and at or before the first.
        low = np.maximum(place[last] - self.wide[item[k]] + 1, first[text_of[place[k]]])
        size = place[k] - low + 1
        start = np.repeat(low, size) + np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        of = np.repeat(item[k], size)
        pair = np.unique(of * len(codes) + start)
        of, start = pair // len(codes), pair % len(codes)
        key = of * (len(self.vocabulary) + 2) + codes[start]
        at = np.minimum(np.searchsorted(self.whole, key), len(self.whole) - 1)
        own = self.whole[at] == key
        window = np.unique(start[own] * (int(self.sizes.max()) + 1) + self.sizes[of[own]])
        return window // (int(self.sizes.max()) + 1), window % (int(self.sizes.max()) + 1)

    def matches(self, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, edits) of every window found and verified."""
        hashes, _, _, first = words_of([t.lower() for t in texts], MARKS)
        codes = self.codes(hashes)
        if not len(codes) or not self.tables:
            return
        text_of = np.repeat(np.arange(len(texts)), np.diff(first))
        end_of = first[1:][text_of]
        all_starts, all_sizes = self._starts(codes, first, text_of)
        by_size = np.argsort(all_sizes, kind="stable")
        all_starts, all_sizes = all_starts[by_size], all_sizes[by_size]
        for at, to in runs_of(2 * all_sizes, MOST_NUMBERS):
            starts, sizes = all_starts[at:to], all_sizes[at:to]
            pairs = set()
            for key, (keys, names) in zip(self._keys(codes, starts, sizes, end_of[starts]), self.tables):
                a, b = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
                for k in np.flatnonzero(b > a).tolist():
                    pairs.update((k, int(i)) for i in names[a[k] : b[k]])
            ordered = sorted(pairs)
            for k, stop in runs_of(2 * sizes[np.array([w for w, _ in ordered], np.int64)], MOST_NUMBERS // 4):
                own = ordered[k:stop]
                begin = [int(starts[w]) for w, _ in own]
                most = [edits(int(sizes[w]), self.similarity) for w, _ in own]
                d, size = distances([self.words[i] for _, i in own], [codes[s : min(s + int(sizes[w]) + e, int(end_of[s]))] for s, e, (w, _) in zip(begin, most, own)])
                for j in np.flatnonzero(d <= most):
                    s = begin[j]
                    yield int(text_of[s]), own[j][1], s - int(first[text_of[s]]), int(size[j]), int(d[j])


FOUND = "doc_id long, item_id long, start int, words int, edits int"


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_chars: int = BLOCK_CHARS, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, start, words and edits: the best window of every document that holds a benchmark item (item_id, text).

    Words are runs of letters and digits, A-Z lower-cased. A window counts with at most (1 - similarity) edits per item word.
    The items go to the tasks in blocks of checked characters and number, with a pass over the documents for each, so documents are never
    shuffled. Null and empty texts and items match nothing; null ids are left out; repeated rows of a doc_id give its best window
    once; empty tables give no rows."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    number, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(-(-chars // block_chars), -(-number // block_items))
    found = spark.createDataFrame([], FOUND)
    for b in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()  # bounded by the block
        index = Items([(r["item_id"], r["text"].encode()) for r in own], similarity)

        def search(batches: Iterable[pa.RecordBatch], index: Items = index) -> Iterator[pa.RecordBatch]:
            for ids, texts in slices(batches, 1 << 20):
                rows = [(ids[t], index.ids[i], s, w, d) for t, i, s, w, d in index.matches(texts)]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "item_id", "start", "words", "edits"])

        found = found.unionByName(texts_of(docs).where("doc_id is not null").mapInArrow(search, FOUND))
    best = found.groupBy("doc_id", "item_id").agg(F.min(F.struct("edits", "start", "words")).alias("m"))
    return best.select("doc_id", "item_id", F.col("m.start").alias("start"), F.col("m.words").alias("words"), F.col("m.edits").alias("edits"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, ws: Workspace, **options) -> DataFrame:
    """The rows of docs that hold no benchmark item; a row of a null doc_id stays."""
    gone = ws.save(leaks(docs, benchmark, **options).select(F.col("doc_id").alias("leaking")).distinct(), "leaking")
    gone = sent_if_small(gone, gone.count())
    return docs.join(gone, docs["doc_id"].cast("long") == gone["leaking"], "left_anti")
