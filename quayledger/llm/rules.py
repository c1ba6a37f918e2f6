"""Quality rules as a short-circuit cascade, ordered by rejection per cost as estimated on a sample."""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections import Counter
from collections.abc import Callable, Collection, Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayledger.llm.shared import ship, slices, texts_of
from quayledger.llm.words import SPACE, mixed, words_of

#: Words of a window whose repeats count, and the bytes of a text that are read at once.
WINDOW, PIECE = 8, 1 << 20
#: Rows of the sample that orders the rules, about, and the most characters of one.
SAMPLE_ROWS, SAMPLE_CHARS = 512, 65_536
#: Characters that count as symbols, and marks that begin a list line.
SYMBOLS, BULLETS = b"#*$%&|<>", (b"-", b"*", "•".encode())

LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
#: A word so long that its digest stands for it; no text of fewer bytes is searched for one.
LONG, LONG_WORD = 1 << 16, re.compile(rb"[^\x20\x09-\x0D]{65537,}")

Counts = dict[str, np.ndarray]


def pieces(text: bytes) -> Iterator[bytes]:
    """A text in runs of about PIECE bytes that end with white space, so that no word is cut."""
    start = 0
    while len(text) - start > PIECE:
        cut = re.compile(rb"[\x20\x09-\x0D]").search(text, start + PIECE)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def _by_pieces(texts: list[bytes], measure: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """Column sums of `measure` (a row per text); texts longer than PIECE are measured by pieces."""
    if all(len(t) <= PIECE for t in texts):
        return measure(texts)
    return np.array([measure([t])[0] if len(t) <= PIECE else sum(measure([p])[0] for p in pieces(t)) for t in texts])


def count_words(texts: list[bytes]) -> Counts:
    """n_words, word_chars (code points in words) and n_bare (words without a letter)."""

    def measure(some: list[bytes]) -> np.ndarray:
        data = np.frombuffer(b"\n".join([*some, b""]), np.uint8)
        inner = ~SPACE[data]
        edge = np.flatnonzero(np.diff(inner, prepend=False, append=False))
        first, last = edge[0::2], edge[1::2]
        chars = np.concatenate([[0], np.cumsum(inner & ((data & 0xC0) != 0x80))])
        letters = np.concatenate([[0], np.cumsum(LETTER[data])])
        ends = np.cumsum([0, *(len(t) + 1 for t in some)])
        bare = np.concatenate([[0], np.cumsum(letters[last] == letters[first])])
        at = np.searchsorted(first, ends)
        return np.stack([np.diff(at), np.diff(chars[ends]), np.diff(bare[at])], 1)

    found = _by_pieces(texts, measure)
    return dict(zip(("n_words", "word_chars", "n_bare"), found.T))


def count_symbols(texts: list[bytes]) -> Counts:
    """n_symbols: characters of SYMBOLS."""
    return {"n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)}


def count_capitals(texts: list[bytes]) -> Counts:
    """n_capitals: letters A to Z."""
    capitals = bytes(range(65, 91))
    return {"n_capitals": np.array([len(t) - len(t.translate(None, capitals)) for t in texts], np.int64)}


def count_lines(texts: list[bytes]) -> Counts:
    """Of the lines with a word: n_lines, n_dup_lines (equal to an earlier one), n_cut_lines (ending in three full stops) and n_bullets."""
    found = []
    for text in texts:
        seen: Counter[bytes] = Counter(line for line in text.split(b"\n") if line.strip(b" \t\n\v\f\r"))
        ends = sum(n for line, n in seen.items() if line.rstrip(b" \t\n\v\f\r").endswith(b"..."))
        marks = sum(n for line, n in seen.items() if line.lstrip(b" \t\n\v\f\r").startswith(BULLETS))
        found.append((seen.total(), seen.total() - len(seen), ends, marks))
    return dict(zip(("n_lines", "n_dup_lines", "n_cut_lines", "n_bullets"), np.array(found, np.int64).reshape(-1, 4).T))


def count_repeats(texts: list[bytes]) -> Counts:
    """n_repeat_words: words in windows of WINDOW words that stand twice or more in the text; n_stutters: words equal to the word
    before. Both by 64-bit hashes."""
    parts, sizes = [], []
    short: list[bytes] = []

    def flush() -> None:
        hashes, _, _, first = words_of(short)
        parts.append(hashes)
        sizes.extend(np.diff(first).tolist())
        short.clear()

    for text in texts:
        if len(text) <= PIECE:
            short.append(LONG_WORD.sub(_named, text) if len(text) > LONG else text)
            continue
        flush()
        runs = [words_of([p])[0] for p in pieces(LONG_WORD.sub(_named, text))]
        parts.extend(runs)
        sizes.append(sum(map(len, runs)))
    flush()
    words, text = np.concatenate(parts), np.repeat(np.arange(len(sizes)), sizes)
    stutters = np.bincount(text[1:][(words[1:] == words[:-1]) & (text[1:] == text[:-1])], minlength=len(texts))
    starts = len(words) - WINDOW + 1
    if starts < 1:
        return {"n_repeat_words": np.zeros(len(texts), np.int64), "n_stutters": stutters}
    keys = np.zeros(starts, np.uint64)
    for k in range(WINDOW):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + words[k : k + starts]
    whole = np.flatnonzero(text[:starts] == text[WINDOW - 1 :])
    keys = mixed(keys[whole] + mixed(text[whole].astype(np.uint64)))  # windows of different texts differ
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    again = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    step = np.zeros(len(words) + 1, np.int64)
    step[whole[again]] += 1
    step[whole[again] + WINDOW] -= 1
    return {"n_repeat_words": np.bincount(text[np.cumsum(step[:-1]) > 0], minlength=len(texts)), "n_stutters": stutters}


def _named(found: re.Match) -> bytes:
    return b"\0" + hashlib.sha256(found[0]).hexdigest().encode()


#: What is counted, each with one reading of the text, and the names of the counts.
COUNTERS: dict[str, tuple[Callable[[list[bytes]], Counts], tuple[str, ...]]] = {
    "words": (count_words, ("n_words", "word_chars", "n_bare")),
    "symbols": (count_symbols, ("n_symbols",)),
    "capitals": (count_capitals, ("n_capitals",)),
    "lines": (count_lines, ("n_lines", "n_dup_lines", "n_cut_lines", "n_bullets")),
    "repeats": (count_repeats, ("n_repeat_words", "n_stutters")),
}


@dataclass(frozen=True)
class Rule:
    """A text is rejected where `rejects`, a condition on counts that Python, numpy and SQL read alike, holds."""

    name: str
    rejects: str
    of: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        names = set(re.findall(r"[a-z_]+", self.rejects))
        object.__setattr__(self, "of", tuple(k for k, (_, counts) in COUNTERS.items() if names & set(counts)))

    def holds(self, counts: Counts) -> np.ndarray:
        return eval(self.rejects, {"__builtins__": {}}, counts)  # noqa: S307 - the rule's own text


#: The base rules: too few words, and too many of them repeated.
BASE = (Rule("few_words", "n_words < 20"), Rule("repeats", "100 * n_repeat_words > 30 * n_words"))
#: Rules beside them: shares that ordinary prose of any language stays well below, and the mean length of a word.
RULES = (
    *BASE,
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 15 * n_words"),
    Rule("bare_words", "5 * n_bare > n_words"),
    Rule("capitals", "2 * n_capitals > word_chars"),
    Rule("stutters", "5 * n_stutters > n_words"),
    Rule("same_lines", "2 * n_dup_lines > n_lines"),
    Rule("cut_lines", "10 * n_cut_lines > 3 * n_lines"),
    Rule("lists", "10 * n_bullets > 9 * n_lines"),
)


class Slice:
    """Counts of a run of texts, made when a rule first asks for them and only for the texts that are still in."""

    def __init__(self, texts: list[bytes]):
        self.texts, self.made, self.counts = texts, set(), {}

    def need(self, counter: str, at: np.ndarray) -> None:
        if counter not in self.made:
            self.made.add(counter)
            for name, values in COUNTERS[counter][0]([self.texts[k] for k in at]).items():
                self.counts[name] = np.zeros(len(self.texts), np.int64)
                self.counts[name][at] = values

    def kept(self, rules: Sequence[Rule], at: np.ndarray | None = None) -> np.ndarray:
        """The texts (of those `at`) that no rule rejects; a rule reads only what the rules before it have left."""
        at = np.arange(len(self.texts)) if at is None else at
        for rule in rules:
            if not len(at):
                break
            for counter in rule.of:
                self.need(counter, at)
            at = at[~rule.holds({k: v[at] for k, v in self.counts.items()})]
        return at


@dataclass(frozen=True)
class Estimate:
    """Seconds a counter takes per sampled byte, and how many sampled texts each set of rules rejects."""

    seconds: dict[str, float]
    rejected: dict[frozenset[str], int]


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, seed: int = 5) -> Estimate:
    """Costs and rejections on about `rows` random texts of at most `chars` characters each, measured in the tasks; a number per
    counter and per set of rules that reject together comes to the driver."""
    ship(docs.sparkSession)
    short = texts_of(docs).where(F.length("text") <= chars)
    share = min(1.0, rows / max(1, docs.count()))
    sample = short.where(F.rand(seed) < share) if share < 1 else short

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, seconds, masks = 0, Counter(), Counter()
        for _, texts in slices(batches):
            every, whole = np.arange(len(texts)), Slice(texts)
            for name, (counter, _) in COUNTERS.items():
                if not size:
                    counter(texts[:1])  # the first call of a worker also loads code
                began = time.perf_counter()
                whole.need(name, every)
                seconds[name] += time.perf_counter() - began
            size += sum(map(len, texts))
            bits = sum(rule.holds(whole.counts).astype(np.int64) << k for k, rule in enumerate(rules))
            masks.update(np.asarray(bits).tolist())
        keys = [("bytes", 0, float(size)), *((name, 0, s) for name, s in seconds.items()), *(("", mask, float(n)) for mask, n in masks.items())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*keys), (pa.string(), pa.int64(), pa.float64()))], names=["what", "mask", "value"])

    found = sample.mapInArrow(measure, "what string, mask long, value double").groupBy("what", "mask").agg(F.sum("value").alias("value")).collect()
    values = {(r["what"], r["mask"]): r["value"] for r in found}
    size = max(1.0, values.get(("bytes", 0), 0.0))
    rejected = {frozenset(rule.name for k, rule in enumerate(rules) if mask >> k & 1): int(n) for (what, mask), n in values.items() if not what}
    return Estimate({name: values.get((name, 0), 0.0) / size for name in COUNTERS}, rejected)


def cascade(found: Estimate, rules: Sequence[Rule] = RULES, counted: Collection[str] = ()) -> list[Rule]:
    """The rules in order of rejection per cost. Each step takes, among the texts the rules before have left, the rule that rejects
    most per second; a counter that an earlier rule has asked for, or one of `counted`, costs nothing more."""
    left, ready, order, rest = dict(found.rejected), set(counted), [], list(rules)
    while rest:
        total = max(1, sum(left.values()))

        def worth(rule: Rule) -> tuple[float, float, int]:
            cost = sum(found.seconds.get(c, 0.0) for c in rule.of if c not in ready)  # noqa: B023
            gone = sum(n for names, n in left.items() if rule.name in names) / total  # noqa: B023
            return (gone / cost if cost else math.inf if gone else 0.0, -cost, -rules.index(rule))

        best = max(rest, key=worth)
        rest.remove(best)
        order.append(best)
        ready.update(best.of)
        left = {names: n for names, n in left.items() if best.name not in names}
    return order


#: The counts that every row of a report has.
REPORTED = ("words", "symbols", "lines", "repeats")


def report(docs: DataFrame, rules: Sequence[Rule] = RULES, found: Estimate | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and kept of every row of docs (doc_id, text).

    The counts are whole; the rules beside the base rules run as a cascade over what those have left, with the counts at hand for
    nothing, in the order of the estimate (made here without one). The order decides the work only: kept is true where no rule
    rejects. Null and empty texts have no words and fail; null ids and repeated rows are counted like any; an empty table
    gives no rows. A text is read by pieces of 1 MB; its words' hashes, 8 bytes each, are held together."""
    ship(docs.sparkSession)
    base = [r for r in rules if r in BASE]
    order = cascade(found or estimate(docs, rules), [r for r in rules if r not in BASE], REPORTED)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in slices(batches):
            every, whole = np.arange(len(texts)), Slice(texts)
            for counter in REPORTED:
                whole.need(counter, every)
            passed = whole.kept(base)
            failed, kept = np.ones(len(texts), bool), np.zeros(len(texts), bool)
            failed[passed] = False
            kept[whole.kept(order, passed)] = True
            columns = [pa.array(ids, pa.int64()), *(pa.array(whole.counts[c]) for c in names), pa.array(failed), pa.array(kept)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *names, "base_failed", "kept"])

    return texts_of(docs).mapInArrow(score, "doc_id long, " + ", ".join(f"{c} long" for c in names) + ", base_failed boolean, kept boolean")


def keep(docs: DataFrame, rules: Sequence[Rule] = RULES, found: Estimate | None = None) -> DataFrame:
    """The rows of docs that no rule rejects, with all their columns. The whole cascade, base rules too, runs in the estimate's
    order, and a count is made only for the texts that are still in when a rule asks for it."""
    ship(docs.sparkSession)
    order = cascade(found or estimate(docs, rules), rules)
    text = docs.columns.index("text")

    def filtered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, good = 0, np.zeros(batch.num_rows, bool)
            pairs = pa.RecordBatch.from_arrays([pa.array(np.arange(batch.num_rows)), batch.column(text)], names=["row", "text"])
            for rows, texts in slices([pairs]):
                good[at + Slice([t or b"" for t in texts]).kept(order)] = True
                at += len(rows)
            yield batch.filter(pa.array(good))

    return docs.mapInArrow(filtered, docs.schema)


def report_sql(rules: Sequence[Rule] = RULES) -> str:
    """The report over `documents` in DuckDB's SQL."""
    white = r"\x20\x09-\x0D"
    symbols = "[" + "".join(chr(b) for b in SYMBOLS) + "]"
    base = " OR ".join(r.rejects for r in rules if r in BASE)
    rest = " OR ".join(r.rejects for r in rules if r not in BASE) or "false"
    return rf"""WITH texts AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
split AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^{white}]+') AS words FROM texts),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (regexp_matches(line, '\.\.\.[{white}]*$')) AS n_cut_lines,
  count(*) FILTER (regexp_matches(line, '^[{white}]*[-*•]')) AS n_bullets
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM texts) WHERE regexp_matches(line, '[^{white}]') GROUP BY r),
starts AS (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS p FROM split),
windows AS (SELECT r, p, array_to_string(words[p:p + {WINDOW - 1}], ' ') AS w FROM starts),
again AS (SELECT r, p FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) > 1),
covered AS (SELECT r, count(DISTINCT q) AS n_repeat_words FROM (SELECT r, unnest(range(p, p + {WINDOW})) AS q FROM again) GROUP BY r),
counts AS (SELECT doc_id, len(words) AS n_words, length(regexp_replace(text, '[{white}]', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '{symbols}', '', 'g')) AS n_symbols, length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_capitals,
  len(list_filter(words, lambda w: NOT regexp_matches(w, '[A-Za-z\x{{80}}-\x{{10FFFF}}]'))) AS n_bare, len(list_filter(range(2, len(words) + 1), lambda k: words[k] = words[k - 1])) AS n_stutters,
  coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
  coalesce(n_cut_lines, 0) AS n_cut_lines, coalesce(n_bullets, 0) AS n_bullets, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split LEFT JOIN lines USING (r) LEFT JOIN covered USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({base}) AS base_failed, NOT ({base}) AND NOT ({rest}) AS kept FROM counts"""
