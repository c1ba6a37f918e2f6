"""Toxicity by a weighted finite-state grammar over clauses: insults, threats, targets, negation, reported speech."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayledger.llm import labelled
from quayledger.llm.shared import ship, slices, texts_of

#: Labelled rows of each class to fit on, and the most characters of one.
SAMPLE_ROWS, SAMPLE_CHARS = 3000, 65_536

INSULTS = "idiot moron loser scum stupid pathetic worthless disgusting trash clown".split()
THREATS = "kill hurt destroy punish beat burn shoot stab crush töten umbringen tuer frapper matar golpear".split()
TARGETS = "you your yours u he she him her they them their du dich dir ihr euch sie vous tu toi te usted ustedes tú ti".split()
NEGATIONS = "not no never isn't aren't don't nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = "said says wrote writes called calls claimed quoted sagte schrieb nannte dit écrit appelé dijo escribió llamó".split()

#: Input symbols of the clause transducers.
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = SYMBOLS = range(6)
#: Words that a negation, a target and a report reach.
NEAR, AIMED, WITHIN = 3, 6, 12
#: Marks that the transducers write on a word.
IS_NEGATED, IS_AIMED, IS_REPORTED = 1, 2, 4
#: What a matched clause counts as: plain, aimed at someone, negated, reported, threat.
PLAIN, AIMED_AT, NEGATED, REPORTED, THREATENED = range(5)

WORD = re.compile(r"[^\W_]+(?:'[^\W_]+)?|[\"“”„«»]")
CLAUSE = re.compile(r"[.!?;:\n]")


@dataclass
class Grammar:
    """Weights of insult stems, and of what the matched clauses of a text add up to."""

    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(8))
    base: float = 0.0


@dataclass(frozen=True)
class Transducer:
    """A deterministic one: from each state, by the symbol read, the next state and the marks written. It starts in state 0."""

    steps: tuple[tuple[tuple[int, int], ...], ...]

    def marks(self, symbols: Iterable[int]) -> Iterator[int]:
        state = 0
        for symbol in symbols:
            state, mark = self.steps[state][symbol]
            yield mark


def reaching(opening: int, words: int, mark: int) -> Transducer:
    """Writes its mark on as many words after each opening symbol; the state is how many it still reaches."""
    return Transducer(tuple(tuple((words if symbol == opening else max(0, left - 1), mark if left else 0) for symbol in SYMBOLS) for left in range(words + 1)))


def composed(first: Transducer, second: Transducer) -> Transducer:
    """Both at once: pairs of states, as far as they can be reached, and both marks."""
    pairs, steps = [(0, 0)], []
    number = {(0, 0): 0}
    for a, b in pairs:  # grows while it is read
        row = []
        for symbol in SYMBOLS:
            (next_a, mark_a), (next_b, mark_b) = first.steps[a][symbol], second.steps[b][symbol]
            if (pair := (next_a, next_b)) not in number:
                number[pair] = len(pairs)
                pairs.append(pair)
            row.append((number[pair], mark_a | mark_b))
        steps.append(tuple(row))
    return Transducer(tuple(steps))


#: Read from the left: negation, report and target before a word. Read from the right: a target after it.
TARGETED = reaching(TARGET, AIMED, IS_AIMED)
FORWARD = composed(composed(reaching(NEGATION, NEAR, IS_NEGATED), reaching(REPORT, WITHIN, IS_REPORTED)), TARGETED)


def kind_of(symbol: int, marks: int) -> int | None:
    """What a marked word counts as: an insult always counts, a threat only with a target on either side."""
    if symbol != INSULT and (symbol != THREAT or not marks & IS_AIMED):
        return None
    if marks & (IS_NEGATED | IS_REPORTED):
        return NEGATED if marks & IS_NEGATED else REPORTED
    return THREATENED if symbol == THREAT else AIMED_AT if marks & IS_AIMED else PLAIN


#: The last transducer has one state: by symbol and marks, the kind that it writes.
KINDS = tuple(tuple(kind_of(symbol, marks) for marks in range(8)) for symbol in SYMBOLS)


def transduce(symbols: list[tuple[int, float]]) -> list[tuple[int, float]]:
    """(kind, weight) of every match in a clause's symbols, each word marked from the left and from the right; a threat weighs 1."""
    ahead = list(TARGETED.marks(s for s, _ in reversed(symbols)))
    out = []
    for (symbol, weight), left, right in zip(symbols, FORWARD.marks(s for s, _ in symbols), reversed(ahead)):
        if (kind := KINDS[symbol][left | right]) is not None:
            out.append((kind, weight if symbol == INSULT else 1.0))
    return out


class Matcher:
    """A grammar made ready: an automaton finds the words that can start a match, and only their clauses are transduced."""

    def __init__(self, grammar: Grammar):
        self.grammar = grammar
        self.find = ahocorasick.Automaton()
        for stem in {*grammar.stems, *THREATS}:
            self.find.add_word(stem, len(stem))
        self.any = len(self.find) > 0
        self.find.make_automaton()
        self.fixed = {w: (s, 0.0) for s, ws in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, [*REPORTS, *'"“”„«»']), (THREAT, THREATS)) for w in ws}
        self.longest = max(map(len, grammar.stems), default=0)
        self.shortest = min(map(len, grammar.stems), default=1)

    def symbol(self, word: str) -> tuple[int, float]:
        for n in range(min(self.longest, len(word)), self.shortest - 1, -1):
            if (weight := self.grammar.stems.get(word[:n])) is not None:
                return INSULT, weight
        return self.fixed.get(word, (OTHER, 0.0))

    def features(self, text: str) -> np.ndarray:
        """Sums by kind of match, the heaviest clause, any match at all, matches by text length. Time grows with the text alone."""
        out, text = np.zeros(8), text.lower()
        done = heaviest = matches = 0
        for end, size in self.find.iter(text) if self.any else ():
            start = end - size + 1
            if start < done or start and text[start - 1].isalnum():
                continue
            first = max(done, max(text.rfind(c, done, start) for c in ".!?;:\n") + 1)
            last = found.start() if (found := CLAUSE.search(text, end)) else len(text)
            done = last
            matched = transduce([self.symbol(w.group()) for w in WORD.finditer(text, first, last)])
            for kind, weight in matched:
                out[kind] += weight
            matches += len(matched)
            heaviest = max(heaviest, sum(w * (0.2 if k in (NEGATED, REPORTED) else 1.5 if k == AIMED_AT else 1) for k, w in matched))
        out[5], out[6], out[7] = heaviest, matches > 0, 1000 * matches / (len(text) + 200)
        return np.append(np.log1p(out[:6]), out[6:])

    def score(self, text: str) -> float:
        z = float(self.features(text) @ self.grammar.weights + self.grammar.base)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def learn_stems(rows: list[tuple[str, int]], least: float = 0.01, precision: float = 0.97) -> dict[str, float]:
    """Word beginnings that stand in toxic texts and hardly in others, with the logarithm of their odds.

    The shortest beginning that is precise enough is lengthened for as long as one next letter covers it."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    number = [1, 1]
    for text, label in dict.fromkeys(rows):
        number[label] += 1
        seen[label].update({w[:n] for w in set(WORD.findall(text.lower())) for n in range(3, min(len(w), 11) + 1)})
    clean, toxic = seen
    enough = max(4, least * number[1])
    odds = {p: (c + 0.1) / number[1] / ((clean[p] + 0.1) / number[0]) for p, c in toxic.items() if c >= enough}
    good = {p for p, x in odds.items() if x / (1 + x) >= precision}
    stems = {}
    for p in good:
        if p[:-1] in good:
            continue
        while longer := [q for q in (x for x in good if len(x) == len(p) + 1 and x.startswith(p)) if toxic[q] >= 0.95 * toxic[p]]:
            p = longer[0]
        stems[p] = math.log(odds[p])
    return stems


def fit(rows: list[tuple[bytes, int]]) -> Grammar:
    """Learn stems and weights; without rows of both classes the given insults count and the score is the label's share."""
    decoded = [(x.decode(), y) for x, y in rows]
    share = sum(y for _, y in rows) / len(rows) if rows else 0.5
    if not rows or not 0 < share < 1:
        return Grammar({w: 3.0 for w in INSULTS}, np.zeros(8), math.log((share + 1e-3) / (1 - share + 1e-3)))
    learnt = learn_stems(decoded)
    grammar = Grammar({w: 3.0 for w in INSULTS} | learnt)
    matcher = Matcher(grammar)
    x = np.array([[*matcher.features(t), 1.0] for t, _ in decoded])
    y, w = np.array([v for _, v in decoded], float), np.zeros(9)
    ridge = np.diag([0.3] * 8 + [1e-3])
    for _ in range(30):  # Newton steps of the ridge logistic regression
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
    return Grammar(grammar.stems, w[:8], float(w[8]))


def with_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.3, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (doc_id, text); labels are (doc_id, toxic).

    The grammar is fitted on a bounded sample of labelled rows outside the held-out fold. Null and empty texts have no
    match and get the score of a text without any; a null doc_id is scored and not held out; repeated rows are scored
    alike; with no labels of one class every score is the other's share."""
    ship(docs.sparkSession)
    grammar = fit(labelled.sample(docs, labels, "toxic", folds, held_out, rows, chars))

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(grammar)
        for ids, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([matcher.score(t.decode()) for t in texts], pa.float64())], names=["doc_id", "score"])

    out = texts_of(docs).mapInArrow(score, "doc_id long, score double")
    held = F.coalesce(labelled.fold("doc_id", folds) == held_out, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
