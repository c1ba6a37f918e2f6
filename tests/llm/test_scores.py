"""Classifiers: held-out accuracy on the given labels, and odd rows."""

import random
import re
import time

import numpy as np
import pytest

from quayledger.llm import quality, toxicity
from quayledger.llm.toxicity import INSULT, NEGATION, OTHER, REPORT, TARGET, THREAT

LABELLED = "/root/testdata/sf0.01"


@pytest.mark.parametrize(("method", "label", "folds", "least"), [(quality, "quality", 5, 0.9), (toxicity, "toxic", 4, 0.85)])
def test_held_out_accuracy(spark, method, label, folds, least):
    docs, labels = (spark.read.parquet(f"{LABELLED}/{t}.parquet") for t in ("documents", "labels"))
    rows = method.with_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r[label] for r in rows) >= least * len(rows)


@pytest.mark.parametrize("method", [quality, toxicity])
def test_odd_rows(spark, odd, none, method):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (None, 1, 1), (6, None, None), (7, 1, 0), (8, 1, 0), (99, 0, 1), (5, 0, 1)], "doc_id long, quality int, toxic int")
    got = method.with_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] is not None for r in got)
    empty = [r["score"] for r in got if r["doc_id"] in (3, 4)]
    assert empty[0] == empty[1]
    assert method.with_scores(none, labels).collect() == []
    alone = method.with_scores(odd, labels.limit(0)).collect()
    assert {round(r["score"], 6) for r in alone} == {0.5} or all(0.2 < r["score"] < 0.8 for r in alone)


def test_kept_rows_are_those_that_score(spark, odd):
    labels = spark.createDataFrame([(1, 1), (3, 0), (7, 1), (8, 0)], "doc_id long, quality int")
    kept = quality.keep_good(odd, labels)
    good = [r["doc_id"] for r in quality.with_scores(odd, labels).where("predicted = 1").collect()]
    key = lambda x: (x is None, x or 0)
    assert kept.schema == odd.schema and sorted((r["doc_id"] for r in kept.collect()), key=key) == sorted(good, key=key)


def test_clauses():
    w = lambda *kinds: toxicity.transduce([(k, 2.0 if k == INSULT else 0.0) for k in kinds])
    assert w(OTHER, INSULT) == [(toxicity.PLAIN, 2.0)]
    assert w(TARGET, OTHER, INSULT) == w(INSULT, OTHER, TARGET) == [(toxicity.AIMED_AT, 2.0)]
    assert w(TARGET, NEGATION, OTHER, INSULT) == [(toxicity.NEGATED, 2.0)]
    assert w(REPORT, TARGET, INSULT) == [(toxicity.REPORTED, 2.0)]
    assert w(THREAT, TARGET) == [(toxicity.THREATENED, 1.0)]
    assert w(THREAT) == w(TARGET, OTHER) == []


def test_scores_do_not_depend_on_neighbours(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    net = quality.fit(quality.labelled.sample(docs, labels, "quality", 5, 0, 200, 65_536), passes=2)
    texts = [r["text"].encode() for r in docs.limit(60).collect()] + [b"", b"x", b"De De De De De De De De De De De De"]
    together, alone = quality.scores(net, texts), [quality.scores(net, [t])[0] for t in texts]
    assert abs(together - alone).max() < 1e-5


def brute_matches(symbols):
    """Every insult and threat, by looking at each word around it."""
    out = []
    for i, (s, weight) in enumerate(symbols):
        before = lambda kind, n: any(x == kind for x, _ in symbols[max(0, i - n) : i])
        aimed = before(TARGET, toxicity.AIMED) or any(x == TARGET for x, _ in symbols[i + 1 : i + 1 + toxicity.AIMED])
        if s == INSULT or s == THREAT and aimed:
            plain = toxicity.THREATENED if s == THREAT else toxicity.AIMED_AT if aimed else toxicity.PLAIN
            kind = toxicity.NEGATED if before(NEGATION, toxicity.NEAR) else toxicity.REPORTED if before(REPORT, toxicity.WITHIN) else plain
            out.append((kind, weight if s == INSULT else 1.0))
    return out


def test_composed_transducers_find_what_enumeration_finds():
    rng = random.Random(3)
    for _ in range(600):
        symbols = [(s, round(rng.random(), 3) if s == INSULT else 0.0) for s in rng.choices(range(6), weights=[8, 1, 1, 1, 1, 1], k=rng.randrange(40))]
        assert toxicity.transduce(symbols) == brute_matches(symbols)


def test_features_are_those_of_all_clauses():
    rng, grammar = random.Random(4), toxicity.Grammar({w: 3.0 for w in toxicity.INSULTS})
    matcher = toxicity.Matcher(grammar)
    words = ["idiot", "idiots", "kill", "you", "Tú", "not", "said", "house", "skill", "walk", '"', "töten"]
    for _ in range(200):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ". ", "\n", "; ", ", "]) for _ in range(rng.randrange(50)))
        matches = [brute_matches([matcher.symbol(w) for w in toxicity.WORD.findall(c)]) for c in re.split(r"[.!?;:\n]", text.lower())]
        sums = np.zeros(6)
        for m in matches:
            for kind, weight in m:
                sums[kind] += weight
            sums[5] = max(sums[5], sum(w * (0.2 if k in (toxicity.NEGATED, toxicity.REPORTED) else 1.5 if k == toxicity.AIMED_AT else 1) for k, w in m))
        n = sum(map(len, matches))
        assert np.allclose(matcher.features(text), [*np.log1p(sums), n > 0, 1000 * n / (len(text) + 200)])


@pytest.mark.parametrize("text", ["I will kill you", "ich werde dich töten", "te voy a matar", "je vais te frapper"])
def test_threats_with_the_target_on_either_side(text):
    assert toxicity.Matcher(toxicity.Grammar()).features(text)[toxicity.THREATENED] > 0


def test_time_grows_with_the_text_alone():
    matcher = toxicity.Matcher(toxicity.Grammar({"idiot": 3.0}))
    spent = []
    for n in (20_000, 80_000):
        began = time.process_time()
        matcher.features("such an idiot, he is\n" * n)
        spent.append(time.process_time() - began)
    assert spent[1] < 9 * spent[0]


def brute_network(net, text):
    """The score by loops over windows, half chunks and chunks."""
    step, taps, half = quality.STEP, quality.TAPS, quality.HALF
    width = step * half
    halves = max(2, -(-(len(text) + step * taps) // width))
    data = text.ljust(halves * width + step * taps, b"\0")
    tops, echo = np.zeros((halves, quality.FILTERS)), np.zeros(halves)
    flat = net.filters.reshape(-1, quality.FILTERS)
    for h in range(halves):
        for k in range(half - (taps - 1 if h == halves - 1 else 0)):
            at = (h * half + k) * step
            x = np.concatenate([net.numbers[b] for b in data[at : at + step * taps]])
            tops[h] = np.maximum(tops[h], x @ flat + net.bias)
        for at in range(h * width, (h + 1) * width):
            eight = data[at : at + 8]
            echo[h] += any(at >= g and data[at - g : at - g + 8] == eight for g in quality.ECHO) and any(eight)
    echo /= width
    chunks = [(np.maximum(tops[h], tops[h + 1]), max(echo[h], echo[h + 1])) for h in range(halves - 1)]
    f = np.concatenate([np.max([c for c, _ in chunks], 0), np.mean([c for c, _ in chunks], 0), [max(e for _, e in chunks), np.mean([e for _, e in chunks])]])
    return 1 / (1 + np.exp(-(f @ net.weights + net.base)))


def test_network_against_loops_over_bytes(monkeypatch):
    rng = random.Random(9)
    numbers = np.random.default_rng(9)
    shapes = {"numbers": (256, quality.DEPTH), "filters": (quality.TAPS, quality.STEP * quality.DEPTH, quality.FILTERS), "bias": (quality.FILTERS,), "weights": (2 * quality.FILTERS + 2,)}
    net = quality.Network(base=0.1, **{k: (0.3 * numbers.standard_normal(s)).astype(np.float32) for k, s in shapes.items()})
    texts = [b"", b"a", b"ab ab ab ab ab ab ab ab", *(" ".join(rng.choices(["one", "two", "straße", "buy now", "la la la la la la"], k=n)).encode() for n in (3, 30, 120, 400))]
    want = [brute_network(net, t) for t in texts]
    for piece in (1, 3, 512):
        monkeypatch.setattr(quality, "PIECE", piece)
        assert np.allclose(quality.scores(net, texts), want, atol=1e-5)
