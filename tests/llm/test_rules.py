"""Quality rules: counts and verdicts against plain Python, and the cascade's order."""

import random
import re
from collections import Counter

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayledger.llm import rules
from tests.llm.conftest import SF, odd_rows

WHITE = " \t\n\v\f\r"


def counted(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_bare": sum(not any(ord(c) >= 128 or c.isalpha() for c in w) for w in words),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_capitals": sum("A" <= c <= "Z" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_cut_lines": sum(x.rstrip(WHITE).endswith("...") for x in lines),
        "n_bullets": sum(x.lstrip(WHITE).startswith(("-", "*", "•")) for x in lines),
        "n_repeat_words": len({k + j for k, w in enumerate(windows) if w in often for j in range(8)}),
        "n_stutters": sum(a == b for a, b in zip(words, words[1:])),
    }


def expected(doc_id, text):
    c = counted(text)
    failed = c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]
    rest = (
        10 * c["n_symbols"] > c["n_words"], c["word_chars"] < 2 * c["n_words"], c["word_chars"] > 15 * c["n_words"], 5 * c["n_bare"] > c["n_words"],
        2 * c["n_capitals"] > c["word_chars"], 5 * c["n_stutters"] > c["n_words"], 2 * c["n_dup_lines"] > c["n_lines"],
        10 * c["n_cut_lines"] > 3 * c["n_lines"], 10 * c["n_bullets"] > 9 * c["n_lines"],
    )
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return (doc_id is None, doc_id or 0, *(c[n] for n in names), failed, not failed and not any(rest))


def shown(df):
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:]) for r in df.collect())


TEXT = st.text(alphabet=st.sampled_from([*"  \n\t\r\x1c\x85\xa0aAbé日#*|.-•1"]), max_size=60)


@given(st.lists(TEXT, max_size=6), st.sampled_from([4, 1 << 20]))
@settings(max_examples=200, deadline=None)
def test_counts(texts, piece):
    texts = [*texts, *(t * 6 for t in texts)]
    was, rules.PIECE = rules.PIECE, piece
    try:
        made = {}
        for counter, names in rules.COUNTERS.values():
            found = counter([t.encode() for t in texts])
            assert set(found) == set(names)
            made |= found
    finally:
        rules.PIECE = was
    for k, text in enumerate(texts):
        assert {n: int(v[k]) for n, v in made.items()} == counted(text)


def test_report_of_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert shown(rules.report(docs)) == sorted(expected(r["doc_id"], r["text"]) for r in docs.collect())


def test_odd_rows(odd, none):
    want = [expected(*r[:2]) for r in odd_rows()]
    assert shown(rules.report(odd)) == sorted(want)
    kept = rules.keep(odd)
    assert kept.schema == odd.schema
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == sorted(w[:2] for w in want if w[-1])
    assert rules.report(none).collect() == rules.keep(none).collect() == []


def test_every_rule_alone_rejects_in_python_and_in_sql(spark):
    words = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60))
    texts = {
        "": words, "few_words": "some words", "repeats": " ".join(f"{words.split()[k]}" for k in [*range(12)] * 3), "symbols": words.replace(" w", " #w"), "short_words": " ".join("abcdefghijklmnopqrst"[k % 20] for k in random.Random(2).choices(range(20), k=60)),
        "long_words": words.replace("word", "word" * 4), "bare_words": re.sub(r"word(.) ", r"\1 ... ", words.replace("word", "")) + " 1. 22. 33. 4; 5? 6! 7_ 8- 9= 10+ 11/ 12@ 13~ 14^ 15' 16,", "capitals": words.upper(),
        "stutters": " ".join(w for w in words.split() for _ in "12"), "same_lines": "\n".join([*words.split()[:25], *["again"] * 2, *["aga in"] * 2] + [f"x{'yz' * k}" for k in range(2)] * 25), "cut_lines": words.replace(" ", "...\n", 30), "lists": "\n".join(f"- {w}" for w in words.split()),
    }
    for name, text in texts.items():
        whole = rules.Slice([text.encode()])
        for counter in rules.COUNTERS:
            whole.need(counter, rules.np.arange(1))
        hit = {r.name for r in rules.RULES if r.holds(whole.counts)[0]}
        assert (name in hit) if name else not hit
    rows = [(k, t) for k, t in enumerate(texts.values())]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted((False, *r) for r in con.execute(rules.report_sql()).fetchall()) == shown(rules.report(spark.createDataFrame(rows, "doc_id long, text string")))


def test_order_by_rejection_per_cost():
    few, repeats, symbols, capitals = (next(r for r in rules.RULES if r.name == n) for n in ("few_words", "repeats", "symbols", "capitals"))
    seconds = {"words": 4.0, "symbols": 1.0, "capitals": 1.0, "lines": 1.0, "repeats": 8.0}
    # Both symbols and capitals count the words first; after symbols, few_words is free and capitals has nothing left to reject.
    rejected = {frozenset(): 60, frozenset({"capitals", "symbols"}): 19, frozenset({"symbols"}): 1, frozenset({"few_words"}): 12, frozenset({"repeats"}): 8}
    order = rules.cascade(rules.Estimate(seconds, rejected), (few, repeats, symbols, capitals))
    assert [r.name for r in order] == ["symbols", "few_words", "repeats", "capitals"]
    # repeats needs its words and the count of words, which is at hand here.
    order = rules.cascade(rules.Estimate(seconds, rejected), (repeats, symbols), ("words", "repeats"))
    assert [r.name for r in order] == ["repeats", "symbols"]


def test_a_rule_reads_only_what_is_left(monkeypatch):
    seen = []
    counter, names = rules.COUNTERS["repeats"]
    monkeypatch.setitem(rules.COUNTERS, "repeats", (lambda texts: seen.append(len(texts)) or counter(texts), names))
    few, repeats = rules.BASE
    texts = [b"two words", b"word " * 30, " ".join(map(str, range(30))).encode()]
    assert rules.Slice(texts).kept([few, repeats]).tolist() == [2] and seen == [2]


def test_the_order_does_not_change_the_verdict(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    verdicts = []
    for seconds in ({"words": 1.0, "repeats": 9.0}, {"words": 9.0, "lines": 5.0, "symbols": 7.0}):
        found = rules.Estimate(seconds, {frozenset(): 5, frozenset({"symbols", "repeats"}): 3, frozenset({"lists"}): 2})
        verdicts.append((shown(rules.report(docs, found=found)), sorted(r["doc_id"] for r in rules.keep(docs, found=found).collect())))
    assert verdicts[0] == verdicts[1] and verdicts[0][1] == [r[1] for r in verdicts[0][0] if r[-1]]


@pytest.mark.parametrize("size", [70_000, 1_500_000])
def test_a_word_of_any_length(size):
    text = (b"x" * size + b" ") * 3 + b"y" * size + b" " + b"x" * size
    found = rules.count_repeats([text, b"x x"])
    assert found["n_stutters"].tolist() == [2, 1] and found["n_repeat_words"].tolist() == [0, 0]
    assert rules.count_words([text])["word_chars"].tolist() == [5 * size]
