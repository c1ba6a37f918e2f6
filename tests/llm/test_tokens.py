"""Tokens: packing and token files against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayledger.llm import binary, packing, tokens
from quayledger.llm.shared import WORKER_MEMORY
from quayledger.llm.tokens import vocabulary_path, words_of
from tests.llm.conftest import SF, odd_rows


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    return lambda text, end: np.array(t.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@given(st.text(alphabet=st.sampled_from([*" \n\t\r\0aB.,é'1ß日᠎\x85\xa0-"]), max_size=40))
@settings(max_examples=300, deadline=None)
def test_words_give_the_ids_of_the_whole_text(text):
    words = words_of(None)
    assert words.encode(text) == untouched(text)


def untouched(text):
    """The library's own ids, by a tokenizer that nothing else has touched."""
    from tokenizers import Tokenizer

    global _own
    _own = _own or Tokenizer.from_file(vocabulary_path())
    return np.array(_own.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_own = None


def test_added_tokens_are_the_librarys():
    words = words_of(None)
    assert np.frombuffer(words.encode("a<|endoftext|>b"), "<u4").tolist() == [64, 50256, 65]
    texts = ["a<|endoftext|>b", "plain one", " <|endoftext|> ", "<|endoftext", "|>", "", "one  two", "x <|endoftext|> y\nz"]
    assert words.encode_all([t.encode() for t in texts]) == [untouched(t) for t in texts]


@given(st.lists(st.text(alphabet=st.sampled_from([*" \n aB.,é÷×1ßж日"]), max_size=60), max_size=9), st.integers(1, 40), st.integers(0, 400))
@settings(max_examples=200, deadline=None)
def test_runs_and_a_small_cache_give_the_same_ids(texts, run, cache):
    was = tokens.RUN_BYTES, tokens.CACHE_BYTES
    tokens.RUN_BYTES, tokens.CACHE_BYTES = run, cache
    try:
        assert words_of(None).encode_all([t.encode() for t in texts]) == [untouched(t) for t in texts]
    finally:
        tokens.RUN_BYTES, tokens.CACHE_BYTES = was


def test_words_of_any_length_and_a_full_cache():
    words = words_of(None)
    text = " ".join(["x" * n for n in (1, 63, 64, 65, 1000)] * 2 + [f"word{k}" for k in range(3000)])
    for _ in range(3):
        assert words.encode(text) == untouched(text)
    assert len(words.keys) > 3000 and (np.diff(words.keys.astype(float)) >= 0).all()


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=30))
@settings(max_examples=200, deadline=None)
def test_plan_places_every_piece_once_without_gaps(counts):
    rows, made = packing.plan(counts, 64, 8, 0.3)
    places, ranks = defaultdict(list), defaultdict(list)
    for n, first, last, sequence, offset in rows:
        ranks[n] += range(first, last)
        for k in range(last - first):
            places[sequence + k].append((offset, n))
    assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in counts.items()}
    assert len(places) == made
    for content in places.values():
        at = 0
        for offset, n in sorted(content):
            assert offset == at
            at += n
        assert at <= 64


def test_plan_is_close_to_the_least():
    rng = random.Random(3)
    counts = defaultdict(int)
    for _ in range(50_000):
        counts[min(2048, int(rng.expovariate(1 / 700)) + 1)] += 1
    _, made = packing.plan(dict(counts))
    assert made <= 1.005 * -(-sum(n * c for n, c in counts.items()) // 2048)


def check_packed(rows, texts, whole, capacity):
    expected = defaultdict(int)
    for doc, text in texts:
        ids = whole(text, 0)
        first = (len(ids) - 1) % capacity + 1
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].tobytes()] += 1
    got = defaultdict(int)
    sequences = defaultdict(list)
    for r in rows:
        got[r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])] += 1
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got == expected
    for content in sequences.values():
        content.sort()
        assert [o for o, _ in content] == [sum(n for _, n in content[:k]) for k in range(len(content))]
        assert sum(n for _, n in content) <= capacity


def test_packing(spark, ws, whole):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check_packed(packing.pack(docs, ws).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()], whole, 2048)


def test_packing_sends_texts_in_small_batches_to_lean_workers(spark, ws, odd, monkeypatch):
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, save = spark.conf.get(rows), [], ws.save
    monkeypatch.setattr(ws, "save", lambda df, name: (seen.append(int(spark.conf.get(rows))), save(df, name))[1])
    packing.pack(odd, ws)
    assert seen and max(seen) <= 1000
    assert spark.conf.get(rows) == before
    assert set(WORKER_MEMORY) <= set(spark.sparkContext.environment)


def test_packing_of_odd_rows(odd, none, ws, whole):
    check_packed(packing.pack(odd, ws, capacity=512).collect(), [r[:2] for r in odd_rows()], whole, 512)
    assert packing.pack(none, ws).collect() == []


@given(st.lists(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=700), max_size=6))
@settings(max_examples=60, deadline=None)
def test_file_round_trip_and_random_access(texts):
    ids = [np.array(t, "<u4") for t in texts]
    f = binary.TokenFile(binary.encode_file([None if k == 1 else k for k in range(len(ids))], ids))
    flat = np.concatenate([np.zeros(0, "<u4"), *ids])
    assert [f.token(k) for k in range(0, len(flat), 3)] == flat[::3].tolist()
    for k, t in enumerate(ids):
        assert (f.ids(int(f.starts[k]), int(f.starts[k + 1])) == t).all()
    assert f.ids(0, len(flat)).tolist() == flat.tolist()


@pytest.mark.parametrize("file_tokens", [500, 4_000_000])
def test_token_files(spark, ws, whole, file_tokens):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected, start = {}, 0
    for r in docs.orderBy("doc_id").collect():
        ids = whole(r["text"], 2)
        expected[r["doc_id"]] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = binary.token_files(docs, ws, file_tokens=file_tokens).collect()
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in got} == expected


def test_token_files_of_odd_rows(odd, none, ws, whole):
    rows = sorted(((i, t or "") for i, t in (r[:2] for r in odd_rows())), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    expected, start = [], 0
    for doc, text in rows:
        ids = whole(text, 2)
        expected.append((start, doc, len(ids), ids.tobytes()))
        start += len(ids)
    assert sorted((r["start"], r["doc_id"], r["n_tokens"], bytes(r["ids"])) for r in binary.token_files(odd, ws).collect()) == expected
    assert binary.token_files(none, ws).collect() == []


@given(st.dictionaries(st.integers(1, 2048), st.integers(1, 60), max_size=60))
@settings(max_examples=40, deadline=None)
def test_no_more_sequences_than_best_fit_decreasing(counts):
    rooms, made = [], 0
    for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
        fit = min((r for r in rooms if r >= n), default=None)
        if fit is None:
            made += 1
            rooms.append(2048 - n)
        else:
            rooms[rooms.index(fit)] -= n
    assert packing.best_plan(counts)[1] <= made


def test_rows_of_one_id_are_many_tasks_work(spark, ws):
    rows = [(None, f"{k:05d} words of text number {k}") for k in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    # Tasks this small would be put together again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        files = binary.write_files(docs, ws.path("tokens")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["part"] for r in files}) > 1
