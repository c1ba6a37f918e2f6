"""Resampling: checksums, scores and ranks against plain Python."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayledger.llm import resampling
from tests.llm.conftest import SF, odd_rows


def runs_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return len(words), [" ".join(words[k : k + n]) for n in (1, 2, 3) for k in range(len(words) - n + 1)]


def brute(docs, target, buckets=10_000, share=5, least=20):
    bucket = lambda run: zlib.crc32(run.encode()) % buckets
    parts = [(d, *runs_of(t)) for d, t in docs]
    s, t = np.zeros(buckets, int), np.zeros(buckets, int)
    for counts, texts in ((s, [r for *_, r in parts]), (t, [runs_of(x)[1] for x in target])):
        for runs in texts:
            for run in runs:
                counts[bucket(run)] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (int(s.sum()) + buckets) / ((a + 1) * (int(t.sum()) + buckets)))) for a, b in zip(s.tolist(), t.tolist())]
    out = []
    for d, n, runs in parts:
        weight, score = sum(gain[bucket(r)] for r in runs), None
        if d is not None:
            h = int(hashlib.sha256(f"42:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, n, len(runs), weight, score, None])
    fit = sorted((r for r in out if r[1] >= least and r[0] is not None), key=lambda r: (-r[4], r[0]))
    for k, r in enumerate(fit[: share * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, out), key=order)


def order(r):
    return tuple((x is None, x or 0) for x in r)


def shown(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()), key=order)


@given(st.lists(st.binary(max_size=700), max_size=12), st.binary(max_size=5))
@settings(max_examples=200, deadline=None)
def test_checksums_of_joined_parts(parts, last):
    crc = np.array([zlib.crc32(p) for p in parts], np.uint32)
    sizes = np.array([len(p) for p in parts], np.int64)
    moved = resampling.advanced(np.full(len(parts), zlib.crc32(last), np.uint32), sizes) ^ crc
    assert moved.tolist() == [zlib.crc32(last + p) for p in parts]


@given(st.lists(st.text(alphabet=st.sampled_from([*"  \n-aZ9é日"]), max_size=60), max_size=8), st.integers(3, 40), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_runs_whole_and_by_pieces(texts, piece, short):
    was = resampling.PIECE, resampling.SHORT
    resampling.PIECE, resampling.SHORT = piece, short
    try:
        found = [[] for _ in texts]
        for _, owner, bucket in resampling.bucketed([t.encode() for t in texts], 2**32 - 1):
            for k, b in zip(owner.tolist(), bucket.tolist()):
                found[k].append(b)
    finally:
        resampling.PIECE, resampling.SHORT = was
    assert [sorted(f) for f in found] == [sorted(zlib.crc32(r.encode()) % (2**32 - 1) for r in runs_of(t)[1]) for t in texts]


def test_given_documents(spark, ws):
    docs, target = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    found = shown(resampling.resample(docs, target, ws))
    assert found == brute([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert any(r[-1] for r in found)


def test_odd_rows(spark, odd, none, ws):
    target = spark.createDataFrame([(1, "several words in it"), (2, None), (3, "")], "item_id long, text string")
    rows = [(d, t) for d, t, *_ in odd_rows()]
    want = brute(rows, ["several words in it"], share=50, least=5)
    assert shown(resampling.resample(odd, target, ws, per_hundred=50, least_words=5)) == want
    assert resampling.resample(none, target, ws).collect() == []
    assert shown(resampling.resample(odd, target.limit(0), ws)) == brute(rows, [])


@pytest.mark.parametrize(("n", "block", "bits"), [(3000, 64, 4), (500, 7, 10), (40, 1000, 3), (1, 5, 8)])
def test_ranks(spark, ws, n, block, bits):
    rng = random.Random(n)
    values = [rng.choice([-(1 << 63), (1 << 63) - 1, 0, -1, 5, rng.getrandbits(40)]) for _ in range(n)]
    rows = [(k, rng.choice([7, rng.randrange(-50, 50)]), v, k % 5, k // 5) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "name long, score long, id long, part long, row long").repartition(5)
    got = resampling.radix_ranks(df, [("score", True), ("id", False)], ("part", "row"), ws, bits, block).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[2], r[3], r[4]))
    assert [r["name"] for r in sorted(got, key=lambda r: r["rank"])] == [r[0] for r in want]
    assert sorted(r["rank"] for r in got) == list(range(1, n + 1))


def test_ranks_of_equal_keys_are_the_order_of_the_input(spark, ws):
    rows = [(k, 1, 2, 9 - k // 30, k % 30) for k in range(100)]
    df = spark.createDataFrame(rows, "name long, score long, id long, part long, row long").repartition(4)
    got = resampling.radix_ranks(df, [("score", True), ("id", False)], ("part", "row"), ws, block_rows=8).collect()
    assert [r["name"] for r in sorted(got, key=lambda r: r["rank"])] == [r[0] for r in sorted(rows, key=lambda r: r[3:])]
    assert resampling.radix_ranks(df.limit(0), [("score", True)], ("part", "row"), ws).collect() == []
