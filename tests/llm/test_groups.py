"""Near-duplicates: fingerprints, vectors and components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quayledger.llm import simhash, vectors
from quayledger.llm.shared import components
from tests.llm.conftest import SF, Sets, odd_rows


def fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(texts):
    marks, sets = [(d, fingerprint(t)) for d, t in texts], Sets()
    named = [(d, m) for d, m in marks if d is not None]
    for k, (d, m) in enumerate(named):
        sets.find(d)
        for e, n in named[:k]:
            if (m ^ n).bit_count() <= 3:
                sets.join(d, e)
    return sorted((d if d is not None else 10**9, f"{m:016x}", sets.find(d) if d is not None else None) for d, m in marks)


def shown(df):
    return sorted((r["doc_id"] if r["doc_id"] is not None else 10**9, r["fingerprint"], r["component_id"]) for r in df.collect())


def test_groups_of_documents(spark, ws):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert shown(simhash.near_duplicates(docs, ws)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_groups_of_odd_rows(odd, none, ws):
    assert shown(simhash.near_duplicates(odd, ws)) == brute([r[:2] for r in odd_rows()])
    assert simhash.near_duplicates(none, ws).collect() == []
    kept = simhash.one_of_each(odd, ws)
    assert kept.columns == odd.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in brute([r[:2] for r in odd_rows()]) if c is not None})
    assert ids.count(None) == 2


def test_dense_keys_are_split_without_losing_links(spark, ws):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    marks = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(300)}
    rows = [(k, int(np.uint64(m).view(np.int64))) for k, m in enumerate(sorted(marks))]
    keyed = spark.createDataFrame(rows, "node long, mark long").withColumn("key", F.explode(simhash.ring_keys(F.col("mark"))))
    edges = simhash.dealt(keyed, ws, 16, "mark").select("key", "i", "j", "mark", "node").mapInArrow(simhash.block_links, "a long, b long")
    got, want = Sets(), Sets()
    pairs = edges.collect()
    for r in pairs:
        got.join(r["a"], r["b"])
    values = sorted(marks)
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= 3:
                want.join(a, b)
    assert all((values[r["a"]] ^ values[r["b"]]).bit_count() <= 3 for r in pairs)
    assert [got.find(k) for k in range(len(values))] == [want.find(k) for k in range(len(values))]


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_marks_within_three_bits_share_a_key_and_pass_the_ring(spark, bits):
    rng = random.Random(bits)
    rows = []
    for _ in range(400):
        a = rng.getrandbits(64)
        rows.append((int(np.uint64(a).view(np.int64)), int(np.uint64(a ^ sum(1 << b for b in rng.sample(range(64), bits))).view(np.int64))))
    df = spark.createDataFrame(rows, "a long, b long").select(F.arrays_overlap(simhash.ring_keys(F.col("a")), simhash.ring_keys(F.col("b"))).alias("x"))
    assert all(r["x"] for r in df.collect())
    x = np.array([a ^ b for a, b in rows], np.int64).view(np.uint64)
    assert simhash.ring_links(x).all()


def test_components(spark, ws):
    rng = random.Random(1)
    chain = [(k, k + 1) for k in range(200)]
    shuffled = list(range(1000, 1300))
    rng.shuffle(shuffled)
    star = [(5000, 5000 + k) for k in range(1, 300)]
    loose = [(rng.randrange(6000, 6400), rng.randrange(6000, 6400)) for _ in range(250)]
    pairs = [*chain, *zip(shuffled, shuffled[1:]), *star, *loose, (7000, 7000), (-3, 9000)]
    want = Sets()
    for a, b in pairs:
        want.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long"), ws).collect()}
    assert got == {x: want.find(x) for x in want.up if want.find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long"), ws).collect() == []


def near(rows, cosine=0.95):
    sets, links = Sets(), {k: 0 for k in range(len(rows))}
    unit = []
    for i, v in rows:
        ok = i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    for a in range(len(rows)):
        sets.find(a)
        for b in range(a):
            if unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                sets.join(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[sets.find(k)] = min(i, least.get(sets.find(k), i))
    return sorted(((i if i is not None else -1), links[k], least[sets.find(k)] if i is not None else -1) for k, (i, _) in enumerate(rows))


def test_rows_of_one_id_are_told_apart(spark, ws):
    v, w = np.eye(8)[0], np.eye(8)[1]
    rows = [(1, v), (1, w), (2, v + 0.1), (4, w + 0.1), (5, w - 0.1), (1, v), (9, -v), (9, -v), (7, w + 0.1), (6, -v)]
    rows = [(i, x.tolist()) for i, x in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.near_vectors(df, ws, recall=0.99999).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got) == near(rows)


def test_vectors_at_the_recall_in_use(spark, ws):
    rng = np.random.default_rng(4)
    rows, edge = [], np.tan(np.arccos(0.952))
    for k in range(700):  # pairs just above the least cosine
        x, y = rng.standard_normal((2, 32))
        x /= np.linalg.norm(x)
        y -= (x @ y) * x
        rows += [(2 * k, x.tolist()), (2 * k + 1, (x + edge * y / np.linalg.norm(y)).tolist())]
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ws).collect()}
    want = {i: n for i, n, _ in near(rows)}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.99 * sum(want.values())


def test_vectors(spark, ws):
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(16)
    rows = [(k, (centre + 0.1 * rng.standard_normal(16)).tolist()) for k in range(150)]
    rows += [(200 + k, rng.standard_normal(16).tolist()) for k in range(150)]
    rows += [(400 + k, rows[160][1]) for k in range(60)]
    rows += [(500, None), (501, []), (502, [0.0] * 16), (503, [1.0, None]), (504, [float("nan")] * 3), (505, [float("inf"), 1.0]), (None, [1.0, 2.0]), (506, [1.0, 2.0]), (507, [-0.0, 1.0]), (508, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vectors.near_vectors(df, ws, recall=0.99999, block=16).collect()
    assert sorted((r["vec_id"] if r["vec_id"] is not None else -1, r["n_links"], r["component_id"] if r["component_id"] is not None else -1) for r in got) == near(rows)
    assert all(r["kept"] == (r["vec_id"] is not None and r["vec_id"] == r["component_id"]) for r in got)
    assert vectors.near_vectors(df.limit(0), ws).collect() == []
