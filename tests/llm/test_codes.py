"""Vector codes against a plain loop in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

from quayledger.llm import codes


def brute(rows, parts, entries, rounds, scale, most):
    """rows: (vec_id, vector, label) of one length."""
    kept = [(i, [max(-most, min(most, math.floor(scale * x))) if abs(x) < 1e300 else int(math.copysign(most, x)) for x in v], t) for i, v, t in rows]
    n = len(kept[0][1])
    bounds = [k * n // parts for k in range(parts + 1)]
    least = sorted(zip(kept, [r[1] for r in rows]), key=lambda r: (r[0][0] is None, r[0][0] or 0, r[1]))[:entries]
    out, books = [["", 0] for _ in kept], []
    for a, b in zip(bounds, bounds[1:]):
        book = [r[1][a:b] for r, _ in least]
        near = lambda v: min((sum((x - y) ** 2 for x, y in zip(v[a:b], e)), k) for k, e in enumerate(book))  # noqa: B023, E731
        for _ in range(rounds):
            to = [near(v)[1] for _, v, _ in kept]
            for k in range(len(book)):
                if mine := [v[a:b] for (_, v, _), at in zip(kept, to) if at == k]:
                    book[k] = [sum(c) // len(mine) for c in zip(*mine)]
        for row, (_, v, _) in zip(out, kept):
            away, k = near(v)
            row[0] += f"{k:02x}"
            row[1] += away
        books += [x for e in book for x in e]
    sha = hashlib.sha256(",".join(map(str, books)).encode()).hexdigest()
    return [(i, code, error, sum(e for (*_, u), (_, e) in zip(kept, out) if u == t), sha) for (i, _, t), (code, error) in zip(kept, out)]


def shown(rows):
    return sorted((r["vec_id"] is None, r["vec_id"] or 0, r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in rows)


def expected(rows, parts=8, entries=16, rounds=6, scale=4096.0):
    out = []
    for length in {len(v) for _, v, _ in rows}:
        out += brute([r for r in rows if len(r[1]) == length], parts, entries, rounds, scale, math.isqrt((2**63 - 1) // max(1, length)) // 2)
    labels = {}
    for (i, code, error, _, sha), (_, _, t) in zip(out, [r for length in {len(v) for _, v, _ in rows} for r in rows if len(r[1]) == length]):
        labels.setdefault(t, []).append((i, code, error, sha))
    return sorted((i is None, i or 0, code, error, sum(x[2] for x in mine), sha) for mine in labels.values() for i, code, error, sha in mine)


SCHEMA = "vec_id long, embedding array<float>, label int, code string, length int, entry string"


@pytest.mark.parametrize(("n", "length"), [(150, 16), (9, 8), (60, 13), (20, 3)])
def test_codes_equal_the_loop(spark, ws, n, length):
    rng = random.Random(n)
    vectors = [[rng.choice([rng.gauss(0, 0.2), 0.25, -0.25, 0.0]) for _ in range(length)] for _ in range(n)]
    vectors = [np.array(v, np.float32).tolist() for v in vectors + vectors[:3]]
    rows = [(k * 7 % 50, v, rng.choice([None, 1, 2])) for k, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    assert shown(codes.compress(df, ws).rows.collect()) == expected(rows)


def test_odd_vectors(spark, ws):
    good = [(k, [k / 8, -k / 4, 0.5, 1.0, 2.0, -1.5, 0.1, 0.2], None if k % 2 else 3) for k in range(5)]
    good = [(i, np.array(v, np.float32).tolist(), t) for i, v, t in good] + [(None, [0.0] * 8, None), (9, [1.0] * 4, 3), (9, [], None), (10, [3e38] * 8, 5), (10, [-3e38] * 8, 5)]
    bad = [(20, None, 1), (21, [None] + [0.0] * 7, 1), (22, [math.nan] * 8, 1), (23, [math.inf] * 8, None)]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in good + bad], SCHEMA)
    found = codes.compress(df, ws)
    rows = found.rows.collect()
    assert len(rows) == len(good)
    big = sum(r["error"] for r in rows if r["label"] == "5")
    assert {r["label_error"] for r in rows if r["label"] == "5"} == {big if big < 2**63 else None}
    assert shown(r for r in rows if r["label"] != "5") == [r for r in expected(good) if r[1] != 10]
    assert set(found.books) == {0, 4, 8}
    assert codes.compress(df.limit(0), ws).rows.collect() == []


def test_a_hot_label_and_a_vector_that_a_third_of_the_rows_repeat(spark, ws):
    rng = random.Random(3)
    rows = [(k, [0.5, -0.5] * 4 if k % 3 else [rng.gauss(0, 1) for _ in range(8)], 1 if k % 5 else k) for k in range(900)]
    rows = [(i, np.array(v, np.float32).tolist(), t) for i, v, t in rows]
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(7)
    assert shown(codes.compress(df, ws).rows.collect()) == expected(rows)
