"""As-of forms against brute force, with ties, nulls, hot keys and small buckets."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quayledger.operators.asof import asof_join, dated_steps, lookup_step
from quayledger.operators.ordered import previous_row
from quayledger.operators.parts import sampled_parts

START = datetime(2025, 1, 1)


def moments(rng, n, span_hours):
    return [START + timedelta(minutes=rng.randrange(0, span_hours * 60, 30)) for _ in range(n)]


def tables(spark, seed):
    rng = random.Random(seed)
    key = lambda: rng.choice(["hot", "hot", "hot", "a", "b", None])
    left = [(i, key(), t if rng.random() > 0.05 else None) for i, t in enumerate(moments(rng, 200, 400))]
    right = [(key(), t if rng.random() > 0.05 else None, rng.randrange(5)) for t in moments(rng, 60, 400)]
    return (
        left,
        right,
        spark.createDataFrame(left, "id int, k string, ts timestamp_ntz"),
        spark.createDataFrame(right, "k string, ts timestamp_ntz, v int"),
    )


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("part_rows", [None, 1, 7, 10**6])
def test_asof_join_matches_brute_force(spark, direction, part_rows):
    left, right, ldf, rdf = tables(spark, 7)
    out = asof_join(ldf, rdf, "ts", ["k"], ["v"], direction=direction, part_rows=part_rows)
    found = {r.id: r.v for r in out.collect()}
    assert len(found) == len(left) and out.columns == ["id", "k", "ts", "v"]
    for i, k, ts in left:
        hits = [(t, v) for rk, t, v in right if k and ts and rk == k and t]
        hits = [h for h in hits if (h[0] <= ts if direction == "backward" else h[0] >= ts)]
        best = (max(hits) if direction == "backward" else min(hits)) if hits else (None, None)
        assert found[i] == best[1], (i, k, ts)


def test_lookup_step_matches_brute_force(spark):
    rng = random.Random(3)
    days = [date(1985, 1, 1) + timedelta(days=rng.randrange(50000)) for _ in range(300)]
    prices = [(rng.choice("ab"), rng.choice(days), rng.randrange(100)) for _ in range(25)]
    left = [(i, rng.choice(["a", "b", "c", None]), d) for i, d in enumerate(days)]
    steps = dated_steps(spark.createDataFrame(prices, "s string, d date, p int"), "s", "d", ["p"])
    df = spark.createDataFrame(left, "id int, s string, day date")
    out = lookup_step(df, steps, F.col("s"), F.col("day"), {"p": "price"}).collect()
    assert len(out) == len(left)
    for r in out:
        hits = [(d, p) for s, d, p in prices if s == r.s and d <= r.day]
        assert r.price == (max(hits)[1] if hits else None), r


def test_both_forms_agree(spark):
    rng = random.Random(11)
    days = [date(2025, 1, 1) + timedelta(days=rng.randrange(400)) for _ in range(200)]
    prices = [(rng.choice("abc"), rng.choice(days), rng.randrange(9)) for _ in range(30)]
    left = spark.createDataFrame([(i, rng.choice("abcd"), d) for i, d in enumerate(days)], "id int, s string, d date")
    right = spark.createDataFrame(prices, "s string, d date, p int")
    one = lookup_step(left, dated_steps(right, "s", "d", ["p"]), F.col("s"), F.col("d"), {"p": "p"})
    two = asof_join(left, right, "d", ["s"], ["p"])
    assert sorted(one.collect()) == sorted(two.collect())


@pytest.mark.parametrize("part_rows", [1, 7, 10**6])
def test_previous_row_matches_brute_force(spark, part_rows):
    left, _, ldf, _ = tables(spark, 5)
    out = {r.id: r for r in previous_row(ldf, "k", ["ts", "id"], ["id", "ts"], part_rows=part_rows).collect()}
    assert len(out) == len(left)
    for i, k, ts in left:
        if k is None or ts is None:
            assert (out[i].previous_id, out[i].occurrence) == (None, None)
            continue
        before = sorted((t, j) for j, kk, t in left if kk == k and t and (t, j) < (ts, i))
        assert out[i].occurrence == len(before) + 1
        assert out[i].previous_id == (before[-1][1] if before else None)
        assert out[i].previous_ts == (before[-1][0] if before else None)


def hot_rows(n=40_000):
    """Half of the rows lie in one hour of one key, a fifth at one instant of it, the rest over 500 keys."""
    rng = random.Random(8)
    rows = []
    for i in range(n):
        if i % 2:
            second = 1800 if i % 5 == 0 else rng.randrange(3600)
            rows.append((i, "it's \\ hot", START + timedelta(seconds=second)))
        else:
            rows.append((i, f"k{rng.randrange(500)}", START + timedelta(seconds=rng.randrange(10**6))))
    return rows


def test_a_hot_hour_is_cut_into_ranges_of_like_size(spark):
    df = spark.createDataFrame(hot_rows(), "id int, k string, ts timestamp_ntz")
    rows = df.select(F.col("k").alias("_key"), F.col("ts").alias("_o0"), F.xxhash64("id").alias("_tie"))
    part = sampled_parts(rows, ["_key", "_o0", "_tie"], 1000)
    sizes = sorted(r["count"] for r in rows.groupBy(part.alias("p")).count().collect())
    assert len(sizes) == 40 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    # Parts are ranges of the position: no part begins before the one below it ends.
    place = F.struct("_key", "_o0", "_tie")
    ends = rows.groupBy(part.alias("p")).agg(F.min(place).alias("least"), F.max(place).alias("most")).orderBy("p").collect()
    assert all(a.most <= b.least for a, b in zip(ends, ends[1:]))


def test_carried_states_over_many_ranges_of_one_key(spark):
    rows = hot_rows(6000)
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp_ntz").repartition(5)
    out = {r.id: r for r in previous_row(df, "k", ["ts", "id"], ["id"], part_rows=60).collect()}
    by_key = {}
    for i, k, ts in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        before = by_key.setdefault(k, [])
        assert (out[i].previous_id, out[i].occurrence) == (before[-1] if before else None, len(before) + 1)
        before.append(i)
    # One hit of the hot key serves all ranges after it, or before it.
    hits = spark.createDataFrame([("it's \\ hot", START + timedelta(seconds=100), 1), ("it's \\ hot", START + timedelta(seconds=3400), 2)], "k string, ts timestamp_ntz, v int")
    for direction, want in (("backward", lambda s: 2 if s >= 3400 else 1 if s >= 100 else None), ("forward", lambda s: 1 if s <= 100 else 2 if s <= 3400 else None)):
        got = asof_join(df, hits, "ts", ["k"], ["v"], direction=direction, part_rows=60).filter("k like 'it%'").collect()
        assert len(got) == 3000 and all(r.v == want((r.ts - START).seconds) for r in got)


def test_parts_of_other_types_and_of_no_rows(spark):
    kinds = "a decimal(10,2), b date, c boolean, d double, e long"
    rows = [(k / 4, date(2025, 1, 1) + timedelta(days=k % 50), k % 2 == 0, [0.1, float("inf"), float("nan"), None][k % 4], -k) for k in range(300)]
    df = spark.createDataFrame(rows, "a double, b date, c boolean, d double, e long").withColumn("a", F.col("a").cast("decimal(10,2)"))
    for columns in (["a", "e"], ["b", "e"], ["c", "d", "e"]):
        sizes = [r["count"] for r in df.groupBy(sampled_parts(df, columns, 30).alias("p")).count().collect()]
        assert len(sizes) == 10 and max(sizes) <= 60
    none = spark.createDataFrame([], kinds)
    assert none.groupBy(sampled_parts(none, ["a", "b"], 10).alias("p")).count().collect() == []


def test_asof_join_leaves_out_columns_that_no_reader_asks_for(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, None, 5)], "id long, k string, ts long").withColumn("wide", F.repeat(F.lit("unread"), F.col("id").cast("int")))
    right = spark.createDataFrame([("a", 7, 9)], "k string, ts long, v long")
    out = asof_join(left, right, "ts", ["k"], ["v"], direction="forward", part_rows=None, spread=["id"])
    assert {tuple(r) for r in out.collect()} == {(1, "a", 5, "unread", 9), (2, None, 5, "unreadunread", None)}
    plan = out.select("id", "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "unread" not in plan
