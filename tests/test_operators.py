import random
import re
from datetime import date, timedelta
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from checks import oracle
from quayledger.functions import numbers, rates, text
from quayledger.operators import allocate, pairs, quality, reconcile, rollup, views

START = date(2025, 1, 1)


def test_dirty_numbers(spark):
    df = spark.createDataFrame([("1.5",), (" 2 ",), ("",), (None,), ("x",), ("-3.25",)], "c string")
    out = [str(r[0]) for r in df.select(numbers.to_tonnes(F.col("c"))).collect()]
    assert out == ["1.500", "2.000", "0.000", "0.000", "0.000", "-3.250"]
    kilos = spark.createDataFrame([("1,234,567",), ("89",)], "c string")
    assert [str(r[0]) for r in kilos.select(numbers.kilos_to_tonnes(F.col("c"))).collect()] == ["1234.567", "0.089"]
    counts = spark.createDataFrame([("-12",), ("7",), ("",)], "c string")
    assert [r[0] for r in counts.select(numbers.outgoing_count(F.col("c"))).collect()] == [-12, -7, 0]
    assert [r[0] for r in counts.select(numbers.to_count(F.col("c"))).collect()] == [-12, 7, 0]


def test_text(spark):
    names = spark.createDataFrame([("INPESCA S.A",), ("CFTO S.A.",), ("ALBACORA SA",), ("SAPMER",), ("SALT SA X",)], "c string")
    out = [r[0] for r in names.select(text.short_company(F.col("c"))).collect()]
    assert out == ["INPESCA", "CFTO", "ALBACORA", "SAPMER", "SALT SA X"]
    species = spark.createDataFrame([("Skipjack - 1 - 2",), ("Mixed",)], "c string")
    assert [r[0] for r in species.select(text.species_name(F.col("c"))).collect()] == ["Skipjack", None]
    remarks = spark.createDataFrame([("a/ rain",), ("a/ OT 5 / two men",), ("plain",), ("a/ OT only",)], "c string")
    assert [r[0] for r in remarks.select(text.remark_detail(F.col("c"))).collect()] == ["rain", "two men", None, None]


def test_standard_price_is_exact(spark):
    df = spark.createDataFrame([("Mon",), ("Sun",), ("PH",)], "day string")
    cell = lambda v, t: F.lit(v).cast(t)
    price = rates.standard_price(
        F.col("day"), cell("10.000", "decimal(18,3)"), cell("4.000", "decimal(18,3)"), cell("2.500", "decimal(12,3)")
    )
    assert [r[0] for r in df.select(price).collect()] == [Decimal(30), Decimal("42.5"), Decimal("42.5")]


def test_allocation_keeps_the_total(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "a", None]), rng.randrange(1, 50)) for _ in range(100)]
    df = spark.createDataFrame(rows, "g string, w int")
    counted = allocate.with_group_totals(df, ["g"], {"t": F.col("w")})
    assert counted.count() == len(rows)
    shared = counted.withColumn("s", allocate.share(F.col("w"), F.col("t"), F.lit(77.7)))
    for r in shared.groupBy("g").agg(F.sum("s").alias("s")).collect():
        assert r.s == pytest.approx(77.7)
    zero = spark.createDataFrame([(0, 0)], "w int, t int")
    assert zero.select(allocate.share(F.col("w"), F.col("t"), F.lit(5))).collect()[0][0] == 0.0


@pytest.mark.parametrize("part_rows", [3, 40, 10**6])
def test_shares_sum_to_the_total(spark, part_rows):
    rng = random.Random(2)
    totals = {"hot": "1000.01", "a": "-7.77", "b": "0.05", "zero": "9.00", None: "3.33"}
    rows = [(i, k, None if k == "zero" or rng.random() < 0.1 else rng.choice([0, 1, 7, 250, -3])) for i in range(400) for k in [rng.choice(["hot", "hot", "hot", "a", "b", "zero", None])]]
    rows += [(1000 + i, f"one{i}", 5) for i in range(30)]
    data = [(i, k, Decimal(w) / 10 if w is not None else None, Decimal(totals.get(k, "0.07"))) for i, k, w in rows]
    df = spark.createDataFrame(data, "id int, k string, w decimal(9,1), total decimal(12,2)").repartition(6)
    out = allocate.shared_out(df, ["k"], ["id"], "w", "total", name="share", part_rows=part_rows).collect()
    assert len(out) == len(rows)
    sums, shares = {}, {r.id: r.share for r in out}
    for i, k, w in rows:
        sums.setdefault(k, []).append((i, w or 0))
    for k, mine in sums.items():
        total, whole = int(Decimal(totals.get(k, "0.07")) * 100), sum(w for _, w in mine)
        if whole <= 0:
            assert all(shares[i] == 0 for i, _ in mine)
            continue
        assert sum(shares[i] for i, _ in mine) == Decimal(total) / 100
        half_up = lambda c: (1 if total * c >= 0 else -1) * ((2 * abs(total * c) + whole) // (2 * whole))  # noqa: B023, E731
        so_far = 0
        for i, w in sorted(mine):
            assert shares[i] * 100 == half_up(so_far + w) - half_up(so_far)
            so_far += w


def test_fallback_lookup_takes_the_finest_level(spark):
    rng = random.Random(6)
    pick = lambda names: rng.choice([*names, None])
    facts = [(i, pick("abcd"), pick("xyz"), rng.choice("pq")) for i in range(80)]
    logged = [(pick("abe"), pick("xw"), rng.choice([None, 1, 2, 5])) for _ in range(12)]
    levels = [["k", "m"], ["m"], ["k"]]
    table = reconcile.grains(spark.createDataFrame(logged, "k string, m string, v int"), levels, {"v": F.sum("v"), "n": F.count("*")})
    df = spark.createDataFrame(facts, "id int, k string, m string, c string")
    out = reconcile.fallback_lookup(df.union(df.filter("id < 9")), levels, table, ["v", "n"])
    assert out.columns == ["id", "k", "m", "c", "v", "n"]
    rows = out.collect()
    found = {r.id: tuple(r)[1:] for r in rows}
    assert len(found) == len(facts) and len(rows) == len(facts) + 9
    for i, k, m, c in facts:
        want = {"v": None, "n": None}
        for keys in levels:
            at = dict(k=k, m=m)
            mine = [r for r in logged if all(at[x] is not None and r["km".index(x)] == at[x] for x in keys)]
            sums = [r[2] for r in mine if r[2] is not None]
            want["v"] = want["v"] if want["v"] is not None or not sums else sum(sums)
            want["n"] = want["n"] or len(mine) or None
        assert found[i] == (k, m, c, want["v"], want["n"])


def test_three_way_keeps_the_tonnage(spark):
    rows = [("a", "x", "5.000"), ("b", "x", "7.000"), ("b", "y", "3.000"), ("c", "x", "4.000"), ("e", "x", "0.000"), ("e", "y", "0.000")]
    kinds = "k string, s string, t string"
    one = spark.createDataFrame(rows, kinds).withColumn("t", F.col("t").cast("decimal(18,3)"))
    more = [("b", "x", "2.000"), ("b", "z", "1.001"), ("c", "x", "4.000"), ("d", "x", "9.000"), ("e", "x", "1.001")]
    two = spark.createDataFrame(more, kinds).withColumn("t", F.col("t").cast("decimal(18,3)"))
    out = reconcile.three_way(one, two, ["k"], ["t"], ["s"])
    sums = {r.k: str(r.t) for r in out.groupBy("k").agg(F.sum("t").alias("t")).collect()}
    assert sums == {"a": "5.000", "b": "10.000", "c": "4.000", "d": "9.000", "e": "0.000"}
    left = sorted((r.k, r.s, str(r.t)) for r in out.exceptAll(two).collect())
    assert left == [("a", "x", "5.000"), ("b", "x", "4.899"), ("b", "y", "2.100"), ("e", "x", "-0.501"), ("e", "y", "-0.500")]


def test_difference_report(spark):
    one = spark.createDataFrame([("a", 5), ("a", 1), ("b", 7), ("c", 1)], "k string, t int")
    two = spark.createDataFrame([("a", 6), ("b", 9)], "k string, t int")
    assert [tuple(r) for r in reconcile.difference_report(one, two, ["k"], "t").collect()] == [("b", 7, 9, -2)]
    more = two.union(spark.createDataFrame([("d", 4), ("e", 0)], "k string, t int"))
    lost = reconcile.difference_report(one, more, ["k"], "t", both=False).collect()
    assert sorted(map(tuple, lost)) == [("b", 7, 9, -2), ("c", 1, 0, 1), ("d", 0, 4, -4)]


def test_three_way_drops_what_is_left_of_nothing(spark):
    kinds = "k string, s string, t string"
    cast = lambda rows: spark.createDataFrame(rows, kinds).withColumn("t", F.col("t").cast("decimal(18,3)"))
    out = reconcile.three_way(cast([("a", "x", "2.000"), ("a", "y", "4.000")]), cast([("a", "x", "6.000")]), ["k"], ["t"], ["s"])
    assert [tuple(map(str, r)) for r in out.collect()] == [("a", "x", "6.000")]


def test_the_oracle_drops_residuals_of_zero():
    """By-catch whose transfers take all of it away leaves no line in the oracle either."""
    con = duckdb.connect()
    columns = "DATE '2025-01-01' AS date, 'Mon' AS day, 'IN' AS movement_type, 'C' AS customer, 'V' AS vessel, 'op' AS operation_type"
    for name, tonnes in (("catch_in", (2, 4)), ("catch_moved", (6,))):
        rows = " UNION ALL ".join(f"SELECT {columns}, 's{k}' AS storage_type, {t}::DECIMAL(18,3) AS total_tonnage, 0::DECIMAL(18,3) AS overtime_tonnage" for k, t in enumerate(tonnes))
        con.execute(f"CREATE TABLE {name} AS {rows}")
    assert con.execute(f"SELECT total_tonnage FROM ({oracle.STEPS['catch_lines']})").fetchall() == [(Decimal("6.000"),)]


@pytest.mark.parametrize("kinds", [False, True])
def test_roll_up_periods_matches_brute_force(spark, kinds):
    rng = random.Random(9)
    pick = lambda: rng.choice(["hot", "hot", "a", "b", None])
    periods = []
    for i in range(60):
        first = START + timedelta(days=rng.randrange(200))
        periods.append((i, pick(), first, first + timedelta(days=rng.randrange(-2, 70)) if rng.random() > 0.1 else None))
    periods += [(60, "hot", START, date(9999, 12, 31)), (61, "a", date(1, 1, 1), date(9999, 12, 31))]
    periods.append(periods[-1])  # equal periods give as many rows
    services = [(pick(), START + timedelta(days=rng.randrange(220)), rng.choice("xy"), rng.randrange(1, 9)) for _ in range(300)]
    extra = ["kind"] if kinds else []
    out = rollup.roll_up_periods(
        spark.createDataFrame(periods, "id int, k string, first date, last date"),
        spark.createDataFrame(services, "s string, d date, kind string, t int"),
        by=[("k", "s")], start="first", end="last", service_date="d", sums={"t": "t"}, days_name="days",
        extra_keys=extra,
    ).collect()
    expected = {}
    for i, k, first, last in periods:
        hits = [x for x in services if k and x[0] == k and last and first <= x[1] <= last]
        groups = {(x[2] if kinds else None) for x in hits} or {None}
        for g in groups:
            mine = [x for x in hits if not kinds or x[2] == g]
            expected[i, g] = (sum(x[3] for x in mine) if mine else None, len({x[1] for x in mine}))
    assert {(r.id, r.kind if kinds else None): (r.t, r.days) for r in out} == expected
    assert len(out) == len(expected) + sum(i == 61 for i, _ in expected)


def test_history_before_and_earlier_rows(spark):
    rng = random.Random(4)
    day = lambda: START + timedelta(days=rng.randrange(300))
    left = [(i, rng.choice(["hot", "hot", "a", None]), day()) for i in range(80)]
    log = [(rng.choice(["hot", "hot", "a", None]), day(), rng.choice("pq")) for _ in range(90)]
    ldf = spark.createDataFrame(left, "id int, k string, d date")
    gdf = spark.createDataFrame(log, "g string, gd date, kind string")
    out = rollup.history_before(ldf, gdf, by="k", on="d", log_by="g", log_on="gd", details=["kind"]).collect()
    pairs = rollup.earlier_rows(ldf, gdf, by="k", on="d", log_by="g", log_on="gd").collect()
    for r in out:
        hits = [(d, kind) for g, d, kind in log if r.k and g == r.k and d <= r.d]
        assert r.earlier == len(hits)
        assert (r.latest, r.latest_kind) == (max(hits) if hits else (None, None))
        assert r.first == (min(hits)[0] if hits else None)
        assert sorted((p.gd, p.kind) for p in pairs if p.id == r.id and p.gd) == sorted(hits)
    assert len(out) == len(left)


def test_container_status(spark):
    # MSKU6011672 and CSQU3054383 carry right check digits.
    numbers_ = ["MSKU6011672", " CSQU3054383 ", "CSQU3054384", "csqu3054383", "CSQU305438", "", None]
    df = spark.createDataFrame([(n,) for n in numbers_], "c string")
    out = [r[0] for r in df.select(quality.container_status(F.col("c"))).collect()]
    assert out == ["ok", "ok", "check digit", "format", "length", "length", "length"]
    report = {r.status: (r.rows, r.numbers) for r in quality.container_report(df.union(df), "c").collect()}
    assert report["ok"] == (4, 2)


def test_check_digit_of_every_letter(spark):
    # Letter values of the container code.
    values = dict(zip("ABCDEFGHIJKLMNOPQRSTUVWXYZ", [10, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 23, 24, 25, 26,
                                                     27, 28, 29, 30, 31, 32, 34, 35, 36, 37, 38]))
    codes = [(letter + "ABC1234560",) for letter in values]
    df = spark.createDataFrame(codes, "c string")
    for r in df.select("c", quality.check_digit(F.col("c")).alias("d")).collect():
        weights = [values[x] if x in values else int(x) for x in r.c[:10]]
        assert r.d == sum(v * 2**i for i, v in enumerate(weights)) % 11 % 10


def test_rules_split_rows(spark):
    df = spark.createDataFrame([(1, "a"), (-1, "a"), (None, " ")], "n int, t string")
    rules = {"n": F.col("n") >= 0, "t": quality.not_blank(F.col("t"))}
    valid, rejected = quality.split_valid(df, rules)
    assert valid.collect() == [(1, "a")]
    assert sorted(r.errors for r in rejected.collect()) == [["n"], ["n", "t"]]


def test_names(spark):
    df = spark.createDataFrame([(" collection ",), ("Delivery",), ("other",), (None,)], "c string")
    out = [r[0] for r in df.select(quality.canonical_name(F.col("c"), ["Collection", "Delivery"])).collect()]
    assert out == ["Collection", "Delivery", None, None]
    with pytest.raises(Exception, match="not a listed name"):
        df.select(quality.require_name(F.col("c"), ["Delivery"])).collect()
    listed = spark.createDataFrame([("Delivery",), ("Delivery",)], "n string")
    known, unknown = quality.split_listed(df, "c", listed, "n")
    assert (known.count(), unknown.count()) == (1, 3)


def test_views(spark):
    df = spark.createDataFrame([(START, "a", 1), (START + timedelta(days=40), "b", 2)], "date date, k string, start_date int")
    out = views.view(df, where=[views.member("k", ["a", "b"])], period=(START, START), select=["k"]).collect()
    assert out == [("a",)]
    assert views.view(df, order=[F.desc("k")], limit=1).collect()[0].k == "b"
    assert views.columns_like(df, "date") == ["date", "start_date"]
    assert views.latest_date(df).collect()[0][0] == START + timedelta(days=40)


def test_pairs_of_a_hot_key_are_dealt_over_tasks(spark):
    """Equal to a plain left join, also for null keys, keys of one side and equal rows, and no task makes most of the pairs."""
    rng = random.Random(4)
    key = lambda: rng.choice(["hot"] * 8 + ["a", "b", "c", None])
    left = spark.createDataFrame([(key(), rng.choice([1, 1, None]), i // 2) for i in range(400)], "k string, d int, v int")
    right = spark.createDataFrame([(rng.choice(["hot"] * 8 + ["a", "e", None]), 1, i // 3) for i in range(300)], "k string, d int, w int")
    out = pairs.left_pairs(left, right, ["k", "d"], pair_rows=500)
    plain = left.join(right, ["k", "d"], "left")
    assert out.columns == plain.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    made = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(made) < sum(made) / 4


def test_whole_rows_of_a_fallback_lookup_are_spread(spark):
    levels = [["k", "m"], ["k"]]
    df = spark.range(2000).select("id", (F.col("id") % 50).alias("k"), (F.col("id") % 7).alias("m"))
    table = reconcile.grains(df, levels, {"n": F.count("*")})
    copies = reconcile._copies(df, levels, table)
    assert copies.count() == 3 * 2000 and copies.filter("_row is not null").count() == 2000
    assert copies.groupBy("_level", "_key").count().agg(F.max("count")).first()[0] <= 40
    assert [r.n for r in reconcile.fallback_lookup(df, levels, table, ["n"]).select("n").distinct().orderBy("n").collect()] == [5, 6]


def _lookup_case(spark):
    rng = random.Random(9)
    rows = [(i // 2, rng.choice(["hot"] * 6 + ["a", "b", None]), rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None])) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k string, m string, v int")
    return rows, df, [["k", "m"], ["m"], ["k"]]


def test_a_fallback_lookup_shuffles_whole_rows_and_no_copies(spark):
    """Copies of a row under its hash, written twice, took 12 times the disk of the rows. What finds its values leaves the chain, in a join that
    reads the same shuffle as the chain itself."""
    _, df, levels = _lookup_case(spark)
    key, limit = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    try:
        # A column that the reader drops must not part the two readers of a shuffle.
        out = reconcile.fallback_lookup(df, levels, reconcile.grains(df, levels, {"n": F.sum("v")}), ["n"]).drop("m")
        done = out._jdf.queryExecution()
        assert "Generate" not in done.optimizedPlan().toString()
        done.toRdd().count()
        plan = done.executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set(key, limit)
    # Per level: one shuffle of sums, one of what they come to, one of the rows that are left; both readers of the first two levels share them.
    shuffles = [line for line in plan.splitlines() if re.search(r"[-+:] Exchange ", line)]
    assert len(shuffles) == 3 * len(levels)
    assert plan.count("ReusedExchange") >= 4


def test_rows_without_a_key_of_a_fallback_lookup_are_spread(spark):
    df = spark.range(2000).select("id", F.lit(None).cast("string").alias("k"), F.when(F.col("id") < 0, "m").alias("m"))
    table = reconcile.grains(df.select(F.lit("a").alias("k"), F.lit("b").alias("m")), [["k", "m"], ["k"]], {"n": F.count("*")})
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = reconcile.fallback_lookup(df, [["k", "m"], ["k"]], table, ["n"])
        made = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(made) == 2000 and max(made) < 800


def test_fallback_lookup_keeps_equal_rows_and_each_value_falls_back_alone(spark):
    rows, df, levels = _lookup_case(spark)
    table = reconcile.grains(df, levels, {"s": F.sum("v"), "n": F.count("*")}).withColumn("n", F.when(F.col("n") > 60, F.col("n")))
    out = reconcile.fallback_lookup(df, levels, table, ["s", "n"]).collect()

    def first(row, take):
        for keys in levels:
            own = [row["idkmv".index(c) - 1] for c in keys]
            if None in own:
                continue
            mine = [r for r in rows if [r["idkmv".index(c) - 1] for c in keys] == own]
            if (value := take(mine)) is not None:
                return value
        return None

    total = lambda mine: sum(r[3] for r in mine if r[3] is not None) if any(r[3] is not None for r in mine) else None
    many = lambda mine: len(mine) if len(mine) > 60 else None
    want = [(*r, first(r, total), first(r, many)) for r in rows]
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, want))


def test_pairs_of_one_left_row_are_dealt_over_tasks(spark):
    """A left row's pairs with all rows of its key stood in one task's memory; they are made chunk by chunk."""
    left = spark.createDataFrame([("hot", 1), ("lone", 2), (None, 3), (None, 3)], "k string, v int")
    right = spark.range(20_000).select(F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 50 == 1, "else").otherwise("hot").alias("k"), F.col("id").alias("w"))
    out = pairs.left_pairs(left, right, ["k"], pair_rows=1000)
    plain = left.join(right, ["k"], "left")
    assert out.columns == plain.columns and out.dtypes == plain.dtypes
    assert sorted(map(str, out.collect())) == sorted(map(str, plain.collect()))
    made = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(made) < sum(made) / 2


def test_pairs_in_small_chunks_and_blocks_equal_a_plain_join(spark):
    rng = random.Random(11)
    left = spark.createDataFrame([(rng.choice(["hot", "hot", "a", "b", None]), i // 2) for i in range(120)], "k string, v int")
    right = spark.createDataFrame([(rng.choice(["hot", "hot", "a", "c", None]), i // 3) for i in range(150)], "k string, w int")
    plain = sorted(map(str, left.join(right, ["k"], "left").collect()))
    for pair_rows, chunk_rows in ((10, 7), (100, 1), (1, 1000), (10**9, 10**9)):
        out = pairs.left_pairs(left, right, ["k"], pair_rows=pair_rows, chunk_rows=chunk_rows)
        assert sorted(map(str, out.collect())) == plain
    assert pairs.left_pairs(left.filter("false"), right, ["k"]).count() == 0
    assert sorted(map(str, pairs.left_pairs(left, right.filter("false"), ["k"]).collect())) == sorted(map(str, left.join(right.filter("false"), ["k"], "left").collect()))
