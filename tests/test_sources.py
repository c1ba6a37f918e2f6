from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.queries import registered_queries
from quayledger.functions.numbers import KINDS, to_tonnes, unreadable
from quayledger.operators import quality
from quayledger.plans import registry
from quayledger.sources import sinks
from quayledger.sources.catalog import (
    LISTED,
    RESCUED,
    SCHEMAS,
    Inputs,
    require_listed,
    split_listed_rows,
    with_sheet_headers,
)
from quayledger.sources.inline import inline_table

from checks.derived import DerivedInputs

from .conftest import SF_DIR


def test_registry_has_the_groups_and_datasets():
    assert len(registry.DATASETS) == 8
    assert sum(len(g) for g in registry.DATASETS.values()) == 27


def test_derived_tables_have_the_catalog_schema(spark):
    derived = DerivedInputs(spark, SF_DIR)
    for name in SCHEMAS:
        empty = spark.createDataFrame([], SCHEMAS[name])
        found = {(f.name, f.dataType.simpleString().replace("bigint", "int")) for f in derived[name].schema}
        assert found == {(f.name, f.dataType.simpleString()) for f in empty.schema}, name


def test_files_give_the_same_result(spark, tmp_path):
    derived = DerivedInputs(spark, SF_DIR)
    for name in ("transfer", "price"):
        derived[name].write.option("header", True).csv(f"{tmp_path}/csv/{name}.csv", nullValue="NULL")
        derived[name].write.parquet(f"{tmp_path}/parquet/{name}")
    expected = sorted(registry.build("transfer", derived).collect())
    assert sorted(registry.build("transfer", Inputs(spark, f"{tmp_path}/parquet")).collect()) == expected
    csv = registry.build("transfer", Inputs(spark, f"{tmp_path}/csv", "csv", ".csv")).collect()
    assert len(csv) == len(expected)


def test_listed_columns(spark):
    columns = "container_number string, status string"
    df = spark.createDataFrame([("STDU6536343", "Full"), ("X", None), ("STDU6536338", "Half")], columns)
    kept, refused = split_listed_rows(df, "scow_transfer")
    assert kept.collect() == [("STDU6536343", "Full")]
    assert sorted(r.errors for r in refused.collect()) == [["container_number"], ["status"]]
    assert require_listed(df.limit(1), "scow_transfer").count() == 1
    with pytest.raises(Exception, match="not a listed name: Half"):
        require_listed(df.filter("status = 'Half'"), "scow_transfer").collect()
    for name, columns in LISTED.items():
        assert set(columns) <= {f.split()[0] for f in SCHEMAS[name].split(", ")}


def test_derived_transfers_are_all_listed(spark):
    kept, refused = split_listed_rows(DerivedInputs(spark, SF_DIR)["transfer"], "transfer")
    assert refused.isEmpty() and kept.count() == 6000


def test_sheet_headers_are_renamed(spark):
    df = spark.createDataFrame([("A", 1.0)], "`Service` string, `Price` double")
    assert with_sheet_headers(df, "price").columns == ["service", "price"]
    assert with_sheet_headers(df, "pti").columns == df.columns


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_columns_are_read_by_name(spark, tmp_path, fmt):
    price = DerivedInputs(spark, SF_DIR)["price"]
    sheet = price.select(
        F.col("class").alias("Class"), F.col("date").alias("StartingDate"), F.col("price").alias("Price"),
        F.col("end_date").alias("EndingDate"), F.col("service").alias("Service"), F.lit("x").alias("Note"),
    )
    sheet.write.option("header", True).format(fmt).save(f"{tmp_path}/price")
    got = Inputs(spark, str(tmp_path), fmt, extra={"price": ["Note"]})["price"]
    assert sorted(map(str, got.collect())) == sorted(map(str, price.select(got.columns).collect()))
    with pytest.raises(ValueError, match="unknown ..Note"):
        Inputs(spark, str(tmp_path), fmt)["price"]
    sheet.drop("Price", "Note").write.option("header", True).format(fmt).save(f"{tmp_path}/less/price")
    with pytest.raises(ValueError, match="missing ..price"):
        Inputs(spark, f"{tmp_path}/less", fmt)["price"]


def test_rows_off_their_lists(spark, tmp_path):
    transfer = DerivedInputs(spark, SF_DIR)["transfer"].limit(20)
    transfer.withColumn("status", F.when(F.col("status") == "Full", "Half").otherwise(F.col("status"))).write.parquet(f"{tmp_path}/transfer")
    halves = transfer.filter("status = 'Full'").count()
    kept = Inputs(spark, str(tmp_path), unlisted="drop")
    assert kept["transfer"].count() == 20 - halves and kept.refused("transfer").count() == halves
    assert Inputs(spark, str(tmp_path))["transfer"].count() == 20
    with pytest.raises(Exception, match="not a listed name: Half"):
        Inputs(spark, str(tmp_path), unlisted="fail")["transfer"].collect()


def test_group_is_saved_and_failures_are_recorded(spark, tmp_path):
    derived = DerivedInputs(spark, SF_DIR)

    class Broken(dict):
        def __getitem__(self, name):
            if name == "salt":
                raise FileNotFoundError(name)
            return derived[name]

    results = {r.name: r for r in registry.save("shore_handling", Broken(), str(tmp_path))}
    assert results["bin_tipping"].error is None
    assert isinstance(results["salt"].error, FileNotFoundError)
    assert isinstance(results["forklift_salt"].error, FileNotFoundError)
    saved = spark.read.option("header", True).csv(results["bin_tipping"].path)
    assert saved.count() == registry.build("bin_tipping", derived).count()
    assert "total_price" in saved.columns


def test_unknown_names_are_refused(spark, tmp_path):
    for call in (lambda: registry.save("nope", {}, str(tmp_path)), lambda: registry.build("nope", {})):
        try:
            call()
        except KeyError:
            continue
        raise AssertionError("no error")


def test_table_and_parquet_sinks(spark, tmp_path):
    df = spark.range(5).selectExpr("id AS n", "id * 2 AS m")
    sinks.save_table(df, "net_list")
    sinks.save_table(df.limit(2), "net_list")
    assert spark.table("net_list").count() == 2
    sinks.save_parquet(df, f"{tmp_path}/p", ["n"])
    assert spark.read.parquet(f"{tmp_path}/p").count() == 5
    sinks.save_csv(df, f"{tmp_path}/c", delimiter=";")
    assert spark.read.option("header", True).csv(f"{tmp_path}/c", sep=";").columns == ["n", "m"]


def test_inline_table(spark):
    df = inline_table(spark, {"a": "string", "b": "int"}, [("it's", "1"), ("x\\y", "2")])
    assert sorted(map(tuple, df.collect())) == [("it's", 1), ("x\\y", 2)]


def test_bad_cells_are_rescued(spark, tmp_path):
    rows = [("2025-01-01", "V", " 3600", "7200", "IOT", "normal hours", "Dry", "1.500"), ("tbc", "V", "noon", None, "IOT", "normal hours", "Dry", "n/a"), ("", "W", "1", "2", "IOT", "normal hours", "Dry", " ")]
    names = [c.split()[0] for c in SCHEMAS["unloading_summary"].split(", ")]
    spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names)).write.option("header", True).csv(f"{tmp_path}/unloading_summary")
    inputs = Inputs(spark, str(tmp_path), "csv", cells="rescue")
    table = inputs["unloading_summary"]
    assert table.schema.simpleString() == spark.createDataFrame([], SCHEMAS["unloading_summary"]).schema.simpleString()
    assert [(r.date is None, r.start_time, r.total_tonnage) for r in sorted(table.collect(), key=lambda r: r.start_time or 0)] == [(True, None, None), (True, 1, None), (False, 3600, Decimal("1.500"))]
    (bad,) = inputs.rescued("unloading_summary").collect()
    assert bad.vessel == "V" and [tuple(c) for c in bad[RESCUED]] == [("date", "tbc"), ("start_time", "noon"), ("total_tonnage", "n/a")]
    assert {(r.column, r.text, r.rows) for r in inputs.refused_cells("unloading_summary").collect()} == {("date", "tbc", 1), ("start_time", "noon", 1), ("total_tonnage", "n/a", 1)}
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        Inputs(spark, str(tmp_path), "csv")["unloading_summary"].collect()
    with pytest.raises(ValueError, match="cells"):
        Inputs(spark, str(tmp_path), cells="drop")


def test_unreadable_numbers(spark):
    cells = {"tonnes": "1.5| -2 |x|1,5", "kilos": "1,234|12.5|k|7", "count": "3| 4|4.5|n", "outgoing": "-3|--4-|5|-x"}
    bad = {"tonnes": "00 11", "kilos": "01 10", "count": "00 11", "outgoing": "00 01"}
    for kind in KINDS:
        df = spark.createDataFrame([(i, t) for i, t in enumerate(cells[kind].split("|"))] + [(8, None), (9, " ")], "i int, t string")
        got = "".join(str(int(r[0])) for r in df.orderBy("i").select(unreadable(F.col("t"), kind)).collect())
        assert got == bad[kind].replace(" ", "") + "00", kind
    sums = quality.stated_sums(
        spark.createDataFrame([("a", "1"), ("a", "x"), ("b", None), ("b", "y")], "k string, t string"), ["k"], {"t": (to_tonnes(F.col("t")), unreadable(F.col("t"), "tonnes"))}
    )
    assert sorted((r.k, r.rows, str(r.t), r.t_left_out) for r in sums.collect()) == [("a", 2, "1.000", 1), ("b", 2, "0.000", 1)]


def test_save_all_makes_a_shared_result_once(spark, tmp_path):
    derived, reads = DerivedInputs(spark, SF_DIR), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(vessel):
        reads.add(1)
        return vessel

    class Counting(dict):
        def __getitem__(self, name):
            df = derived[name]
            return df.withColumn("vessel", counted("vessel")) if name == "unloading_summary" else df

    results = registry.save("netlist", Counting(), str(tmp_path))
    assert [r.name for r in results] == list(registry.DATASETS["netlist"]) and not any(r.error for r in results)
    both = reads.value
    reads.value = 0
    registry.build("net_list", Counting()).write.format("noop").mode("overwrite").save()
    once = reads.value
    # The other two datasets of the group read a part of the sheet each; the net list is not made again for the lines of its own.
    others = 0
    for name in ("iot_container_stuffing", "iot_cargo_discharge"):
        reads.value = 0
        registry.build(name, Counting()).write.format("noop").mode("overwrite").save()
        others += reads.value
    assert once > 0 and both == once + others
    for r in results:
        rows = registry.build(r.name, derived)
        assert r.metrics.rows == rows.count() == spark.read.option("header", True).csv(r.path).count()
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(registry.DATASETS["netlist"])


def test_what_hangs_on_a_failure_is_reported(spark, tmp_path):
    good = spark.range(3).toDF("n")

    def bad(_):
        raise ArithmeticError("no")

    builders = {"c": lambda made: made["b"].crossJoin(made["a"].withColumnRenamed("n", "m")), "b": bad, "a": lambda _: good, "d": lambda made: made["a"].filter("n > 5"), "e": lambda made: made["c"]}
    results = {r.name: r for r in sinks.save_group(builders, str(tmp_path), {"c": ["b", "a"], "d": ["a"], "e": ["c"]}, rules={"a": {"small": F.col("n") < 2, "null": F.lit(None).cast("boolean")}})}
    assert list(results) == list(builders)
    assert isinstance(results["b"].error, ArithmeticError)
    assert isinstance(results["c"].error, sinks.NeededFailed) and "b: no" in str(results["c"].error)
    assert isinstance(results["e"].error, sinks.NeededFailed) and "needs c" in str(results["e"].error)
    assert results["a"].metrics == sinks.Metrics(3, 0, {"small": 1, "null": 3})
    assert results["d"].error is None and results["d"].metrics.empty
    (only,) = sinks.save_group(builders, f"{tmp_path}/one", {"d": ["a"]}, ["d"])
    assert only.name == "d" and only.error is None
    with pytest.raises(ValueError):
        sinks.save_group({"x": builders["a"], "y": builders["a"]}, str(tmp_path), {"x": ["y"], "y": ["x"]})


def test_metrics_equal_the_checks(spark, tmp_path):
    derived = DerivedInputs(spark, SF_DIR)
    saved = {r.name: r for r in registry.save("bin_dispatch", derived, str(tmp_path))}["full_scows_transfer"].metrics
    checks = {r.errors: r.rows for r in registered_queries()["scow_trip_rules"](spark, SF_DIR).collect()}
    assert saved.rows == sum(checks.values()) and saved.valid == checks.get("", 0)
    assert {n: v for n, v in saved.broken.items() if v} == {n: s for n in saved.broken if (s := sum(v for e, v in checks.items() if n in e.split(",")))}
    status = quality.container_status(F.col("container_number"))
    names = ["length", "format", "check digit"]
    metrics = sinks.save_parquet(derived["container_codes"], f"{tmp_path}/codes", rules={n: status != n for n in names})
    report = {r.status: r.rows for r in registered_queries()["container_checks"](spark, SF_DIR).collect()}
    assert metrics.valid == report["ok"] and metrics.broken == {n: report.get(n, 0) for n in names}
    assert sinks.save_csv(spark.createDataFrame([], "a int"), f"{tmp_path}/none", rules={"r": F.col("a") > 0}) == sinks.Metrics(0, 0, {"r": 0})


def test_a_month_is_replaced_and_the_others_stay(spark, tmp_path):
    days = spark.sql("SELECT explode(sequence(DATE'2024-12-01', DATE'2025-03-31')) AS date").withColumn("value", F.dayofyear("date"))
    spark.sql("DROP TABLE IF EXISTS daily")
    year = (date(2024, 12, 1), date(2025, 3, 31))
    assert sinks.save_period(days, "daily", year).rows == 121
    files = lambda: {r[0]: r[1] for r in spark.table("daily").withColumn("f", F.input_file_name()).groupBy("month").agg(F.sort_array(F.collect_set("f"))).collect()}
    before = files()
    again = days.filter("day(date) > 20").withColumn("value", F.lit(0))
    metrics = sinks.save_period(again.withColumnRenamed("date", "day").withColumnRenamed("day", "date"), "daily", (date(2025, 1, 1), date(2025, 1, 31)), rules={"zero": F.col("value") == 0})
    assert metrics == sinks.Metrics(11, 11, {"zero": 0})
    after = files()
    assert {m for m in before if before[m] != after[m]} == {"2025-01"}
    assert spark.table("daily").filter("month = '2025-01'").agg(F.sum("value"), F.count("*")).first() == (0, 11)
    # A month without rows any more is emptied; the others again stay.
    assert sinks.save_period(days.filter("month(date) = 3"), "daily", (date(2025, 2, 1), date(2025, 3, 31))).rows == 31
    assert set(files()) == {"2024-12", "2025-01", "2025-03"} and files()["2024-12"] == before["2024-12"]
    assert sinks.save_period(days.limit(0), "daily", (date(2025, 3, 1), date(2025, 3, 31))).empty
    assert set(files()) == {"2024-12", "2025-01"}
    plan = sinks.table_period(spark, "daily", (date(2025, 1, 5), date(2025, 1, 25)))._jdf.queryExecution().executedPlan().toString()
    assert "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert sinks.table_period(spark, "daily", (date(2025, 1, 5), date(2025, 1, 25))).count() == 5
    with pytest.raises(ValueError, match="whole months"):
        sinks.save_period(days, "daily", (date(2025, 1, 2), date(2025, 1, 31)))
    with pytest.raises(ValueError, match="differ"):
        sinks.save_period(days.drop("value"), "daily", (date(2025, 1, 1), date(2025, 1, 31)))
    spark.sql("DROP TABLE daily")
