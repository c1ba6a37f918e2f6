"""Golden rows of the priced plans at their decision points."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quayledger.plans import berth, cold_store, emr, pricing, scows, shore, stuffing, transport, unloading
from quayledger.sources.catalog import SCHEMAS

MON, SUN, NEXT = date(2025, 11, 3), date(2025, 11, 9), date(2026, 3, 1)


def table(spark, name, rows):
    return spark.createDataFrame(rows, SCHEMAS[name])


def prices(spark, *rows):
    """Rows of (service, price, date)."""
    df = spark.createDataFrame(rows, "service string, price string, date date")
    return df.select(
        "service",
        F.col("price").cast("decimal(12,3)").alias("price"),
        "date",
        F.lit(None).cast("date").alias("end_date"),
        F.lit("Net List").alias("class"),
    )


def test_price_on_and_before_its_date(spark):
    price = prices(spark, ("A", "1", MON), ("A", "2", SUN), ("B", "5", SUN))
    df = spark.createDataFrame([(date(2025, 11, 2),), (MON,), (date(2025, 11, 8),), (SUN,), (date(2150, 1, 1),)], "date date")
    one = [r.price for r in pricing.with_price(df, price, "A").orderBy("date").collect()]
    assert one == [None, 1, 1, 2, 2]
    both = pricing.with_prices(df, price, {"a": "A", "b": "B"}).orderBy("date").collect()
    assert [(r.a, r.b) for r in both] == [(None, None), (1, None), (1, None), (2, 5), (2, 5)]


def test_price_class_and_reference_data(spark):
    price = prices(spark, ("A", "1", MON), ("B", "2", MON))
    assert pricing.price_list(price, ["A"], "Net List").count() == 1
    assert pricing.price_list(price, price_class="Other").count() == 0
    client = table(spark, "client", [("V1", "THONIER", "X"), ("V2", "THONIER", "X"), ("C1", "CARGO", "Y")])
    assert [r.customer for r in pricing.ship_owners(client).collect()] == ["X"]
    assert [r.vessel_client for r in pricing.clients_of_type(client, "CARGO").collect()] == ["C1"]


def test_cold_store_adjustment_by_window_and_by_group_agree(spark):
    """The row-by-row factor of each group sums to what ``settled_lines`` returns."""
    rows = [(d, t, kg, "CCCS (X)") for d, t, kg in [(MON, 30000, "1,500"), (MON, 31000, "500"), (MON, 62000, "900")]]
    raw = table(spark, "unloading_raw", [
        ("", d, t, "v1", "s", "", kg, "Dry", dest, "", "Port") for d, t, kg, dest in rows + [(MON, 30000, "70", "IOT")]
    ])
    store = table(spark, "cold_store", [
        ("Mon", MON, "IN", "X", "", "V1", "Dry", "Sorting from Unloading", "3.000", "", "", "", "1.200")
    ])
    groups = unloading.reading_groups(unloading.classified_readings(raw))
    lines = unloading.settled_lines(groups, unloading.cold_store_records(store)).collect()
    found = {(r.destination, r.overtime): float(r.total_tonnage) for r in lines}
    assert found == {
        ("CCCS (X)", "normal hours"): 1.8,
        ("CCCS (X)", "overtime 150%"): 1.2,
        ("IOT", "normal hours"): 0.07,
    }


@pytest.mark.parametrize(
    "destination,day,expected",
    [
        ("IOT FACTORY", MON, "Unload to Quay"),
        ("DARDANEL", date(2025, 8, 31), "Unload to Quay"),
        ("DARDANEL", date(2025, 9, 1), None),
        ("Asian Marine Reefer", date(2025, 11, 3), "Unload to Quay"),
        ("Asian Marine Reefer", date(2025, 11, 16), None),
        ("Cargo One", MON, "Transhipment"),
        ("CCCS (X)", MON, "Unload to CCCS"),
        ("MINE", MON, "Unload to Quay"),
        ("BOX", MON, "Full OSS"),
        ("BASIC", MON, "Basic OSS"),
    ],
)
def test_net_list_service(spark, destination, day, expected):
    lines = spark.createDataFrame(
        [("Mon", day, "V1", 1, destination, "overtime 200%", "Dry", 2, "2.000")],
        "day_name string, date date, vessel string, start_time int, destination string, overtime string,"
        "storage_type string, end_time int, total_tonnage string",
    ).withColumn("total_tonnage", F.col("total_tonnage").cast("decimal(18,3)"))
    kinds = spark.createDataFrame(
        [("V1", "IOT", NEXT, "MINE", "Full OSS"), ("V1", "M", NEXT, "BOX", "Full OSS"),
         ("OCEAN BASKET", "M", MON, "BASIC", "Basic OSS"), ("V1", "M", date(2024, 1, 1), "BOX", "Basic OSS")],
        "vessel_client string, customer string, date_plugged date, container_number string, stuffing string",
    )
    owned = spark.createDataFrame([("MINE",)], "container_number string")
    cargo = spark.createDataFrame([("CARGO ONE",)], "vessel_client string")
    price = prices(spark, *[(f"{s} - Dry", "3", date(2025, 1, 1)) for s in
                            ["Unload to Quay", "Transhipment", "Unload to CCCS", "Full OSS", "Basic OSS"]])
    (row,) = unloading.net_list(lines, kinds, owned, cargo, price).collect()
    assert row.service == expected
    assert row.line_value == (12.0 if expected else None)
    assert row.remarks == ("OCEAN BASKET" if destination == "BASIC" else None)


def test_pti(spark):
    price = prices(spark, *[(s, p, date(2025, 1, 1)) for s, p in [
        ("Plugin", "25"), ("PTI S Freezer", "90"), ("PTI Magnum", "80"), ("PTI Standard", "60"), ("Shifting", "45")]])
    at = lambda d, h, m=0: datetime(2025, 11, d, h, m)
    rows = [
        (at(1, 8), at(1, 16), "C", "-25", "", "PASSED", "CMA CGM", "G1"),  # first visit, exactly 8 hours
        (at(2, 15), at(3, 0), "C", "-35", "", "PASSED", "CMA CGM", "G1"),  # 23 hours later
        (at(4, 1), at(4, 2), "C", "-60", "", "PASSED", "CMA CGM", "G1"),  # 25 hours later, same generator
        (at(9, 1), at(9, 2), "C", "-60", "", "PASSED", "CMA CGM", "G2"),  # other generator
        (at(1, 0), at(2, 1), "D", "-25", "", "PASSED", "IOT", "G1"),  # 25 hours for IOT
    ]
    out = emr.pti(table(spark, "pti", rows), price).orderBy("container_number", "datetime_start").collect()
    assert [r.electricity_price for r in out] == [60, 160, 90, 90, pytest.approx(2 * (25 / 24 + 1))]
    assert [r.charge_shifting for r in out] == [True, False, True, False, True]
    assert [r.total_price for r in out][:4] == [130, 185, 160, 115]


def test_container_plugin_days(spark):
    price = prices(spark, *[(s, p, date(2025, 1, 1)) for s, p in [
        ("Plugin", "25"), ("Monitoring", "30"), ("Electricity Price S Freezer", "110"),
        ("Electricity Price Magnum", "100"), ("Electricity Price Standard", "70")]])
    kinds = [
        ("Direct Transfer", "LML", -25, (0, 0, 0, 0)),
        ("Full OSS", "On Plug", -25, (0, 25, 0, 25)),
        ("Full OSS", "For Completion", -35, (6, 25, 0, 625)),
        ("Full OSS", "Plugin Only", -60, (0, 25, 0, 25)),
        ("Exchange of Hands", "LML", -60, (7, 0, 30, 800)),
        ("Full OSS", None, -25, (7, 25, 30, 545)),
    ]
    rows = [("v", "c", MON, 1, str(i), op, "IOT", "Full", None, sp, SUN, loc) for i, (op, loc, sp, _) in enumerate(kinds)]
    out = stuffing.container_plugin(table(spark, "container_ops", rows), price).orderBy("container_number").collect()
    assert [(r.days_on_plug, r.plugin_price, r.monitoring_price, r.total) for r in out] == [k[3] for k in kinds]


def test_plugin_statement(spark):
    rows = [
        (v, c, MON, 1, str(i), "op", "IOT", status, None, sp, SUN, loc)
        for i, (v, c, status, sp, loc) in enumerate([
            ("V1", "X", "Partial", -25, "For Completion"), ("V1", "X", "Full", -35, "Exchange of Hands"),
            ("V1", "IOT", "Full", -60, "LML"), ("V1", "X", "Full", -18, "Yard"), ("V2", "X", "Full", -18, "Yard")])
    ]
    out = stuffing.plugin_statement(table(spark, "container_ops", rows), " v1 ", MON, SUN).orderBy("container_number")
    assert [(r.days_on_plug, r.line_value, r.remarks) for r in out.collect()] == [
        (6, 445, ""), (7, 730, "Exchange of Hands"), (0, 0, "On the account of IOT"), (7, 55, "Yard")]


def test_berth_fee_tiers(spark):
    visit = lambda c, t, days, out=5, disc=None: ("V1", c, t, MON, 5, date(2025, 11, 2 + days), out, disc)
    rows = [
        visit("X", "FISHING VESSEL", 4), visit("X", "FISHING VESSEL", 3), visit("X", "LONGLINER", 6),
        visit("X", "YACHT", 6), visit("PRINCESS TUNA", "LONGLINER", 6), visit("HARTSWATER LIMITED", "FISHING VESSEL", 2),
        visit("HARTSWATER LIMITED", "LONGLINER", 2), visit("Y", "LONGLINER", 5, out=4),
        ("V1", "Z", "LONGLINER", MON, 5, None, None, None),
    ]
    net = spark.createDataFrame([(MON, "V1", "1.500"), (MON, "V1", "2.000"), (date(2025, 11, 4), "V1", "1.000"), (MON, "V2", "9.000")],
                                "date date, vessel string, total_tonnage string").withColumn("total_tonnage", F.col("total_tonnage").cast("decimal(18,3)"))
    out = berth.berth_dues(table(spark, "berth", rows), net)
    found = {(r.customer, r.date_out, float(r.berth_fee)): r.comments for r in out.collect()}
    assert {(c, f) for c, _, f in found} == {
        ("X", 5000), ("X", 4500), ("X", 1400), ("X", 0), ("PRINCESS TUNA", 0), ("HARTSWATER LIMITED", 2500),
        ("HARTSWATER LIMITED", 600), ("Y", 800), ("Z", 0)}
    assert found["X", date(2025, 11, 6), 5000.0] == "2 days unloading // 4.500t"
    assert found["Z", None, 0.0] == ""


def test_forklift_statement(spark):
    status = table(spark, "report_status", [
        ("A", "STO", MON, "09/11/2025"), ("A", "STO", MON, "04/11/2025"), ("A", "OSS", MON, "30/11/2025"),
        ("B", "STO", MON, "open"), (None, "STO", MON, "09/11/2025")])
    lifts = transport.forklift(table(spark, "forklift", [
        ("Mon", MON, 60000, 64800, 0, "A", "STO", "x"), ("Sun", SUN, 56000, 57600, 0, "A", "STO", "x"),
        ("Sun", SUN, 57000, 58200, 0, "A", "Vessel", "x"), ("Mon", MON, 0, 600, 0, "A", "STO", "Gangway")]))
    out = {(r.customer, r.charged_in): r for r in berth.forklift_statement(status, lifts).collect()}
    assert set(out) == {("A", "STO"), ("A", "Vessel"), ("B", None)}
    sto = out["A", "STO"]
    assert (sto.minutes_at_150, sto.minutes_at_200, sto.minutes_at_normal) == (60, 0, 46)
    assert (sto.time_at_150, sto.time_at_normal, sto.hours_at_normal, sto.due_at_150) == ("01:00", "00:46", 1, 45)
    assert out["B", None].minutes_at_normal == 0


def test_shore_crane_increase(spark):
    price = prices(spark, ("Shore Crane", "100", date(2025, 1, 1)))
    row = lambda day, d: (day, d, 1, 2, 5 * 3600 + 1800, 2 * 3600, "c", "l", "o", "r", "i")
    rows = [row("Mon", MON), row("Mon", date(2026, 1, 5)), row("Sun", SUN), row("Sun", NEXT)]
    out = transport.shore_crane(table(spark, "shore_crane", rows), price).orderBy("date").collect()
    assert [r.total_price for r in out] == [600, 850, 630, 935]
    assert [r.unit_price for r in out] == [100, 150, 100, 165]


def test_dispatch_under_old_terms(spark):
    price = prices(spark, *[(s, p, date(2025, 1, 1)) for s, p in [
        ("Tipping Truck", "7"), ("Loading to Cargo", "8"), ("CCCS Movement in/out", "3.5")]])
    row = lambda d: ("Mon", d, "OUT", "DARDANEL", "", "V", "Dry", "Dispatch to Cargo Vessel", "-10", "", "", "", "")
    store = table(spark, "cold_store", [row(date(2025, 8, 31)), row(date(2025, 9, 1))])
    old, new = cold_store.dispatch_to_cargo(store, price).orderBy("date").collect()
    assert (old.truck_price, old.stevedores_on_cargo_fee, old.cccs_movement_fee, old.total_price) == (6, 5, 0, 110)
    assert (new.truck_price, new.stevedores_on_cargo_fee, float(new.cccs_movement_fee), new.total_price) == (7, 8, 3.5, 185)


def test_scow_allocation_keeps_the_tonnage(spark):
    trips = [(MON, "STDU6536343", "X", "Delivery", "", "", t, "", 0, "Full", "", n) for t, n in [(30000, 2), (31000, 6), (70000, 5), (71000, 0)]]
    store = table(spark, "cold_store", [
        ("Mon", MON, "OUT", "X", "", "V", "Dry", "Bin Dispatch to IOT", "-12.5", "", "", "", "4.5")])
    out = scows.allocate_scows(table(spark, "scow_transfer", trips), store)
    assert sorted(r.shared_tonnage for r in out.collect()) == [0, 2, 4.5, 6]
    assert out.agg(F.sum("shared_tonnage")).collect()[0][0] == 12.5


def test_salt_by_service(spark):
    price = prices(spark, ("Loading @ Zone 14", "10", date(2025, 1, 1)), ("Loading (Quay to Ship)", "20", date(2025, 1, 1)))
    rows = [(MON, "V", " X ", 60000, 62400, 0, s, None) for s in ("Loading @ Zone 14", "Loading (Quay to Ship)")]
    log = table(spark, "salt", rows).withColumn("tonnage", F.lit("8").cast("decimal(18,3)"))
    out = {r.operation_type: (r.normal, r.overtime_150, r.price) for r in shore.salt(log, price).collect()}
    assert out["Loading @ Zone 14"] == (4, 4, 100) and out["Loading (Quay to Ship)"][2] == 200
    (lift,) = shore.forklift_salt(log).collect()
    assert (lift.purpose, lift.total_duration, lift.normal_hour_services) == ("Salt Loading (8 ) Tons", "00:40", "00:20")


def test_inspections_list_earlier_gate_ins(spark):
    log = table(spark, "pti_log", [(MON, "C", "-25", "m", "CMA CGM"), (SUN, "C", "-25", "m", "IOT"), (MON, "D", "-25", "m", "CMA CGM")])
    gates = table(spark, "gate_in", [(MON, "t", "m", "C"), (date(2025, 1, 1), "u", "m", "C"), (SUN, "w", "m", "C")])
    out = emr.inspections_with_gate_in(log, gates, "CMA CGM", (MON, MON))
    assert sorted((r.container_number, r.gate_type or "") for r in out.collect()) == [("C", "t"), ("C", "u"), ("D", "")]


def test_iot_stuffing_deals_its_lines_by_day_and_vessel(spark):
    """No join deals the lines by their destination alone, which a few places would gather in one task."""
    summary = table(spark, "unloading_summary", [(MON, "v1", 0, 9, d, "normal hours", "Dry", Decimal(2)) for d in ["A", "B", "IOT", "IOT"]])
    ops = table(spark, "container_ops", [
        (vessel, "IOT", MON, 0, box, "Stuffing", "IOT", "Full", Decimal(1), -25, MON, "LML") for vessel, box in [("v1", "A"), ("v2", "A"), ("v1", "B"), ("v1", "A")]
    ])
    owned = spark.createDataFrame([("A",), ("A",), ("IOT",)], "container_number string")
    out = unloading.iot_stuffing(summary, owned, ops, prices(spark, ("Stuffing", "3", MON)))
    assert [(r.vessel, r.container_number, r.total_price) for r in out.collect()] == [("V1", "A", 6.0)] * 2
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    semi, inner = plan.index("Join LeftSemi"), plan.index("Join Inner")
    assert inner < semi and "total_tonnage" not in plan[semi:]
