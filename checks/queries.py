"""Registered queries: every dataset and operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayledger.functions import values as V
from quayledger.functions.numbers import kilos_to_tonnes, outgoing_count, to_count, to_tonnes, unreadable
from quayledger.functions.rates import as_report, multiplier
from quayledger.functions.timeband import label_by_clock, label_by_cutoff, valid_span
from quayledger.operators import quality
from quayledger.operators.allocate import share, shared_out, with_group_totals
from quayledger.operators.asof import asof_join, dated_steps, lookup_step
from quayledger.operators.calendar import date_spine, holidays_of, in_range, month_range, two_month_range, week_table, with_day_name
from quayledger.operators.ordered import previous_row
from quayledger.operators.reconcile import difference_report, fallback_lookup, grains
from quayledger.operators.rollup import history_before
from quayledger.operators.views import columns_like, daily_sums, latest_date, member, view
from quayledger.plans import berth, cold_store, operations, registry, scows, stuffing, unloading
from quayledger.plans import pricing, transport
from quayledger.session import tuned
from quayledger.sources.catalog import NUMBERS, RESCUED, split_listed_rows, with_schema
from quayledger.sources.catalog import refused_cells as cells_of

from .derived import DerivedInputs, dated_prices

EVENT_PRICES = dated_prices(
    {"signup": "10.250", "view": "0.125", "click": "0.500", "purchase": "2.750"},
    {"2024-01-05": "0.000", "2024-01-14": "0.125", "2024-01-21": "0.250"},
)
Query = Callable[[DerivedInputs], DataFrame]


def _clock(column: str):
    return (F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)).cast("int")


def _half_up(column: str, scale: int):
    """A double rounded half up in double arithmetic, as both engines do it alike."""
    unit = F.lit(10.0**scale)
    return (F.floor(F.col(column) * unit + 0.5) / unit).alias(column)


def holiday_orders(t: DerivedInputs) -> DataFrame:
    orders = t.given("orders").select(F.col("o_orderdate").cast("date").alias("date"), "o_orderkey")
    holidays = holidays_of(orders.select(F.year("date").alias("year")))
    return (
        holidays.join(orders, "date", "left").groupBy("date").agg(F.count("o_orderkey").alias("orders"))
    )


def century_day_labels(t: DerivedInputs) -> DataFrame:
    """Order days moved by up to two centuries either way, by their label."""
    years = F.col("o_orderkey") % 300 - 96
    days = t.given("orders").select(F.add_months(F.col("o_orderdate").cast("date"), (years * 12).cast("int")).alias("date"))
    return with_day_name(days).groupBy("date", "day_name").agg(F.count(F.lit(1)).alias("orders"))


def orders_by_day(t: DerivedInputs) -> DataFrame:
    """Orders of every day from the first to the last, days without any among them."""
    orders = t.given("orders").select(F.col("o_orderdate").cast("date").alias("date"))
    first, last = orders.agg(F.min("date"), F.max("date")).first()
    counted = orders.groupBy("date").agg(F.count(F.lit(1)).alias("orders"))
    return date_spine(orders.sparkSession, first, last).join(counted, "date", "left").fillna(0, ["orders"])


def order_weeks(t: DerivedInputs) -> DataFrame:
    days = t.given("orders").select(F.col("o_orderdate").cast("date").alias("date"))
    return week_table(days)


def _labelled_events(t: DerivedInputs) -> DataFrame:
    events = t.given("events").select(
        "event_id",
        "event_type",
        F.col("ts").cast("date").alias("date"),
        _clock("ts").alias("time"),
        F.col("value").cast(V.TONNES).alias("tonnage"),
    )
    return (
        with_day_name(events)
        .withColumn("label", label_by_clock(F.col("day_name"), F.col("time")))
        .withColumn("cutoff_label", label_by_cutoff(F.col("day_name"), F.col("time")))
    )


def overtime_labels(t: DerivedInputs) -> DataFrame:
    return _labelled_events(t).drop("event_type", "tonnage")


def priced_events(t: DerivedInputs) -> DataFrame:
    events = _labelled_events(t)
    steps = dated_steps(events.sparkSession.sql(EVENT_PRICES), "service", "date", ["price"])
    priced = lookup_step(events, steps, F.col("event_type"), F.col("date"), {"price": "price"})
    amount = F.col("tonnage") * F.col("price") * multiplier(F.col("label"))
    return (
        priced.groupBy("day_name", "event_type", "label")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("tonnage").alias("tonnage"),
            F.sum(amount).alias("amount"),
        )
    )


def next_purchase(t: DerivedInputs) -> DataFrame:
    events = t.given("events")
    return asof_join(
        events.filter("event_type = 'signup'").select("event_id", "user_id", "ts"),
        events.filter("event_type = 'purchase'").select(
            "user_id", "ts", F.col("ts").alias("purchase_ts"), F.col("value").alias("purchase_value")
        ),
        "ts",
        ["user_id"],
        ["purchase_ts", "purchase_value"],
        direction="forward",
    )


def last_click(t: DerivedInputs) -> DataFrame:
    events = t.given("events")
    return asof_join(
        events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"),
        events.filter("event_type = 'click'").select(
            "user_id", "ts", F.col("ts").alias("click_ts"), F.col("value").alias("click_value")
        ),
        "ts",
        ["user_id"],
        ["click_ts", "click_value"],
    )


def previous_gap(t: DerivedInputs) -> DataFrame:
    rows = previous_row(
        t.given("events").select("event_id", "user_id", "ts", "event_type"),
        "user_id",
        ["ts", "event_id"],
        ["ts", "event_type"],
    )
    again = (F.col("ts") > F.col("previous_ts") + F.expr("interval 24 hours")) & (
        F.col("event_type") == F.col("previous_event_type")
    )
    return rows.select(
        "event_id", "user_id", "previous_ts", "occurrence", F.coalesce(again, F.lit(True)).alias("charged")
    )


def order_shares(t: DerivedInputs) -> DataFrame:
    lines = t.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    orders = t.given("orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    )
    counted = with_group_totals(lines, ["l_orderkey"], {"lines_total": F.col("price")})
    part = share(F.col("price"), F.col("lines_total"), F.col("total"))
    return counted.join(orders, "l_orderkey").withColumn("share", part).select(
        "l_orderkey", "l_linenumber", "l_partkey", "price", _half_up("share", 2)
    )


def exact_shares(t: DerivedInputs) -> DataFrame:
    """Each order's total shared over its lines by price, to the cent."""
    lines = t.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("price")
    )
    orders = t.given("orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("total")
    )
    order = ["l_linenumber", "l_partkey", "price"]
    return shared_out(lines.join(orders, "l_orderkey"), ["l_orderkey"], order, "price", "total", name="share")


def fallback_rates(t: DerivedInputs) -> DataFrame:
    lines = t.given("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    levels, least = [["l_partkey", "l_suppkey"], ["l_partkey", "l_returnflag"], ["l_suppkey"]], F.array(F.lit(3), F.lit(12), F.lit(1))
    sums = grains(lines, levels, {"quantity": F.sum(F.col("l_quantity").cast("bigint")), "n": F.count(F.lit(1))})
    rates = sums.filter(F.col("n") >= F.get(least, F.col("_level"))).withColumn("rate", F.col("quantity") / F.col("n"))
    return fallback_lookup(lines, levels, rates, ["rate"]).drop("l_returnflag")


def gate_in_history(t: DerivedInputs) -> DataFrame:
    gates = t["gate_in"].select("container_number", "date", "type", "unit_manufacturer")
    return history_before(
        t["pti_log"].drop("shipping_line"),
        gates,
        by="container_number",
        on="date_plugin",
        log_by="container_number",
        log_on="date",
        details=["type"],
    )


def container_checks(t: DerivedInputs) -> DataFrame:
    return quality.container_report(t["container_codes"], "container_number")


def rejected_forklift(t: DerivedInputs) -> DataFrame:
    checked = quality.with_errors(
        t["forklift"],
        {
            "day": F.col("day").isin(V.DAY_NAMES),
            "service": ~F.col("service_type").isin("Gangway"),
            "span": valid_span(F.col("start_time"), F.col("end_time")),
            "length": F.col("duration") >= 900,
            "customer": quality.not_blank(F.col("customer")),
        },
    )
    return (
        checked.filter(F.size("errors") > 0)
        .groupBy(F.array_join("errors", ",").alias("errors"), "service_type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def scow_trip_rules(t: DerivedInputs) -> DataFrame:
    full = registry.build("full_scows_transfer", t)
    valid, rejected = quality.split_valid(full, scows.trip_rules())
    return (
        valid.select(F.lit("").alias("errors"))
        .unionByName(rejected.select(F.array_join("errors", ",").alias("errors")))
        .groupBy("errors")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def listed_labels(t: DerivedInputs) -> DataFrame:
    kept, refused = split_listed_rows(t["unloading_summary"], "unloading_summary")
    return (
        kept.withColumn("errors", F.array().cast("array<string>"))
        .unionByName(refused)
        .groupBy(F.array_join("errors", ",").alias("errors"))
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("total_tonnage").alias("tonnage"))
    )


def unlisted_containers(t: DerivedInputs) -> DataFrame:
    _, unlisted = quality.split_listed(
        t["washing"],
        "container_number",
        pricing.owned_containers(t["transfer"]),
        "container_number",
    )
    return unlisted.groupBy("container_number").agg(F.count(F.lit(1)).alias("rows"))


def named_movements(t: DerivedInputs) -> DataFrame:
    typed = t["transfer"].withColumn(
        "typed",
        F.concat(F.lit(" "), F.when(F.col("status") == "Full", F.upper("movement_type")).otherwise(F.lower("movement_type"))),
    )
    known = ["Collection", "Delivery"]
    return typed.groupBy("typed", quality.canonical_name(F.col("typed"), known).alias("movement")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def dirty_numbers(t: DerivedInputs) -> DataFrame:
    log = t["cold_store"]
    return log.groupBy("operation_type", "movement_type").agg(
        F.sum(to_tonnes(F.col("total_tonnage"))).alias("total_tonnage"),
        F.sum(to_tonnes(F.col("overtime_tonnage"))).alias("overtime_tonnage"),
        F.sum(to_count(F.col("bins_in"))).alias("bins_in"),
        F.sum(outgoing_count(F.col("bins_out"))).alias("bins_out"),
    )


def _rescued_sheet(t: DerivedInputs) -> DataFrame:
    return with_schema(t["unloading_sheet"], "unloading_summary", cells="rescue")


def refused_cells(t: DerivedInputs) -> DataFrame:
    """The texts that can't be read as numbers, dates or times, by table and column."""
    tables = [cells_of(t[name], name) for name in NUMBERS]
    return reduce(DataFrame.unionByName, tables, cells_of(_rescued_sheet(t), "unloading_summary"))


def rescued_sheet(t: DerivedInputs) -> DataFrame:
    """Tonnes of a sheet as typed, and what was left out of them, by storage type and whether the day is known."""
    lost = {c: F.array_contains(F.transform(RESCUED, lambda x: x["column"]), c) for c in ("date", "start_time", "total_tonnage")}
    sheet = _rescued_sheet(t).withColumn("dated", F.col("date").isNotNull())
    sums = quality.stated_sums(sheet, ["storage_type", "dated"], {"tonnage": (F.col("total_tonnage"), lost["total_tonnage"])})
    cells = sheet.groupBy("storage_type", "dated").agg(*[F.count_if(lost[c]).alias(f"{c}_left_out") for c in ("date", "start_time")])
    return sums.join(cells, ["storage_type", "dated"])


def stated_totals(t: DerivedInputs) -> DataFrame:
    """Cold-store tonnes by movement, with the number of cells that count for nothing because they can't be read."""
    tonnes = {c: (to_tonnes(F.col(c)), unreadable(F.col(c), "tonnes")) for c in ("total_tonnage", "overtime_tonnage", "static_loader")}
    return quality.stated_sums(t["cold_store"], ["operation_type", "movement_type"], tonnes)


def scale_totals(t: DerivedInputs) -> DataFrame:
    raw = t["unloading_raw"]
    return raw.groupBy("storage").agg(F.sum(kilos_to_tonnes(F.col("scale_reading"))).alias("tonnage"))


def _classified(t: DerivedInputs) -> DataFrame:
    return unloading.classified_readings(t["unloading_raw"])


def adjusted_cold_store(t: DerivedInputs) -> DataFrame:
    return unloading.adjusted_cold_store(
        _classified(t), unloading.cold_store_records(t["cold_store"])
    )


def net_list_view(t: DerivedInputs) -> DataFrame:
    net = view(
        registry.build("net_list", t),
        where=[member("service", ["Unload to Quay", "Unload to CCCS"])],
        period=(None, None),
        select=["date", "service", "total_tonnage", "line_value"],
    )
    sums = {"tonnage": F.col("total_tonnage"), "value": F.col("line_value").cast("decimal(18,3)")}
    return daily_sums(net, sums, keys=["service"])


def top_net_list(t: DerivedInputs) -> DataFrame:
    return view(
        registry.build("net_list", t),
        where=[F.col("line_value").isNotNull()],
        select=["date", "vessel", "destination", "overtime", "storage_type", "line_value"],
        order=[F.desc("line_value"), "date", "vessel", "destination", "overtime", "storage_type"],
        limit=25,
    )


def net_list_month(t: DerivedInputs) -> DataFrame:
    """The net list of two months of one year, as the period filter takes them."""
    months = two_month_range(2025, 11)
    net = view(registry.net_list(t, months), period=months, select=["date", "service", "total_tonnage"])
    # A line of November counts twice, in one pass over the list.
    november = in_range(F.col("date"), month_range(2025, 11))
    counts_in = F.when(november, F.array(F.lit(0), F.lit(11))).otherwise(F.array(F.lit(0)))
    both = view(net, select=["*", F.explode(counts_in).alias("month")])
    return both.groupBy("month", "service").agg(F.count(F.lit(1)).alias("lines"), F.sum("total_tonnage").alias("tonnage"))


def net_list_difference(t: DerivedInputs) -> DataFrame:
    """Days and vessels on which the two net lists differ in tonnes."""
    return difference_report(
        registry.build("net_list", t), registry.net_list_from_readings(t), ["date", "vessel"], "total_tonnage"
    )


def tonnage_columns(t: DerivedInputs) -> DataFrame:
    """Sums of all columns of the cold-store log that hold tonnes, found by name."""
    log = t["cold_store"]
    return log.groupBy("movement_type").agg(*[F.sum(to_tonnes(F.col(c))).alias(c) for c in columns_like(log, "tonnage")])


def class_prices(t: DerivedInputs) -> DataFrame:
    """Prices of one class of the list."""
    return pricing.price_list(t["price"], price_class="Net List").select("service", "price", "date")


def bycatch_balance(t: DerivedInputs) -> DataFrame:
    """By-catch tonnes unloaded or transferred against those of the result lines, by key; only where they differ."""
    keys = ["date", "customer", "vessel"]
    companies = pricing.clients_of_type(t["client"], "BYCATCH")
    arrived = cold_store.by_catch_unloading(t["cold_store"], companies)
    moved = cold_store.by_catch_transfers(t["by_catch_transfer"])
    sources = arrived.select(*keys, "movement_type", "total_tonnage").unionByName(
        moved.join(arrived.select(*keys, "movement_type").distinct(), [*keys, "movement_type"], "left_anti").select(*keys, "movement_type", "total_tonnage")
    )
    return difference_report(sources, registry.build("bycatch", t), keys, "total_tonnage", both=False)


def stop_over_totals(t: DerivedInputs) -> DataFrame:
    return berth.stop_over_totals(t["statement_register"], registry.build("net_list", t))


DERIVED_QUERIES: dict[str, Query] = {
    "holiday_orders": holiday_orders,
    "order_weeks": order_weeks,
    "century_day_labels": century_day_labels,
    "orders_by_day": orders_by_day,
    "net_list_month": net_list_month,
    "net_list_from_readings": registry.net_list_from_readings,
    "net_list_difference": net_list_difference,
    "tonnage_columns": tonnage_columns,
    "class_prices": class_prices,
    "bycatch_balance": bycatch_balance,
    "overtime_labels": overtime_labels,
    "priced_events": priced_events,
    "next_purchase": next_purchase,
    "last_click": last_click,
    "previous_gap": previous_gap,
    "order_shares": order_shares,
    "exact_shares": exact_shares,
    "fallback_rates": fallback_rates,
    "gate_in_history": gate_in_history,
    "container_checks": container_checks,
    "rejected_forklift": rejected_forklift,
    "scow_trip_rules": scow_trip_rules,
    "listed_labels": listed_labels,
    "unlisted_containers": unlisted_containers,
    "named_movements": named_movements,
    "dirty_numbers": dirty_numbers,
    "refused_cells": refused_cells,
    "rescued_sheet": rescued_sheet,
    "stated_totals": stated_totals,
    "scale_totals": scale_totals,
    "classified_readings": _classified,
    "adjusted_cold_store": adjusted_cold_store,
    "net_list_view": net_list_view,
    "top_net_list": top_net_list,
    "latest_net_list": lambda t: latest_date(registry.build("net_list", t)),
    "stuffing_types": lambda t: unloading.stuffing_types(t["container_ops"]),
    "duplicate_stuffing": lambda t: quality.duplicates(
        unloading.stuffing_types(t["container_ops"]), ["container_number", "date_plugged"]
    ),
    "iot_stuffing_records": lambda t: unloading.iot_stuffing_records(t["container_ops"]),
    "owned_containers": lambda t: pricing.owned_containers(t["transfer"]),
    "ship_owners": lambda t: pricing.ship_owners(t["client"]),
    "bin_dispatch": lambda t: scows.bin_dispatch(t["cold_store"]),
    "scow_allocation": lambda t: scows.allocate_scows(t["scow_transfer"], t["cold_store"]).select(
        "date",
        "container_number",
        "customer",
        "movement_type",
        "time_out",
        "time_in",
        "overtime",
        "num_of_scows",
        _half_up("overtime_part", 6),
        _half_up("normal_part", 6),
    ),
    "flat_rate_dispatch": lambda t: cold_store.flat_rate_dispatch(
        t["cold_store"], V.BIN_DISPATCH_SERVICES
    ),
    "daily_client_totals": lambda t: cold_store.daily_client_totals(
        t["stuffing_lines"], "OCEAN BASKET", "3.000"
    ),
    "overtime_summary": lambda t: cold_store.overtime_summary(t["stuffing_lines"]),
    "plugin_statement": lambda t: stuffing.plugin_statement(
        t["container_ops"], " vessel ", F.lit("2025-01-01").cast("date"), F.lit("2030-12-31").cast("date")
    ),
    "forklift_view": lambda t: transport.forklift_view(t["forklift_usage"]),
    "extra_men": lambda t: operations.extra_men(t["activity"], t["price"]),
    "well_to_well": lambda t: operations.well_to_well(t["activity"], t["price"]),
    "additional_overtime": lambda t: operations.additional_overtime(
        t["additional_overtime"], t["price"]
    ),
    "activity_difference": lambda t: operations.activity_difference(t["activity"], registry.landed_lines(t)),
    "berth_dues": lambda t: berth.berth_dues(t["berth"], registry.landed_lines(t)),
    "stop_over_numbers": lambda t: berth.stop_over_numbers(t["berth"], t["statement_register"]),
    "stop_over_totals": stop_over_totals,
    "forklift_statement": lambda t: berth.forklift_statement(
        t["report_status"], transport.forklift(t["forklift"])
    ),
    "scan_times": lambda t: unloading.scan_times(t["unloading_raw"]),
}


def _registered(query: Query) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: as_report(query(DerivedInputs(tuned(spark), sf_dir)))


def registered_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every dataset of the registry and every further query."""
    datasets = {name: partial(registry.build, name) for group in registry.DATASETS.values() for name in group}
    return {name: _registered(q) for name, q in {**datasets, **DERIVED_QUERIES}.items()}
