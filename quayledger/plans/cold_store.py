"""Cold-store services: dispatches, trucks, loaders, stuffing and by-catch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.numbers import outgoing_count, to_count, to_tonnes
from ..functions.rates import as_double, money, standard_price
from ..functions.values import TONNES
from ..operators.calendar import in_range, with_day_name
from ..operators.reconcile import three_way
from .pricing import with_price, with_prices

Period = tuple[date | None, date | None] | None


def _tonnes(column: str) -> Column:
    return to_tonnes(F.col(column)).alias(column)


def cold_store_log(cold_store: DataFrame, period: Period = None) -> DataFrame:
    """Typed cold-store log."""
    return cold_store.filter(in_range(F.col("date"), period)).select(
        "day",
        "date",
        "movement_type",
        "customer",
        "origin",
        "vessel",
        "storage_type",
        "operation_type",
        _tonnes("total_tonnage"),
        to_count(F.col("bins_in")).alias("bins_in"),
        outgoing_count(F.col("bins_out")).alias("bins_out"),
        _tonnes("static_loader"),
        _tonnes("overtime_tonnage"),
    )


def cross_stuffing_log(cross_stuffing: DataFrame, period: Period = None) -> DataFrame:
    """Typed cross-stuffing log; everything counts as dry."""
    return cross_stuffing.filter(in_range(F.col("date"), period)).select(
        "day",
        "vessel_client",
        "date",
        "origin",
        "destination",
        "start_time",
        "end_time",
        F.lit("Dry").alias("storage_type"),
        _tonnes("total_tonnage"),
        _tonnes("overtime_tonnage"),
        "is_origin_empty",
        "service",
        "charged",
    )


def by_catch_transfers(by_catch_transfer: DataFrame, period: Period = None) -> DataFrame:
    """Typed by-catch transfer log with day names."""
    return with_day_name(
        by_catch_transfer.filter(in_range(F.col("date"), period)), name="day"
    ).select(
        "day",
        "date",
        "movement_type",
        "customer",
        "vessel",
        F.col("service").alias("operation_type"),
        "storage_type",
        _tonnes("total_tonnage"),
        _tonnes("overtime_tonnage"),
    )


def container_stuffing_log(cccs_stuffing: DataFrame, period: Period = None) -> DataFrame:
    """Typed log of containers stuffed at the cold store; everything counts as dry."""
    return with_day_name(cccs_stuffing.filter(in_range(F.col("date"), period))).select(
        "day_name",
        "date",
        "container_number",
        "customer",
        "service",
        F.lit("Dry").alias("storage_type"),
        _tonnes("total_tonnage"),
        _tonnes("overtime_tonnage"),
        "charged",
    )


def _standard(day: str, price: Column, total: str = "total_tonnage") -> Column:
    return standard_price(F.col(day), F.col(total), F.col("overtime_tonnage"), price)


def static_loader(cold_store: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Static loader used for dispatches."""
    lines = (
        cold_store_log(cold_store, period)
        .filter((F.col("static_loader") > 0) & F.col("operation_type").contains("Dispatch"))
        .select(
            "day",
            "date",
            "customer",
            "operation_type",
            "static_loader",
            "overtime_tonnage",
            F.lit("Static Loader").alias("service"),
        )
    )
    return with_price(lines, price, "Static Loader").withColumn(
        "total_price", as_double(_standard("day", F.col("price"), "static_loader"))
    )


def dispatch_to_cargo(cold_store: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Dispatches to and from cargo vessels: truck, stevedores on board and cold-store fee.

    Under the old DARDANEL terms the fee is waived and the rest discounted.
    """
    lines = (
        cold_store_log(cold_store, period)
        .filter(F.col("operation_type").isin(V.CARGO_DISPATCH_SERVICES))
        .withColumn("total_tonnage", F.abs("total_tonnage"))
    )
    lines = with_prices(
        lines,
        price,
        {"truck": "Tipping Truck", "cargo": "Loading to Cargo", "fee": "CCCS Movement in/out"},
    )
    old_terms = (F.col("customer") == "DARDANEL") & (F.col("date") < V.DARDANEL_TERMS_END)
    unit = F.when(
        old_terms, F.col("truck") - money(V.DARDANEL_DISCOUNT) + F.col("cargo")
    ).otherwise(F.col("truck") + F.col("cargo") + F.col("fee"))
    return lines.select(
        F.col("day").alias("day_name"),
        "date",
        "movement_type",
        "customer",
        "vessel",
        "operation_type",
        "storage_type",
        "total_tonnage",
        "overtime_tonnage",
        F.when(old_terms, F.col("truck") - money(V.DARDANEL_TRUCK_DISCOUNT))
        .otherwise(F.col("truck"))
        .cast(V.PRICE)
        .alias("truck_price"),
        F.when(old_terms, money("0")).otherwise(F.col("fee")).alias("cccs_movement_fee"),
        F.when(old_terms, F.col("cargo") - money(V.DARDANEL_CARGO_DISCOUNT))
        .otherwise(F.col("cargo"))
        .cast(V.PRICE)
        .alias("stevedores_on_cargo_fee"),
        as_double(_standard("day", unit.cast(V.PRICE))).alias("total_price"),
    )


def from_cccs_to_vessel(
    cold_store: DataFrame, price: DataFrame, period: Period = None
) -> DataFrame:
    """Transfers from the cold store to a vessel: truck plus cold-store fee."""
    lines = (
        cold_store_log(cold_store, period)
        .filter(F.col("operation_type") == "From CCCS to Vessel")
        .select(
            "day",
            "date",
            "customer",
            "vessel",
            F.abs("total_tonnage").alias("total_tonnage"),
            "overtime_tonnage",
            "operation_type",
        )
    )
    lines = with_prices(lines, price, {"truck": "Tipping Truck", "fee": "CCCS Movement in/out"})
    return (
        lines.withColumn("price", (F.col("truck") + F.col("fee")).cast(V.PRICE))
        .drop("truck", "fee")
        .withColumn("total_price", as_double(_standard("day", F.col("price"))))
    )


def truck_to_cccs(cold_store: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Trucks to the cold store for the clients that bear the shore cost."""
    lines = (
        cold_store_log(cold_store, period)
        .filter(
            F.col("customer").isin(V.SHORE_COST_CLIENTS)
            & F.col("operation_type").isin(V.UNLOADING_SERVICES)
        )
        .groupBy("day", "date", "customer", "vessel")
        .agg(
            F.sum("total_tonnage").cast(TONNES).alias("total_tonnage"),
            F.sum("overtime_tonnage").cast(TONNES).alias("overtime_tonnage"),
        )
        .withColumn("operation_type", F.lit("IPHS Truck to CCCS"))
    )
    lines = with_prices(
        lines, price, {"price": "Tipping Truck", "cccs_incoming_fee": "CCCS Movement in/out"}
    )
    total = _standard("day", F.col("price")) + _standard("day", F.col("cccs_incoming_fee"))
    return lines.withColumn("total_price", as_double(total))


def cross_stuffing(
    cross_stuffing_sheet: DataFrame, price: DataFrame, period: Period = None
) -> DataFrame:
    """Cross stuffing and unstuffing; the by-catch companies unstuff at a discount."""
    lines = with_price(
        cross_stuffing_log(cross_stuffing_sheet, period), price, F.col("service")
    )
    discounted = F.col("charged").isin(V.BY_CATCH_COMPANIES) & (
        F.col("service") == "Unstuffing to CCCS"
    )
    unit = F.when(discounted, F.col("price") - money(V.UNSTUFFING_DISCOUNT)).otherwise(
        F.col("price")
    )
    return lines.withColumn("price", unit.cast(V.PRICE)).withColumn(
        "total_price", as_double(_standard("day", F.col("price")), 3)
    )


def cccs_stuffing(
    cccs_stuffing_sheet: DataFrame, price: DataFrame, period: Period = None
) -> DataFrame:
    """Containers stuffed at the cold store."""
    lines = with_price(
        container_stuffing_log(cccs_stuffing_sheet, period), price, F.col("service")
    )
    return lines.withColumn("total_price", as_double(_standard("day_name", F.col("price"))))


def by_catch_unloading(cold_store: DataFrame, companies: DataFrame, period: Period = None) -> DataFrame:
    """By-catch brought to the cold store, summed per day, customer, vessel and storage."""
    named = companies.select(F.col("vessel_client").alias("_company")).distinct()
    return (
        cold_store_log(cold_store, period)
        .filter(F.col("operation_type").isin(V.UNLOADING_SERVICES))
        .join(named, F.col("customer") == F.col("_company"), "left_semi")
        .withColumn("operation_type", F.lit("CCCS (By-Catch)"))
        .groupBy(
            "day", "date", "movement_type", "customer", "vessel", "operation_type", "storage_type"
        )
        .agg(
            F.sum("total_tonnage").cast(TONNES).alias("total_tonnage"),
            F.sum("overtime_tonnage").cast(TONNES).alias("overtime_tonnage"),
        )
    )


def by_catch(
    cold_store: DataFrame,
    by_catch_transfer: DataFrame,
    companies: DataFrame,
    price: DataFrame,
    period: Period = None,
) -> DataFrame:
    """By-catch lines: unloading without transfer, transfers, and unloading left over after transfers."""
    lines = three_way(
        by_catch_unloading(cold_store, companies, period),
        by_catch_transfers(by_catch_transfer, period),
        ["date", "customer", "vessel", "movement_type"],
        ["total_tonnage", "overtime_tonnage"],
        order=["storage_type"],
    )
    return (
        with_price(lines, price, F.col("operation_type"))
        .withColumn("total_price", as_double(_standard("day", F.col("price"))))
        .drop("movement_type")
    )


def flat_rate_dispatch(cold_store: DataFrame, services: list[str], period: Period = None) -> DataFrame:
    """Dispatches of some services at the flat rate per tonne."""
    return (
        cold_store_log(cold_store, period)
        .filter(F.col("operation_type").isin(services))
        .select(
            "day",
            "date",
            "vessel",
            "operation_type",
            F.abs("total_tonnage").alias("total_tonnage"),
            "overtime_tonnage",
        )
        .withColumn("price", as_double(_standard("day", money(V.DISPATCH_FLAT_RATE)), 3))
    )


def daily_client_totals(
    stuffing_lines: DataFrame, customer: str, rate: str, period: Period = None
) -> DataFrame:
    """Tonnes and their price at one rate per day, for a client."""
    tonnes = F.sum("total_tonnage")
    return (
        stuffing_lines.filter(in_range(F.col("date"), period) & (F.col("customer") == customer))
        .groupBy("date")
        .agg(
            tonnes.cast(TONNES).alias("tons"),
            F.round(tonnes.cast(TONNES) * money(rate), 2).cast("decimal(18,2)").alias("price"),
        )
    )


def overtime_summary(stuffing_lines: DataFrame) -> DataFrame:
    """Stuffed tonnes and price per method and overtime label.

    Each line is unpivoted into its normal and its overtime tonnes; empty parts
    are left out.
    """
    special = F.col("day").isin(V.SPECIAL_DAYS)
    is_overtime = F.col("tonnage_type") == "Overtime"
    label = (
        F.when(special & is_overtime, "Overtime 200%")
        .when(special != is_overtime, "Overtime 150%")
        .when(F.col("day").isNotNull(), "Normal Hours")
        .otherwise("Error")
    )
    rate = (
        F.when(F.col("overtime") == "Overtime 200%", F.lit("2.0").cast("decimal(2,1)"))
        .when(F.col("overtime") == "Overtime 150%", F.lit("1.5").cast("decimal(2,1)"))
        .when(F.col("overtime") == "Normal Hours", F.lit("1.0").cast("decimal(2,1)"))
        .otherwise(F.lit("0.0").cast("decimal(2,1)"))
    )
    zero = F.lit(0).cast(TONNES)
    overtime = F.coalesce("overtime_tonnage", zero)
    return (
        stuffing_lines.filter(F.col("date").isNotNull())
        .select(
            "day",
            F.col("service").alias("stuffing_method"),
            "price",
            (F.coalesce("total_tonnage", zero) - overtime).cast(TONNES).alias("Normal"),
            overtime.cast(TONNES).alias("Overtime"),
        )
        .unpivot(
            ["day", "stuffing_method", "price"], ["Normal", "Overtime"], "tonnage_type", "tonnage"
        )
        .filter(F.col("tonnage") != 0)
        .withColumn("overtime", label)
        .withColumn("line_price", (F.col("price") * F.col("tonnage") * rate).cast(TONNES))
        .groupBy("stuffing_method", "overtime")
        .agg(
            F.sum("tonnage").cast(TONNES).alias("tonnage"),
            F.sum("line_price").cast("decimal(18,2)").alias("total_usd"),
        )
    )
