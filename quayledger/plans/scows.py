"""Scows between the port and the factory: full, empty and allocated tonnage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.rates import as_double, multiplier
from ..functions.timeband import is_special, label_by_cutoff
from ..functions.values import TONNES
from ..operators.allocate import share, with_group_totals
from ..operators.calendar import in_range, with_day_name
from ..operators.reconcile import fallback_lookup, grains
from .cold_store import cold_store_log
from .pricing import with_price

Period = tuple[date | None, date | None] | None
SCOW_SERVICE = "CCCS Movement in/out"


def scow_transfers(scow_transfer: DataFrame, period: Period = None) -> DataFrame:
    """Typed scow transfer log."""
    return scow_transfer.filter(in_range(F.col("date"), period)).select(
        "date",
        "container_number",
        "customer",
        "movement_type",
        "driver",
        "from",
        "time_out",
        "destination",
        "time_in",
        "status",
        "remarks",
        F.col("num_of_scows").cast("bigint").alias("num_of_scows"),
    )


def _dispatched(cold_store: DataFrame, period: Period) -> DataFrame:
    """Rows of the cold-store log that dispatch bins, in positive tonnes."""
    log = cold_store_log(cold_store, period).filter(F.col("operation_type").isin(V.BIN_DISPATCH_SERVICES))
    return log.withColumn("total_tonnage", F.abs("total_tonnage"))


def bin_dispatch(cold_store: DataFrame, period: Period = None) -> DataFrame:
    """Total, overtime and normal tonnes dispatched per day, customer and movement."""
    grouped = _dispatched(cold_store, period).groupBy("date", "customer", "movement_type")
    return _with_normal(grouped.agg(*[c.alias(n) for n, c in _dispatch_sums().items()]))


def _dispatch_sums() -> dict[str, Column]:
    return {c: F.sum(c).cast(TONNES) for c in ("total_tonnage", "overtime_tonnage")}


def _with_normal(sums: DataFrame) -> DataFrame:
    return sums.withColumn("normal_tonnage", (F.col("total_tonnage") - F.col("overtime_tonnage")).cast(TONNES))


def _trips(scows: DataFrame, status: str, more_keys: list[str]) -> DataFrame:
    """Scows per day, customer, direction and overtime label, with first and last time."""
    direction = F.when(F.col("movement_type") == "Delivery", "OUT").otherwise("IN")
    return (
        with_day_name(scows.filter(F.col("status") == status))
        .withColumn("movement_type", direction)
        .withColumn("overtime", label_by_cutoff(F.col("day_name"), F.col("time_out")))
        .withColumn("storage_type", F.lit("Dry"))
        .groupBy("day_name", "date", "customer", "movement_type", "overtime", *more_keys)
        .agg(
            F.min("time_out").alias("start_time"),
            F.max("time_in").alias("end_time"),
            F.sum("num_of_scows").alias("num_of_scows"),
        )
    )


def _movement_text(load: str) -> Column:
    return F.when(
        F.col("movement_type") == "OUT", f"IPHS Delivery of {load} Scows to IOT"
    ).otherwise(f"IPHS Collection of {load} Scows from IOT")


def full_scows(
    scow_transfer: DataFrame, cold_store: DataFrame, price: DataFrame, period: Period = None
) -> DataFrame:
    """Full scows priced by the tonnes dispatched, matched from fine to coarse keys.

    A coarse match repeats the day's tonnes for every row it serves;
    ``allocate_scows`` is the one that shares them out.
    """
    levels = [["date", "customer", "movement_type"], ["date", "movement_type"], ["date", "customer"]]
    dispatched = _with_normal(grains(_dispatched(cold_store, period), levels, _dispatch_sums()))
    trips = _trips(scow_transfers(scow_transfer, period), "Full", ["storage_type"])
    matched = fallback_lookup(trips, levels, dispatched, ["normal_tonnage", "overtime_tonnage"])
    takes_normal = (F.col("overtime") == V.NORMAL) | (
        is_special(F.col("day_name")) & (F.col("overtime") == V.OVERTIME_150)
    )
    tonnage = F.when(takes_normal, F.col("normal_tonnage")).otherwise(F.col("overtime_tonnage"))
    priced = with_price(matched.withColumn("tonnage", tonnage), price, SCOW_SERVICE)
    amount = F.col("tonnage") * multiplier(F.col("overtime"), "2.0") * F.col("price")
    free = F.col("customer").isin(V.BY_CATCH_COMPANIES)
    return priced.select(
        "day_name",
        "date",
        "customer",
        _movement_text("Full").alias("movement_type"),
        "overtime",
        "start_time",
        "end_time",
        "num_of_scows",
        "storage_type",
        "tonnage",
        "price",
        F.when(free, F.lit(0.0)).otherwise(as_double(amount, 3)).alias("total_price"),
    )


def trip_rules() -> dict[str, Column]:
    """Rules a full-scow line must keep."""
    return {
        "overtime": F.col("overtime").isin(list(V.MULTIPLIERS)),
        "num_of_scows": F.col("num_of_scows") >= 0,
        "storage_type": F.col("storage_type").isin(V.STORAGE_TYPES),
        "tonnage": F.col("tonnage") >= 0,
        "price": F.col("price") >= 0,
        "total_price": F.col("total_price") >= 0,
        "time_order": F.col("end_time") >= F.col("start_time"),
    }


def empty_scows(scow_transfer: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Empty scows priced per scow."""
    trips = _trips(scow_transfers(scow_transfer, period), "Empty", [])
    amount = (
        F.col("num_of_scows").cast("decimal(15,0)")
        * multiplier(F.col("overtime"), "2.0")
        * F.col("price")
    )
    return (
        with_price(trips, price, SCOW_SERVICE)
        .withColumn("total_price", as_double(amount))
        .withColumn("movement_type", _movement_text("Empty"))
    )


def allocate_scows(
    scow_transfer: DataFrame, cold_store: DataFrame, period: Period = None
) -> DataFrame:
    """Tonnes of each day, customer and direction shared over the full trips by scow count.

    Overtime trips share the overtime tonnes and the others the rest. The time
    that decides the label is time_out for a delivery and time_in otherwise.
    """
    time = F.when(F.col("movement_type") == "Delivery", F.col("time_out")).otherwise(
        F.col("time_in")
    )
    direction = F.when(F.col("movement_type") == "Delivery", "OUT").when(
        F.col("movement_type") == "Collection", "IN"
    )
    trips = (
        with_day_name(scow_transfers(scow_transfer, period).filter(F.col("status") == "Full"))
        .withColumn("overtime", label_by_cutoff(F.col("day_name"), time))
        .withColumn("movement_type", direction)
        .withColumn("is_overtime", F.col("overtime") != V.NORMAL)
    )
    keys = ["date", "customer", "movement_type"]
    scows, is_overtime = F.col("num_of_scows"), F.col("is_overtime")
    counted = with_group_totals(
        trips,
        keys,
        {
            "all_scows": scows,
            "overtime_scows": F.when(is_overtime, scows).otherwise(0),
        },
    ).withColumn("normal_scows", F.col("all_scows") - F.col("overtime_scows"))
    overtime = F.when(
        is_overtime, share(scows, F.col("overtime_scows"), F.col("overtime_tonnage"))
    ).otherwise(0.0)
    normal = F.when(
        ~is_overtime, share(scows, F.col("normal_scows"), F.col("normal_tonnage"))
    ).otherwise(0.0)
    return (
        counted.join(bin_dispatch(cold_store, period), keys, "left")
        .withColumn("overtime_part", overtime)
        .withColumn("normal_part", normal)
        .withColumn(
            "shared_tonnage",
            F.col("overtime_part") + F.col("normal_part"),
        )
    )
