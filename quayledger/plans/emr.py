"""Container depot: shifting, pre-trip inspection and washing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rates import as_double, factor, money
from ..functions.timeband import is_special
from ..functions.values import PRICE
from ..operators.calendar import in_range, with_day_name
from ..operators.ordered import previous_row
from ..operators.rollup import earlier_rows
from .pricing import with_price, with_prices

Period = tuple[date | None, date | None] | None


def shifting(container_shifting: DataFrame, price: DataFrame) -> DataFrame:
    """Container shifts, half as much again on special days."""
    lines = with_day_name(container_shifting.filter(F.col("billed_to") != "INVALID"))
    rate = F.when(is_special(F.col("day_name")), factor("1.5")).otherwise(factor("1.0"))
    return with_price(lines, price, "Shifting").select(
        "day_name",
        "date",
        "container_number",
        "billed_to",
        "service_remarks",
        (F.col("price") * rate).cast(PRICE).alias("price"),
    )


def pti(pti_log: DataFrame, price: DataFrame) -> DataFrame:
    """Pre-trip inspections: plug-in, electricity and shifting.

    Electricity doubles above 8 hours; for IOT its base is a count of days.
    Shifting is charged on a container's first visit, and again on a return to
    the same generator more than 24 hours after the previous visit.
    """
    start, end = F.col("datetime_start"), F.col("datetime_end")
    minutes = (end - start).cast("interval minute").cast("bigint")
    visits = previous_row(
        pti_log.withColumnRenamed("plugged_on", "generator"),
        "container_number",
        ["datetime_start", "datetime_end"],
        ["datetime_end", "generator"],
    ).withColumn("date", start.cast("date"))
    services = {
        "plugin": "Plugin",
        "s_freezer": "PTI S Freezer",
        "magnum": "PTI Magnum",
        "standard": "PTI Standard",
        "shifting": "Shifting",
    }
    visits = with_prices(visits, price, services)
    set_point = F.col("set_point").cast("string")
    base = (
        F.when(F.col("billed_to") == "IOT", F.floor(F.col("minutes") / 60) / 24 + 1)
        .when(set_point == "-60", as_double(F.col("s_freezer")))
        .when(set_point == "-35", as_double(F.col("magnum")))
        .when(set_point == "-25", as_double(F.col("standard")))
        .otherwise(0.0)
    )
    returned = (start > F.col("previous_datetime_end") + F.expr("interval 24 hours")) & (
        F.col("previous_generator") == F.col("generator")
    )
    charged = F.coalesce(returned, F.lit(True))
    total = F.col("plugin_price") + F.col("electricity_price") + F.col("shifting_price")
    return (
        visits.withColumn("minutes", minutes)
        .withColumn("hours", F.col("minutes") / 60)
        .withColumn("plugin_price", as_double(F.col("plugin")))
        .withColumn("electricity_price", base * F.when(F.col("hours") > 8, 2).otherwise(1))
        .withColumn("charge_shifting", charged)
        .withColumn("shifting_price", F.when(charged, as_double(F.col("shifting"))).otherwise(0.0))
        .select(
            "datetime_start",
            "container_number",
            "set_point",
            "billed_to",
            "datetime_end",
            "hours",
            "status",
            "plugin_price",
            "electricity_price",
            "charge_shifting",
            "generator",
            "shifting_price",
            total.alias("total_price"),
        )
    )


def washing(washing_log: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Container cleaning in whole currency units; invalid lines are free."""
    lines = washing_log.filter(in_range(F.col("date"), period))
    unit = F.when(F.col("billed_to") != "INVALID", F.col("price")).otherwise(money("0"))
    return with_price(lines, price, "Container Cleaning").select(
        "date",
        "container_number",
        "billed_to",
        "service_remarks",
        unit.cast("bigint").alias("price"),
    )


def inspections_with_gate_in(
    pti_log: DataFrame, gate_in: DataFrame, line: str, period: Period
) -> DataFrame:
    """A line's inspections of a period, each with every gate-in of its container up to then."""
    inspected = pti_log.filter(
        in_range(F.col("date_plugin"), period) & (F.col("shipping_line") == line)
    ).select("date_plugin", "container_number", "set_point", "unit_manufacturer")
    gates = gate_in.select(
        F.col("date").alias("gate_date"),
        F.col("type").alias("gate_type"),
        F.col("unit_manufacturer").alias("gate_manufacturer"),
        F.col("container_number").alias("_gate_container"),
    )
    return earlier_rows(
        inspected,
        gates,
        by="container_number",
        on="date_plugin",
        log_by="_gate_container",
        log_on="gate_date",
    ).drop("_gate_container")
