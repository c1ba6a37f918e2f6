"""Transport: shore crane, container haulage and forklifts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.rates import as_double, factor, money
from ..functions.timeband import forklift_bands, is_special, whole
from ..operators.calendar import in_range, with_day_name
from .pricing import with_price

Period = tuple[date | None, date | None] | None


def shore_crane(crane_log: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Crane hours, whole hours only, with the increase on overtime from its start dates."""
    lines = with_price(
        crane_log.filter(in_range(F.col("date"), period))
        .withColumn("hours", whole(F.col("hours"), 3600))
        .withColumn("overtime_hours", whole(F.col("overtime_hours"), 3600)),
        price,
        "Shore Crane",
    )
    special = is_special(F.col("day"))
    raised = F.lit(V.CRANE_INCREASE).cast(V.FACTOR)
    plain = F.lit("1.00").cast(V.FACTOR)
    raised_special = F.col("date") >= V.CRANE_SPECIAL_INCREASE_START
    raised_weekday = F.col("date") >= V.CRANE_WEEKDAY_INCREASE_START
    special_raise = F.when(raised_special, raised).otherwise(plain)
    unit = F.when(special, F.col("price") * factor("1.5") * special_raise).otherwise(F.col("price"))
    overtime = F.col("overtime_hours").cast("decimal(9,0)")
    normal = (F.col("hours") - F.col("overtime_hours")).cast("decimal(9,0)")
    weighted = (
        F.when(special, (normal * factor("1.5") + overtime * factor("2.0")) * special_raise)
        .when(raised_weekday, normal * factor("1.0") + overtime * factor("1.5") * raised)
        .otherwise(normal * factor("1.0") + overtime * factor("1.5"))
    )
    return lines.select(
        F.col("day").alias("day_name"),
        "date",
        "start_time",
        "end_time",
        "hours",
        "overtime_hours",
        "customer",
        "location",
        "operation_type",
        "remarks",
        "charged_to",
        as_double(unit, 3).alias("unit_price"),
        as_double(weighted * F.col("price"), 3).alias("total_price"),
    )


def haulage(transfer: DataFrame, price: DataFrame, period: Period = None) -> DataFrame:
    """Container transfers with their shifting and haulage price.

    A movement that is neither collection nor delivery has time 00:00, which
    puts its haulage in the early band.
    """
    service = (
        F.when(F.col("size") == "40'", "Haulage FEU")
        .when(F.col("size") == "20'", "Haulage TEU")
        .otherwise("Err")
    )
    time = (
        F.when(F.col("movement_type") == "Collection", F.col("time_in"))
        .when(F.col("movement_type") == "Delivery", F.col("time_out"))
        .otherwise(0)
    )
    lines = with_day_name(transfer.filter(in_range(F.col("date"), period))).withColumn("_time", time)
    lines = with_price(lines, price, service, "_haulage")
    lines = with_price(lines, price, "Shifting", "_shifting")
    special, clock = is_special(F.col("day_name")), F.col("_time")
    late_special, late = special & (clock > V.H16), special | (clock > V.H17)
    early = clock.between(0, V.EARLY_END)
    free_shifting = (
        (F.col("type") == "Reefer") & (F.col("remarks") != "IOT") & (F.col("status") == "Full")
    ) | ((F.col("remarks") == "CCCS") & (F.col("driver") == "NA"))
    shifting = (
        F.when(free_shifting, money("0"))
        .when(late_special, F.col("_shifting") * factor("2.0"))
        .when(late, F.col("_shifting") * factor("1.5"))
        .otherwise(F.col("_shifting"))
    )
    hauled = (
        F.when(~F.col("driver").contains("IPHS"), money("0"))
        .when(late_special, F.col("_haulage") * factor("2.0"))
        .when(late | early, F.col("_haulage") * factor("1.5"))
        .otherwise(F.col("_haulage"))
    )
    return lines.select(
        "day_name",
        "date",
        "container_number",
        "line",
        "movement_type",
        "driver",
        "origin",
        "time_out",
        "destination",
        "time_in",
        "status",
        "type",
        "size",
        "remarks",
        shifting.cast(V.PRICE).alias("shifting_price"),
        hauled.cast(V.PRICE).alias("haulage_price"),
    )


def forklift(forklift_log: DataFrame, period: Period = None) -> DataFrame:
    """Forklift use split into normal, 150% and 200% minutes."""
    normal, at_150, at_200 = forklift_bands(F.col("day"), F.col("start_time"), F.col("end_time"))
    return (
        forklift_log.filter(in_range(F.col("date"), period))
        .filter(~F.col("service_type").isin(V.FORKLIFT_EXCLUDED_SERVICES) & (F.col("day") != ""))
        .select(
            "day",
            "date",
            "start_time",
            "end_time",
            "duration",
            "customer",
            "charged_in",
            "service_type",
            at_150.alias("overtime_150"),
            at_200.alias("overtime_200"),
            normal.alias("normal_hours"),
        )
    )


def forklift_view(forklift_usage: DataFrame) -> DataFrame:
    """Forklift usage log under the names of the service sheet."""
    return forklift_usage.select(
        F.col("date_of_service").alias("date"),
        F.initcap("driver").alias("driver"),
        "forklift_number",
        F.col("time_out").alias("start_time"),
        F.col("time_in").alias("end_time"),
        F.col("vessel_client").alias("customer"),
        F.col("purpose").alias("remarks"),
    )
