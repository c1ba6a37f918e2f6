"""Daily activity sheet: extra men, well-to-well transfers and additional overtime."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rates import as_double, factor
from ..functions.text import remark_detail
from ..functions.timeband import is_special, moment
from ..functions.values import PRICE, STANDARD_CREW
from ..operators.calendar import with_day_name
from ..operators.reconcile import difference_report
from .pricing import with_price


def _day_rate() -> Column:
    rate = F.when(is_special(F.col("day_name")), factor("1.5")).otherwise(factor("1.0"))
    return (F.col("price") * rate).cast(PRICE)


def extra_men(activity: DataFrame, price: DataFrame) -> DataFrame:
    """Extra men per tonne; a count that differs from the crew above standard shows as 'check'."""
    lines = with_price(with_day_name(activity.filter("extra_men > 0")), price, "Extra Men")
    men = F.when(
        F.col("stevedores") - STANDARD_CREW == F.col("extra_men"), F.col("extra_men").cast("string")
    ).otherwise("check")
    total = F.col("total_tonnage") * _day_rate() * F.col("extra_men").cast("decimal(10,0)")
    return lines.select(
        "day_name",
        "date",
        "vessel",
        "total_tonnage",
        men.alias("extra_men"),
        as_double(_day_rate(), 2).alias("price"),
        as_double(total, 3).alias("total_price"),
        remark_detail(F.col("remarks")).alias("remarks"),
    )


def well_to_well(activity: DataFrame, price: DataFrame) -> DataFrame:
    """Transfers between wells, per tonne."""
    lines = with_day_name(activity.filter("well_to_well > 0"))
    return with_price(lines, price, "Well to Well Transfer").select(
        "day_name",
        "date",
        "vessel",
        F.col("well_to_well").alias("tonnage"),
        _day_rate().alias("price"),
        as_double(F.col("well_to_well") * _day_rate()).alias("total_price"),
    )


def additional_overtime(overtime_log: DataFrame, price: DataFrame) -> DataFrame:
    """Stevedores kept on after hours, per started hour and man."""
    minutes = F.floor((F.col("end_time") - F.col("start_time")) / 60)
    hours = F.ceil(minutes / 60)
    total = (
        F.col("price")
        * F.col("number_of_hours").cast("decimal(10,0)")
        * F.col("number_of_stevedores").cast("decimal(10,0)")
    )
    return with_price(overtime_log, price, "Additional Overtime").withColumn(
        "number_of_hours", hours
    ).select(
        moment(F.col("date"), F.col("end_time")).alias("date_and_time"),
        F.upper("vessel").alias("vessel"),
        "number_of_stevedores",
        "number_of_hours",
        "overtime_tonnage",
        "price",
        as_double(total).alias("total_price"),
    )


def activity_difference(activity: DataFrame, net: DataFrame) -> DataFrame:
    """Days and vessels whose activity tonnes differ from the net list."""
    return difference_report(
        activity.select("date", "vessel", F.col("total_tonnage").alias("tonnage")),
        net.select("date", "vessel", F.col("total_tonnage").alias("tonnage")),
        ["date", "vessel"],
        "tonnage",
    )
