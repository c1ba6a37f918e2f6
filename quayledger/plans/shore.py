"""Shore handling: salt, the forklift on salt operations, and bin tipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rates import as_double, standard_price
from ..functions.timeband import hhmm, salt_bands, salt_forklift_bands, span_end
from ..functions.values import TONNES
from ..operators.calendar import with_day_name
from .pricing import with_price


def _salt_log(salt_log: DataFrame) -> DataFrame:
    return with_day_name(salt_log).select(
        "day_name",
        "date",
        "vessel",
        F.trim("customer").alias("customer"),
        "start_time",
        "end_time",
        "duration",
        "operation_type",
        F.col("tonnage").cast("double").alias("tonnage"),
    )


def salt(salt_log: DataFrame, price: DataFrame) -> DataFrame:
    """Salt loading: tonnes per rate by the share of the span in each time band."""
    start, end = F.col("start_time"), F.col("end_time")
    seconds = (span_end(start, end) - start).cast("double")
    bands = salt_bands(F.col("day_name"), start, end)
    priced = with_price(_salt_log(salt_log), price, F.col("operation_type"))

    def tonnes(band: Column) -> Column:
        return F.try_divide(band.cast("double"), seconds) * F.col("tonnage")

    names = ["normal", "overtime_150", "overtime_200"]
    unit = as_double(F.col("price"))
    total = (
        F.col("normal") * unit * 1.0
        + F.col("overtime_150") * unit * 1.5
        + F.col("overtime_200") * unit * 2.0
    )
    return priced.withColumns({n: tonnes(b) for n, b in zip(names, bands)}).withColumn(
        "price", total
    )


def forklift_salt(salt_log: DataFrame) -> DataFrame:
    """Forklift hours on salt operations outside Zone 14, as HH:MM."""
    start, end = F.col("start_time"), F.col("end_time")
    normal, at_150, at_200 = salt_forklift_bands(F.col("day_name"), start, end)
    purpose = F.concat(
        F.lit("Salt Loading ("), F.col("tonnage").cast("bigint").cast("string"), F.lit(" ) Tons")
    )
    return (
        _salt_log(salt_log)
        .filter(F.col("operation_type") != "Loading @ Zone 14")
        .select(
            F.col("day_name").alias("day"),
            "date",
            "vessel",
            "customer",
            "start_time",
            "end_time",
            purpose.alias("purpose"),
            hhmm(span_end(start, end) - start).alias("total_duration"),
            hhmm(at_150).alias("overtime_for_normal_services"),
            hhmm(at_200).alias("overtime_for_extended_services"),
            hhmm(normal).alias("normal_hour_services"),
        )
    )


def bin_tipping(tipping_log: DataFrame, price: DataFrame) -> DataFrame:
    """Bins tipped for the factory, priced by tonnes."""
    tipped, overtime = F.col("tonnage_tipped"), F.col("overtime")
    lines = with_day_name(tipping_log.filter(tipped > 0))
    priced = with_price(lines, price, "CCCS Movement in/out")
    total = standard_price(F.col("day_name"), tipped, overtime, F.col("price"))
    return priced.select(
        "day_name",
        "date",
        "customer",
        "movement_type",
        F.lit("IPHS Bin Tipping").alias("service"),
        F.col("scows_tipped").alias("number_of_scows_tipped"),
        tipped.cast(TONNES).alias("tonnage_tipped"),
        overtime.cast(TONNES).alias("overtime"),
        "price",
        as_double(total).alias("total_price"),
    )
