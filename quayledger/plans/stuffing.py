"""Container stuffing: pallets, liners, plug-in and the plug-in statement."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import values as V
from ..functions.rates import as_double, money
from ..functions.timeband import moment
from ..operators.calendar import in_range
from .pricing import with_prices


def pallet_liner(liner_pallet: DataFrame, price: DataFrame) -> DataFrame:
    """Pallets, with IOT's own price, and liners, charged to CMA CGM only."""
    lines = liner_pallet.withColumn("assigned_to", F.upper("assigned_to"))
    lines = with_prices(
        lines,
        price,
        {
            "iot_pallet": "Pallets(+ Wedges) Usage",
            "pallet": "Pallets",
            "liner": "Plastic Liner Installation",
        },
    )
    has_pallet = F.col("remarks").contains("Pallet")
    pallet = (
        F.when(has_pallet & (F.col("shipping_line") == "IOT"), F.col("iot_pallet"))
        .when(has_pallet, F.col("pallet"))
        .otherwise(money("0"))
    )
    liner = F.when(
        F.col("remarks").contains("Liner") & (F.col("shipping_line") == "CMA CGM"), F.col("liner")
    ).otherwise(money("0"))
    return lines.select(
        "date",
        "container_number",
        "shipping_line",
        "assigned_to",
        "remarks",
        pallet.alias("pallet_price"),
        liner.alias("liner_price"),
    )


def container_plugin(container_ops: DataFrame, price: DataFrame) -> DataFrame:
    """Plug-in, monitoring and electricity of stuffed containers."""
    direct = F.col("operation_type").contains("Direct")
    exchange = F.col("operation_type").contains("Exchange")
    on_plug = F.col("location") == "On Plug"
    partly = F.col("location") == "For Completion"
    plugged_only = F.col("location") == "Plugin Only"
    free = money("0")

    lines = (
        container_ops.withColumn("vessel_client", F.upper("vessel_client"))
        .withColumn("date_plugged", F.col("date_plugged").try_cast("date"))
        .withColumn("date_out", F.col("date_out").try_cast("date"))
    )
    services = {
        "plugin": "Plugin",
        "monitoring": "Monitoring",
        "s_freezer": "Electricity Price S Freezer",
        "magnum": "Electricity Price Magnum",
        "standard": "Electricity Price Standard",
    }
    lines = with_prices(lines, price, services, "date_plugged")
    span = F.datediff("date_out", "date_plugged")
    days = F.when(direct | on_plug | plugged_only, 0).when(partly, span).otherwise(span + 1)
    electricity = (
        F.when(plugged_only, free)
        .when(F.col("set_point") == -60, F.col("s_freezer"))
        .when(F.col("set_point") == -35, F.col("magnum"))
        .otherwise(F.col("standard"))
    )
    monitoring = F.when(direct | on_plug | partly | plugged_only, free).otherwise(
        F.col("monitoring")
    )
    total_electricity = F.col("electricity_unit_price") * F.col("days_on_plug")
    return (
        lines.withColumn("days_on_plug", days)
        .withColumn("plugin_price", F.when(direct | exchange, free).otherwise(F.col("plugin")))
        .withColumn("monitoring_price", monitoring)
        .withColumn("electricity_unit_price", electricity)
        .withColumn("total_electricity", total_electricity)
        .withColumn(
            "total",
            as_double(F.col("plugin_price") + F.col("monitoring_price") + F.col("total_electricity")),
        )
        .withColumn("total_electricity", as_double(F.col("total_electricity")))
        .drop(*services)
    )


def plugin_statement(
    container_ops: DataFrame, vessel: str, first: date, last: date
) -> DataFrame:
    """Plug-in statement of a vessel and period at the statement's own rates.

    MAERSKLINE and IOT are shown with 0 days and nothing to pay.
    """
    name = vessel.strip().upper()
    lines = container_ops.filter(
        F.upper("vessel_client").contains(name) & in_range(F.col("date_plugged"), (first, last))
    )
    own_account = F.col("customer").isin("MAERSKLINE", "IOT")
    span = F.datediff("date_out", "date_plugged")
    days = F.when(F.col("plugged_status") == "Partial", span).otherwise(span + 1)
    monitoring = F.when(F.col("location") == "For Completion", 0).otherwise(V.STATEMENT_MONITORING)
    plugin = F.when(F.col("location") == "Exchange of Hands", 0).otherwise(V.STATEMENT_PLUGIN)
    rate = F
    for set_point, per_day in V.STATEMENT_ELECTRICITY.items():
        rate = rate.when(F.col("set_point") == set_point, per_day)
    charge = F.coalesce(rate * F.col("days"), F.lit(0)) + monitoring + plugin
    remarks = (
        F.when(F.col("customer") == "MAERSKLINE", "On the account of MAERSK")
        .when(F.col("customer") == "IOT", "On the account of IOT")
        .when(F.col("location").isin("LML", "IOT", "For Completion", "Fishing Port"), "")
        .otherwise(F.col("location"))
    )
    return lines.withColumn("days", days).select(
        F.upper("vessel_client").alias("vessel"),
        moment(F.col("date_plugged"), F.col("time_plugged")).alias("plugged_in"),
        "container_number",
        "shipping_line",
        F.col("plugged_status").alias("status"),
        "set_point",
        "tonnage",
        F.col("date_out").alias("unplugged_date"),
        remarks.alias("remarks"),
        F.when(own_account, 0).otherwise(F.col("days")).alias("days_on_plug"),
        F.when(own_account, 0).otherwise(charge).alias("line_value"),
    )
