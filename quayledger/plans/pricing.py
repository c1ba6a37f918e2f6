"""Price list, client and container reference data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import PRICE
from ..operators.asof import dated_steps, lookup_step


def price_list(
    price: DataFrame, services: Sequence[str] | None = None, price_class: str | None = None
) -> DataFrame:
    """Prices with their effective dates, for some services or one class of the list."""
    out = price
    if services is not None:
        out = out.filter(F.col("service").isin(list(services)))
    if price_class is not None:
        out = out.filter(F.col("class") == price_class)
    return out.select("service", F.col("price").cast(PRICE).alias("price"), "date", "end_date")


def price_steps(price: DataFrame) -> DataFrame:
    """The price list as intervals for ``with_price``."""
    return dated_steps(price_list(price), "service", "date", ["price"])


def with_price(
    df: DataFrame, price: DataFrame, service: str | Column, name: str = "price", day: str = "date"
) -> DataFrame:
    """Add the price of a service in force on the row's day; null before the first price.

    A text names one service for all rows, a column a service per row.
    """
    key = F.lit(service) if isinstance(service, str) else service
    steps = price_steps(
        price.filter(F.col("service") == service) if isinstance(service, str) else price
    )
    return lookup_step(df, steps, key, F.col(day), {"price": name})


def with_prices(
    df: DataFrame, price: DataFrame, services: dict[str, str], day: str = "date"
) -> DataFrame:
    """Add the prices of several fixed services in one lookup; ``services`` maps new name to service.

    The list is turned into one row per date on which any of them changes.
    """
    known = price_list(price, list(services.values())).filter(F.col("date").isNotNull())
    changes = known.groupBy("date").agg(
        *[F.max(F.when(F.col("service") == s, F.col("price"))).alias(n) for n, s in services.items()]
    )
    so_far = Window.partitionBy("_set").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    filled = changes.withColumn("_set", F.lit("")).withColumns(
        {n: F.last(n, ignorenulls=True).over(so_far) for n in services}
    )
    steps = dated_steps(filled, "_set", "date", list(services))
    return lookup_step(df, steps, F.lit(""), F.col(day), {n: n for n in services})


def clients_of_type(client: DataFrame, client_type: str, distinct: bool = True) -> DataFrame:
    """Vessels or clients of one type; entries as they stand without ``distinct``, for readers that group them anyway."""
    out = client.filter(F.col("type") == client_type).select("vessel_client")
    return out.distinct() if distinct else out


def ship_owners(client: DataFrame) -> DataFrame:
    """Owners of the purse seiners."""
    return client.filter(F.col("type") == "THONIER").select("customer").distinct()


def owned_containers(transfer: DataFrame, line: str = "IOT", distinct: bool = True) -> DataFrame:
    """Containers of one owner that came in; entries as they stand without ``distinct``."""
    out = transfer.filter((F.col("movement_type") != "Delivery") & (F.col("line") == line)).select("container_number")
    return out.distinct() if distinct else out
