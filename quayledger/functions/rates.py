"""Multipliers and the standard tonnage price.

Tonnes, prices and multipliers are decimals, so a price is exact and does not
depend on the order in which tasks add their parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from . import values as V
from .timeband import is_special


def factor(value: str) -> Column:
    """A multiplier literal."""
    return F.lit(value).cast("decimal(2,1)")


def money(value: str) -> Column:
    """A price literal."""
    return F.lit(value).cast(V.PRICE)


def multiplier(label: Column, otherwise: str = "1.0") -> Column:
    """1.0, 1.5 or 2.0 by overtime label."""
    chain = F
    for name, value in V.MULTIPLIERS.items():
        chain = chain.when(label == name, factor(value))
    return chain.otherwise(factor(otherwise))


def standard_price(day: Column, total: Column, overtime: Column, price: Column) -> Column:
    """Tonnage price: overtime tonnes one step above the rest, special days one step up."""
    weighted = F.when(
        is_special(day), (total - overtime) * factor("1.5") + overtime * factor("2.0")
    ).otherwise((total - overtime) * factor("1.0") + overtime * factor("1.5"))
    return weighted * price


def as_double(amount: Column, scale: int | None = None) -> Column:
    """An exact amount as the double a report shows, rounded when a scale is given."""
    return (amount if scale is None else F.round(amount, scale)).cast("double")


def as_report(df: DataFrame) -> DataFrame:
    """A result with its exact amounts shown as doubles."""
    exact = [f.name for f in df.schema.fields if isinstance(f.dataType, DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in exact}) if exact else df
