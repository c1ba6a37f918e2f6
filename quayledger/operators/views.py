"""Ad-hoc views: filter, project, order and sum a result table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .calendar import in_range


def view(
    df: DataFrame,
    *,
    where: Sequence[Column] = (),
    period: tuple[date | None, date | None] | None = None,
    date_col: str = "date",
    select: Sequence[str | Column] = ("*",),
    order: Sequence[str | Column] = (),
    limit: int | None = None,
) -> DataFrame:
    """Rows of a period that meet every predicate, projected, ordered and limited on request."""
    out = df if period is None else df.filter(in_range(F.col(date_col), period))
    for predicate in where:
        out = out.filter(predicate)
    out = out.select(*select)
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def member(column: str, names: Sequence[str]) -> Column:
    """Predicate: the column is one of the names."""
    return F.col(column).isin(list(names))


def columns_like(df: DataFrame, part: str) -> list[str]:
    """Columns whose name contains a text."""
    return [c for c in df.columns if part in c]


def daily_sums(
    df: DataFrame, sums: dict[str, Column], date_col: str = "date", keys: Sequence[str] = ()
) -> DataFrame:
    """Sums per day, and per further keys."""
    return df.groupBy(date_col, *keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def latest_date(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The largest date of a table."""
    return df.agg(F.max(date_col).alias("latest"))
