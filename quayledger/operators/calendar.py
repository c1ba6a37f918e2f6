"""Public holidays, day names, week tables and date ranges."""

from __future__ import annotations

from calendar import monthrange
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Day labels from Sunday on.
WEEKDAYS = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
# Month and day of the holidays on a fixed date.
FIXED_HOLIDAYS = [
    (1, 1), (1, 2), (5, 1), (6, 18), (6, 29), (8, 15), (11, 1), (12, 8), (12, 25),
]
# A holiday kept from a given year on (month, day, first year).
LATER_FIXED_HOLIDAYS = [(2, 1, 2026)]
# Holidays of one year only.
ONE_TIME_HOLIDAYS = [date(2025, 10, 11), date(2025, 10, 13), date(2025, 10, 27)]
# Holidays by days from Easter Sunday.
EASTER_OFFSETS = [-2, -1, 0, 1, 60]


def easter_sql(year: str) -> str:
    """Easter Sunday of a year: Oudin's computus in integer arithmetic, days from 28 March."""
    century, golden = f"({year} div 100)", f"({year} % 19)"
    age = f"(({century} - {century} div 4 - (8 * {century} + 13) div 25 + 19 * {golden} + 15) % 30)"
    moon = f"({age} - ({age} div 28) * (1 - (29 div ({age} + 1)) * ((21 - {golden}) div 11)))"
    weekday = f"(({year} + {year} div 4 + {moon} + 2 - {century} + {century} div 4) % 7)"
    return f"date_add(make_date({year}, 3, 28), CAST({moon} - {weekday} AS INT))"


def holidays_of(years: DataFrame) -> DataFrame:
    """One row per public holiday date of the years in column ``year``."""
    fixed = [f"make_date(year, {m}, {d})" for m, d in FIXED_HOLIDAYS]
    fixed += [
        f"if(year >= {since}, make_date(year, {m}, {d}), NULL)"
        for m, d, since in LATER_FIXED_HOLIDAYS
    ]
    moving = [f"date_add(easter, {days})" for days in EASTER_OFFSETS]
    once = [f"if(year = {day.year}, DATE '{day}', NULL)" for day in ONE_TIME_HOLIDAYS]
    dates = years.select(F.col("year").cast("int").alias("year")).distinct().withColumn(
        "easter", F.expr(easter_sql("year"))
    )
    return dates.select(
        F.expr(f"array({', '.join(fixed)})").alias("fixed"),
        F.expr(f"array({', '.join(moving + once)})").alias("other"),
    ).select(
        F.expr("""explode(array_distinct(array_compact(
            fixed || transform(fixed, day -> if(dayofweek(day) = 1, date_add(day, 1), NULL)) || other
        )))""").alias("date")
    )


def public_holidays(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """One row per public holiday date of the years from first to last."""
    return holidays_of(spark.range(first_year, last_year + 1).select(F.col("id").alias("year")))


def is_public_holiday(date_col: str) -> Column:
    """Whether a date is a public holiday, computed from the date itself, for any year."""
    day = f"`{date_col}`"

    def fixed(d: str) -> str:
        known = ", ".join(str(100 * m + n) for m, n in FIXED_HOLIDAYS)
        since = "".join(
            f" OR (month({d}) = {m} AND day({d}) = {n} AND year({d}) >= {first})"
            for m, n, first in LATER_FIXED_HOLIDAYS
        )
        return f"(100 * month({d}) + day({d}) IN ({known}){since})"

    offsets = ", ".join(map(str, EASTER_OFFSETS))
    once = ", ".join(f"DATE '{d}'" for d in ONE_TIME_HOLIDAYS)
    before = f"date_sub({day}, 1)"
    return F.expr(
        f"{fixed(day)} OR (dayofweek({day}) = 2 AND {fixed(before)}) OR {day} IN ({once})"
        f" OR datediff({day}, {easter_sql(f'year({day})')}) IN ({offsets})"
    )


def with_day_name(df: DataFrame, date_col: str = "date", name: str = "day_name") -> DataFrame:
    """Add the day label: PH on public holidays, else Sun..Sat."""
    weekdays = F.array(*[F.lit(d) for d in WEEKDAYS])
    label = F.when(is_public_holiday(date_col), "PH").otherwise(
        F.get(weekdays, F.dayofweek(date_col) - 1)
    )
    return df.withColumn(name, label)


def date_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day of a closed date range."""
    days = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date"))


def week_table(days: DataFrame, date_col: str = "date") -> DataFrame:
    """First and last day of each numbered week of a year, for the years the days fall in.

    Day n of the year belongs to week (n + 1) div 7 + 1, as in the weekly reports.
    """
    week = F.floor((F.dayofyear(date_col) + 1) / 7).cast("int") + 1
    return days.groupBy(F.year(date_col).alias("year"), week.alias("week_num")).agg(
        F.min(date_col).alias("start_date"), F.max(date_col).alias("end_date")
    )


def month_range(year: int, month: int) -> tuple[date, date]:
    """First and last day of a month."""
    return date(year, month, 1), date(year, month, monthrange(year, month)[1])


def two_month_range(year: int, month: int) -> tuple[date, date]:
    """First day of the month before, last day of the month."""
    before = (year - 1, 12) if month == 1 else (year, month - 1)
    return date(*before, 1), month_range(year, month)[1]


def year_range(year: int) -> tuple[date, date]:
    """First and last day of a year."""
    return date(year, 1, 1), date(year, 12, 31)


def in_range(column: Column, period: tuple[date | None, date | None] | None) -> Column:
    """Closed date-range predicate, which reaches the scan; an open side or no period passes."""
    first, last = period or (None, None)
    passes = F.lit(True)
    if first is not None:
        passes = passes & (column >= F.lit(first))
    if last is not None:
        passes = passes & (column <= F.lit(last))
    return passes
