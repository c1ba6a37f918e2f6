"""Overtime classification and splitting of time spans at cut-off times.

Times of day are integer seconds since midnight, so a span is plain integer
arithmetic and every band is one ``greatest(0, least(..) - greatest(..))``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import values as V


def is_special(day: Column) -> Column:
    """True on Sundays and public holidays."""
    return day.isin(V.SPECIAL_DAYS)


def label_by_cutoff(day: Column, time: Column) -> Column:
    """Overtime label of one time: special days after 16:00, weekdays after 17:00."""
    special = is_special(day)
    return (
        F.when(special & (time > V.H16), V.OVERTIME_200)
        .when(special | (time > V.H17), V.OVERTIME_150)
        .otherwise(V.NORMAL)
    )


def label_by_clock(day: Column, time: Column) -> Column:
    """Overtime label of a scale reading: the small hours come first, 16:00 is inclusive."""
    special = is_special(day)
    return (
        F.when((time >= 0) & (time < V.H07), V.OVERTIME_150)
        .when(special & (time >= V.H16), V.OVERTIME_200)
        .when((special & (time < V.H16)) | (time > V.H17), V.OVERTIME_150)
        .otherwise(V.NORMAL)
    )


def overlap(start: Column, end: Column, low: int | None, high: int | None) -> Column:
    """Seconds of [start, end) that fall in [low, high)."""
    upper = end if high is None else F.least(end, F.lit(high))
    lower = start if low is None else F.greatest(start, F.lit(low))
    return F.greatest(F.lit(0), upper - lower)


def ends_next_day(start: Column, end: Column) -> Column:
    """A span whose end lies before its start and no later than 07:59:59."""
    return (end < start) & (end <= V.EARLY_END)


def span_end(start: Column, end: Column) -> Column:
    """End of the span on the start day's clock, past 24:00 when it crosses midnight."""
    return F.when(ends_next_day(start, end), end + V.DAY_SECONDS).otherwise(end)


def valid_span(start: Column, end: Column) -> Column:
    """Spans that run forward, across midnight or not."""
    return (end >= start) | ends_next_day(start, end)


def salt_bands(day: Column, start: Column, end: Column) -> tuple[Column, Column, Column]:
    """Seconds at 1.0, 1.5 and 2.0 of a span that may cross midnight.

    Weekday: up to 17:00, 17:00 to midnight, after midnight.
    Special day: nothing at 1.0, up to 16:00 at 1.5, the rest at 2.0.
    """
    special, stop = is_special(day), span_end(start, end)
    normal = F.when(special, F.lit(0)).otherwise(overlap(start, stop, None, V.H17))
    at_150 = F.when(special, overlap(start, stop, None, V.H16)).otherwise(
        overlap(start, stop, V.H17, V.DAY_SECONDS)
    )
    at_200 = F.when(special, overlap(start, stop, V.H16, None)).otherwise(
        overlap(start, stop, V.DAY_SECONDS, None)
    )
    return normal, at_150, at_200


def forklift_bands(day: Column, start: Column, end: Column) -> tuple[Column, Column, Column]:
    """Whole minutes at normal, 150% and 200% of a same-day span.

    A special-day span that ends exactly at 16:00 stays at the normal rate.
    """
    special = is_special(day)
    at_150 = F.when(
        special, F.when(end == V.H16, F.lit(0)).otherwise(overlap(start, end, None, V.H16))
    ).otherwise(overlap(start, end, V.H17, None))
    at_200 = F.when(special, overlap(start, end, V.H16, None)).otherwise(F.lit(0))
    minutes_150, minutes_200 = whole(at_150, 60), whole(at_200, 60)
    return whole(end - start, 60) - minutes_150 - minutes_200, minutes_150, minutes_200


def salt_forklift_bands(day: Column, start: Column, end: Column) -> tuple[Column, Column, Column]:
    """Seconds at normal, 150% and 200% of a forklift on a salt operation.

    Same bands as the salt itself but for two kept special-day habits: a span
    ending exactly at 16:00 counts as normal, and a span from before 16:00 past
    midnight shows its hours before 16:00 both as normal and at 150%.
    """
    special = is_special(day)
    normal, at_150, at_200 = salt_bands(day, start, end)
    ends_on_cutoff = special & (end == V.H16) & (start < V.H16)
    overnight = special & ends_next_day(start, end)
    return (
        F.when(ends_on_cutoff, end - start).when(overnight, at_150).otherwise(normal),
        F.when(ends_on_cutoff, F.lit(0)).otherwise(at_150),
        at_200,
    )


def whole(amount: Column, unit: int) -> Column:
    """Whole units in an integer amount, truncated towards zero."""
    return (amount / F.lit(unit)).cast("bigint")


def moment(day: Column, seconds: Column) -> Column:
    """Timestamp of a time of day on a date."""
    return day.cast("timestamp_ntz") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def hhmm(seconds: Column) -> Column:
    """HH:MM text of a non-negative number of seconds."""
    hours = whole(seconds, 3600)
    minutes = whole(seconds - hours * 3600, 60)
    text = hours.cast("string")
    return F.concat(
        F.lpad(text, F.greatest(F.length(text), F.lit(2)), F.lit("0")),
        F.lit(":"),
        F.lpad(minutes.cast("string"), 2, "0"),
    )

