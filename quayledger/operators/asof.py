"""As-of lookups: the last row at or before, or the first row at or after, a date.

Two forms. ``dated_steps`` + ``lookup_step`` serve a dated list, such as prices:
its rows become half-open intervals keyed by calendar year, so the lookup is an
equi join with a small residual and Spark broadcasts the list when it is small.
``asof_join`` serves two big tables: both sides are dealt by ranges of (key, time),
and the last hit before a range is carried into it, so a hot key spreads over ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .parts import PART_ROWS, carried, sampled_parts

# Years that a dated list is keyed by; days outside use the edge years, so none is left out.
FIRST_YEAR, LAST_YEAR = 1990, 2099


def _calendar_year(day: Column) -> Column:
    """Year of a day, clamped so that days outside the calendar use its edge years."""
    return F.least(F.greatest(F.year(day), F.lit(FIRST_YEAR)), F.lit(LAST_YEAR))


def dated_steps(prices: DataFrame, key: str, start: str, values: Sequence[str]) -> DataFrame:
    """Turn dated rows into intervals, one row per key, interval and calendar year.

    Of several rows with the same key and date the largest values win.
    """
    by_key = Window.partitionBy("_key").orderBy("_from")
    until = F.lead("_from").over(by_key)
    last_day = F.coalesce(F.date_sub("_until", 1), F.make_date(F.lit(LAST_YEAR), F.lit(12), F.lit(31)))
    years = F.sequence(
        _calendar_year(F.col("_from")),
        F.greatest(_calendar_year(F.col("_from")), _calendar_year(last_day)),
    )
    # One shuffle on the key serves both the grouping and the window.
    return (
        prices.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
        .select(F.col(key).alias("_key"), F.col(start).alias("_from"), F.struct(*values).alias("_values"))
        .repartition("_key")
        .groupBy("_key", "_from")
        .agg(F.max("_values").alias("_values"))
        .withColumn("_until", until)
        .select("_key", "_from", "_until", F.explode(years).alias("_year"), "_values.*")
    )


def lookup_step(
    df: DataFrame, steps: DataFrame, key: Column, day: Column, names: dict[str, str]
) -> DataFrame:
    """Left join the step in force on ``day`` for ``key``; ``names`` maps step columns to new names."""
    right = steps.select(
        "_key", "_from", "_until", "_year", *[F.col(c).alias(f"_{c}") for c in names]
    )
    in_force = (
        (key == F.col("_key"))
        & (_calendar_year(day) == F.col("_year"))
        & (day >= F.col("_from"))
        & (F.col("_until").isNull() | (day < F.col("_until")))
    )
    kept = [c for c in df.columns if c not in names.values()]
    return df.join(right, in_force, "left").select(
        *kept, *[F.col(f"_{c}").alias(name) for c, name in names.items()]
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    values: Sequence[str],
    *,
    right_on: str | None = None,
    right_by: Sequence[str] | None = None,
    direction: str = "backward",
    part_rows: int | None = PART_ROWS,
    spread: Sequence[str] | None = None,
) -> DataFrame:
    """Left as-of join of two big tables on equal keys.

    ``backward`` takes the right row with the largest ``right_on`` not after
    ``on``, ``forward`` the smallest not before it; ties go to the largest
    (smallest) ``values``. Every left row is returned once, with nulls when a
    key is null or nothing matches.

    Both sides are scanned together in ranges of about ``part_rows`` rows by
    (key, time), sampled when the plan is built; each range starts with the last
    hit of the key that the ranges before it end with. With ``part_rows`` None a
    key is one window group and no job runs beforehand, which suits tables that
    are already summed per key and day, and so have a bounded number of rows per key. Left rows without a key are dealt
    by their hash; there ``spread`` may name the columns it is taken of, and columns that no reader asks for are not carried.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"direction {direction!r}")
    forward = direction == "forward"
    right_on, right_by = right_on or on, list(right_by or by)
    keys = [f"_k{i}" for i in range(len(by))]

    def ordered(column: str) -> Column:
        return F.col(column).desc() if forward else F.col(column).asc()

    has_key = F.lit(True)
    for c in [*by, on]:
        has_key = has_key & F.col(c).isNotNull()
    # Left columns stand side by side instead of in a struct, so that those which no later step reads are pruned before the shuffle.
    carried_as = {c: f"_c{i}" for i, c in enumerate(left.columns)}
    tied = spread if spread and part_rows is None else left.columns
    # At one time hits come before searched rows, in the direction of the scan.
    searched = left.select(
        *[F.when(has_key, F.col(c)).alias(k) for c, k in zip(by, keys)],
        F.when(has_key, F.col(on)).alias("_on"),
        F.lit(0 if forward else 1).alias("_side"),
        F.xxhash64(*tied).alias("_tie"),
        *[F.col(c).alias(a) for c, a in carried_as.items()],
    )
    hits = right.dropna(subset=[*right_by, right_on]).select(
        *[F.col(c).alias(k) for c, k in zip(right_by, keys)],
        F.col(right_on).alias("_on"),
        F.lit(1 if forward else 0).alias("_side"),
        F.struct(F.col(right_on).alias("_on"), *values).alias("_hit"),
    )
    position = [*keys, "_on", "_side", "_tie"]
    # Rows without a key match nothing; hashing them over parts of their own keeps them apart.
    alone = -1 - F.pmod("_tie", F.lit(4096 if part_rows else 1 << 20))
    both = searched.unionByName(hits, allowMissingColumns=True)
    is_keyed = F.col("_on").isNotNull()
    if part_rows is None:
        # A number per key, the first thing that is sorted by: comparing numbers is much cheaper than comparing rows.
        both = both.withColumn("_part", F.when(is_keyed, F.xxhash64(*keys)).otherwise(alone).cast("bigint"))
    else:
        part = sampled_parts(both.filter(is_keyed), position, part_rows)
        both = both.withColumn("_part", F.when(is_keyed, part).otherwise(alone).cast("bigint"))
        pick, key = (F.min if forward else F.max), F.struct(*keys)
        ends = (
            both.filter(is_keyed)
            .groupBy("_part", *keys)
            .agg(pick("_hit").alias("_last"))
            .groupBy("_part")
            .agg(pick(F.struct(key.alias("_key"), "_last")).alias("_end"))
            .select("_part", "_end._key", F.col("_end._last").alias("_last"))
        )
        last = lambda over: F.last("_last", ignorenulls=True).over(over)
        before = carried(ends, last, backwards=forward).filter(F.col("_carry").isNotNull())
        # A carried hit stands at its own time, which no row of its key in the part is before.
        before = before.select("_part", "_key.*", "_carry._on", F.lit(1 if forward else 0).alias("_side"), F.col("_carry").alias("_hit"))
        both = both.unionByName(before, allowMissingColumns=True)
    scan = Window.partitionBy("_part", *keys).orderBy(ordered("_on"), ordered("_side"), ordered("_hit")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        both.withColumn("_found", F.last("_hit", ignorenulls=True).over(scan))
        .filter(F.col("_side") == (0 if forward else 1))
        .select(*[F.col(a).alias(c) for c, a in carried_as.items()], *[F.col(f"_found.{v}").alias(v) for v in values])
    )
