"""Rollups of dated services into periods, and history before a date, by running totals.

``running_totals`` sums a log once per key and day, runs the sums along the days, and gives the state at every
day that is asked for. A period is then the state at its end less the state before its start: two equi joins on
(key, day), however long the period is and however many services it holds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType


def running_totals(
    facts: DataFrame,
    points: DataFrame,
    keys: Sequence[str],
    day: str,
    daily: dict[str, Column],
    running: dict[str, Callable[[Column], Column]],
) -> DataFrame:
    """The state of each key's log at the end of every day in ``facts`` or ``points``, one row per key and day.

    ``daily`` aggregates the rows of a day; ``running`` names what is kept of them, each as a function that puts an
    aggregate over all days so far. Rows of ``points`` carry no values: whatever ``daily`` aggregates is null in them.
    Both sides are reduced to a row per key and day before anything is ordered, so a key is a window of at most as
    many rows as it has days, whatever share of the rows it holds. Null keys (but for those told apart by a caller)
    and null days should be dropped before.
    """
    by_day = (
        facts.unionByName(points.select(*keys, day), allowMissingColumns=True)
        .groupBy(*keys, day)
        .agg(*[c.alias(name) for name, c in daily.items()])
    )
    so_far = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return by_day.select(*keys, day, *[run(so_far).alias(name) for name, run in running.items()])


def _sum_type(df: DataFrame, measure: str) -> str:
    """The type of a measure's sum, for types whose running sums can be subtracted without loss."""
    kind = df.schema[measure].dataType
    if isinstance(kind, DecimalType):
        return f"decimal({min(38, kind.precision + 20)},{kind.scale})"
    if isinstance(kind, IntegralType):
        return "bigint"
    raise TypeError(f"{measure}: {kind.simpleString()} sums are not exact; cast it to a decimal")


def roll_up_periods(
    periods: DataFrame,
    services: DataFrame,
    *,
    by: Sequence[tuple[str, str]],
    start: str,
    end: str,
    service_date: str,
    sums: dict[str, str],
    days_name: str,
    extra_keys: Sequence[str] = (),
) -> DataFrame:
    """Sums of the services dated within each period, for equal ``by`` columns.

    ``by`` pairs a period column with a service column. The sums are differences of running totals at two days, so a
    period costs the same whether it lasts a day or to the end of the calendar, and measures must be integers or
    decimals. Every period keeps its row, equal ones too; without services its sums are null, as they are where the
    period is open, ends before it starts or has a null key. ``days_name`` counts the days with a service;
    ``extra_keys`` of the services split the rows further, and a period has a row for each it holds, or one row of
    nulls.
    """
    keys = [f"_by{i}" for i in range(len(by))]
    types = {name: _sum_type(services, source) for name, source in sums.items()}
    facts = services.dropna(subset=[s for _, s in by] + [service_date]).select(
        *[F.col(s).alias(k) for (_, s), k in zip(by, keys)],
        F.col(service_date).alias("_day"),
        *extra_keys,
        *[F.col(source).alias(f"_sum_{name}") for name, source in sums.items()],
        F.lit(1).alias("_served"),
    )
    spread, groups = periods, list(keys)
    if extra_keys:
        # Each service counts under its extra keys and once more under all of them together.
        groups += ["_split", *extra_keys]
        kinds = {c: facts.schema[c].dataType for c in extra_keys}
        split = F.struct(F.lit(True).alias("_split"), *extra_keys)
        whole = F.struct(F.lit(False).alias("_split"), *[F.lit(None).cast(kinds[c]).alias(c) for c in extra_keys])
        facts = facts.withColumn("_group", F.explode(F.array(split, whole))).drop(*extra_keys).select("*", "_group.*").drop("_group")
        held = facts.select(*groups).distinct()
        of_key = F.lit(True)
        for (p, _), k in zip(by, keys):
            of_key = of_key & (F.col(p) == F.col(k))
        spread = periods.join(held, of_key, "left").drop(*keys).withColumn("_split", F.coalesce("_split", F.lit(False)))
    counted = F.col(end) >= F.col(start)
    key_of = [F.col(p).alias(k) for (p, _), k in zip(by, keys)]
    ends = F.explode(F.array(F.date_sub(start, 1), F.col(end))).alias("_day")
    points = spread.filter(counted).select(*key_of, *groups[len(keys) :], ends).dropna(subset=keys)
    names = ["_served", *[f"_sum_{n}" for n in sums], *[f"_rows_{n}" for n in sums]]
    state = running_totals(
        facts,
        points,
        groups,
        "_day",
        {
            "_served": F.max("_served"),
            **{f"_sum_{n}": F.sum(f"_sum_{n}") for n in sums},
            **{f"_rows_{n}": F.count(f"_sum_{n}") for n in sums},
        },
        {n: (lambda over, n=n: F.sum(n).over(over)) for n in names},
    )

    def at(df: DataFrame, day: Column, side: str) -> DataFrame:
        """``df`` with the state at the end of ``day`` in a column."""
        there = state.select(*[F.col(g).alias(f"_of_{g}") for g in groups], F.col("_day").alias("_at"), F.struct(*names).alias(side))
        same = counted & (day == F.col("_at"))
        for (p, _), k in zip(by, keys):
            same = same & (F.col(p) == F.col(f"_of_{k}"))
        for g in groups[len(keys) :]:
            same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
        return df.join(there, same, "left").drop("_at", *[f"_of_{g}" for g in groups])

    found = at(at(spread, F.date_sub(start, 1), "_before"), F.col(end), "_through")
    within = lambda n: F.coalesce(F.col(f"_through.{n}"), F.lit(0)) - F.coalesce(F.col(f"_before.{n}"), F.lit(0))
    out = found.withColumn(days_name, within("_served").cast("bigint"))
    if extra_keys:
        out = out.filter(F.col("_split") == (F.col(days_name) > 0))
    totals = {n: F.when(within(f"_rows_{n}") > 0, within(f"_sum_{n}")).cast(types[n]).alias(n) for n in sums}
    return out.select(*periods.columns, *extra_keys, *totals.values(), days_name)


def history_before(
    df: DataFrame,
    log: DataFrame,
    *,
    by: str,
    on: str,
    log_by: str,
    log_on: str,
    details: Sequence[str],
) -> DataFrame:
    """Per row: how many log rows of the same key are dated up to it, with the first and latest one.

    The log's state is worked out for the days that are asked for, one row per key and day, and joined on both: the
    searched rows are neither ordered nor compared with the log. Of several log rows on the latest day the largest
    details show.
    """
    facts = log.select(
        F.col(log_by).alias("_key"), F.col(log_on).alias("_day"), F.struct(*[F.col(d).alias(f"latest_{d}") for d in details]).alias("_details")
    ).dropna(subset=["_key", "_day"])
    points = df.select(F.col(by).alias("_key"), F.col(on).alias("_day")).dropna()
    logged = F.col("_rows") > 0
    state = running_totals(
        facts,
        points,
        ["_key"],
        "_day",
        {"_rows": F.count("_details"), "_details": F.max("_details")},
        {
            "earlier": lambda so_far: F.sum("_rows").over(so_far),
            "first": lambda so_far: F.min(F.when(logged, F.col("_day"))).over(so_far),
            "_last": lambda so_far: F.last(F.when(logged, F.struct(F.col("_day").alias("latest"), "_details")), ignorenulls=True).over(so_far),
        },
    )
    found = df.join(state, (F.col(by) == F.col("_key")) & (F.col(on) == F.col("_day")), "left")
    return found.select(*df.columns, F.coalesce("earlier", F.lit(0)).alias("earlier"), "first", "_last.latest", "_last._details.*")


def earlier_rows(
    df: DataFrame, log: DataFrame, *, by: str, on: str, log_by: str, log_on: str
) -> DataFrame:
    """Every log row of the same key at or before each row, as a left join.

    The result grows with the history of each row, so restrict ``df`` to the
    rows of a statement first; ``history_before`` serves whole tables.
    """
    return df.join(log, (F.col(by) == F.col(log_by)) & (F.col(on) >= F.col(log_on)), "left")
