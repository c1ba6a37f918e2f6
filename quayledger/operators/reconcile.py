"""Fallback joins, three-way reconciliation and difference reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _leveled(df: DataFrame, levels: Sequence[Sequence[str]], types: dict[str, DataType]) -> Column:
    """An array with a (level, key) for each level whose columns are all filled; a key has the columns of all levels, null
    where its own level lacks them."""
    names = list(dict.fromkeys(c for keys in levels for c in keys))
    kinds = {c: types.get(c, df.schema[c].dataType) for c in names}
    out = []
    for i, keys in enumerate(levels):
        filled = F.lit(True)
        for c in keys:
            filled = filled & F.col(c).isNotNull()
        key = F.struct(*[(F.col(c) if c in keys else F.lit(None)).cast(kinds[c]).alias(c) for c in names])
        out.append(F.when(filled, F.struct(F.lit(i).alias("_level"), key.alias("_key"))))
    return F.array_compact(F.array(*out))


def _filled(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in keys:
        out = out & F.col(c).isNotNull()
    return out


def grains(df: DataFrame, levels: Sequence[Sequence[str]], measures: dict[str, Column]) -> DataFrame:
    """Aggregates of ``df`` by every level's columns: ``_level``, ``_key`` and the measures.

    A level is an aggregation of its own, so that a reader of one level leaves out the others. Rows without a column of a
    level do not count there.
    """
    names = list(dict.fromkeys(c for keys in levels for c in keys))
    out = []
    for i, keys in enumerate(levels):
        by = [F.col(c).alias(f"_by_{c}") for c in keys] or [F.lit(0).alias("_by")]
        sums = df.filter(_filled(keys)).groupBy(*by).agg(*[m.alias(name) for name, m in measures.items()])
        key = F.struct(*[(F.col(f"_by_{c}") if c in keys else F.lit(None)).cast(df.schema[c].dataType).alias(c) for c in names])
        out.append(sums.select(F.lit(i).alias("_level"), key.alias("_key"), *measures))
    return reduce(DataFrame.unionByName, out)


def _copies(df: DataFrame, levels: Sequence[Sequence[str]], table: DataFrame) -> DataFrame:
    """Each row whole, and slim by each of its levels, under 128 bits of its hash.

    A whole row has no key and meets nothing; its level is a number below 0 of its hash, which spreads such rows. A lookup by
    copies joins all levels at once but writes each copy twice, so ``fallback_lookup`` goes by levels instead.
    """
    key_type = table.schema["_key"].dataType
    types = {f.name: f.dataType for f in key_type.fields}
    name = [F.xxhash64(F.lit(seed), *df.columns).alias(f"_name{seed}") for seed in (1, 2)]
    apart = (-1 - F.pmod(F.col("_name1"), F.lit(1 << 20))).cast("int")
    own = F.array(F.struct(F.struct(*df.columns).alias("_row"), apart.alias("_level"), F.lit(None).cast(key_type).alias("_key")))
    no_row = F.lit(None).cast(df.schema).alias("_row")
    others = F.transform(_leveled(df, levels, types), lambda x: F.struct(no_row, x["_level"].alias("_level"), x["_key"].alias("_key")))
    return df.select("*", *name).select("_name1", "_name2", F.explode(F.concat(own, others)).alias("_copy")).select("_name1", "_name2", "_copy.*")


def _at_level(df: DataFrame, level: int, keys: Sequence[str], table: DataFrame, values: Sequence[str]) -> DataFrame:
    """``df`` joined with one level's rows of ``table``, whose values stand as ``_here_`` and their name.

    The first join key is the key's hash, and the whole row's where a column is missing, which spreads such rows. It names
    all columns of ``df``, so whoever reads this join reads the same shuffle.
    """
    types = {f.name: f.dataType for f in table.schema["_key"].dataType.fields}
    key = F.struct(*[F.col(c).cast(types[c]).alias(c) for c in keys])
    number = F.when(_filled(keys), F.xxhash64(key)).otherwise(F.xxhash64(*df.columns))
    known = F.lit(False)
    for v in values:
        known = known | F.col(v).isNotNull()
    own = table.filter((F.col("_level") == level) & known).select(
        F.struct(*[F.col(f"_key.{c}").alias(c) for c in keys]).alias("_at"), *[F.col(v).alias(f"_here_{v}") for v in values]
    )
    return df.join(own, (number == F.xxhash64("_at")) & (key == F.col("_at")), "left").drop("_at")


def fallback_lookup(
    df: DataFrame, levels: Sequence[Sequence[str]], table: DataFrame, values: Sequence[str]
) -> DataFrame:
    """Look up each row's levels, from specific to coarse, and take the first value found.

    ``table`` has a row per ``_level`` and ``_key``, as ``grains`` gives it. Rows go whole through one join per level, and
    leave the chain as soon as they have all values: what is shuffled is each row once, and again for each level that
    leaves it without one. Every row is kept, equal rows as often as they stand.
    """
    out, rest = [], df
    for i, keys in enumerate(levels):
        joined = _at_level(rest, i, keys, table, values)
        found = [F.coalesce(f"_found_{v}", f"_here_{v}") if i else F.col(f"_here_{v}") for v in values]
        joined = joined.select(*df.columns, *[c.alias(f"_found_{v}") for c, v in zip(found, values)])
        done = _filled([f"_found_{v}" for v in values])
        out.append(joined.filter(done) if i < len(levels) - 1 else joined)
        rest = joined.filter(~done)
    kept = [c for c in df.columns if c not in values]
    return reduce(DataFrame.unionAll, out).select(*kept, *[F.col(f"_found_{v}").alias(v) for v in values])


def three_way(
    first: DataFrame,
    second: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    order: Sequence[str],
    scale: int = 3,
) -> DataFrame:
    """Rows only in ``first``, all rows of ``second``, and what ``second`` leaves of ``first`` where both have the key.

    The second side is summed per key and taken off once. The rows of ``first`` share it by the
    first measure, or bear it evenly where that sums to 0; shares are differences of rounded
    running parts in ``order``, so per key and measure the result sums to ``first`` for the keys
    of ``first``, and to ``second`` for the others. Rows left with no
    measure are dropped. A key has few rows of ``first``: it comes summed.
    """
    taken = second.groupBy(*keys).agg(*[F.sum(m).alias(f"_{m}") for m in measures])
    unit = 10**scale
    number = lambda c: (c * F.lit(unit)).cast("decimal(38,0)")
    by_key = Window.partitionBy(*keys)
    so_far = by_key.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    basis = number(F.col(measures[0]))
    weighed = (
        first.join(taken, list(keys))
        .withColumns({f"_{m}": number(F.col(f"_{m}")) for m in measures})
        .withColumns({"_whole": F.sum(basis).over(by_key), "_rows": F.count(F.lit(1)).over(by_key)})
        .withColumns({"_part": F.sum(basis).over(so_far), "_row": F.row_number().over(by_key.orderBy(*order))})
        .withColumns({"_start": F.col("_part") - basis, "_above": F.col("_row") - 1})
    )

    def running(m: str, done: str, row: str) -> str:
        """Whole units of the first rows' share, rounded half up in integers."""
        by_part = f"(2 * _{m} * {done} + _whole) div (2 * _whole)"
        return (
            f"CASE WHEN {row} = _rows THEN CAST(_{m} AS BIGINT) WHEN _whole <> 0 THEN {by_part}"
            f" ELSE (2 * _{m} * {row} + _rows) div (2 * _rows) END"
        )

    share = {m: F.expr(f"({running(m, '_part', '_row')}) - ({running(m, '_start', '_above')})") for m in measures}
    left_over = {
        m: (F.col(m) - share[m].cast("decimal(20,0)") / F.lit(unit)).cast(first.schema[m].dataType) for m in measures
    }
    something = F.lit(False)
    for m in measures:
        something = something | (F.col(m) != 0)
    # All shares are taken before a measure is replaced.
    residual = weighed.select(*[left_over.get(c, F.col(c)).alias(c) for c in first.columns]).filter(something)
    only_first = first.join(taken.select(*keys), list(keys), "left_anti").select(*first.columns)
    return only_first.unionByName(second.select(*first.columns)).unionByName(residual)


def difference_report(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, *, both: bool = True
) -> DataFrame:
    """Totals of both sides per key where they differ.

    With ``both`` only keys that both sides have are compared; without, a key that one side has lost counts
    as 0 there and is reported too.
    """
    one = left.groupBy(*keys).agg(F.sum(measure).alias(measure))
    other = right.groupBy(*keys).agg(F.sum(measure).alias(f"other_{measure}"))
    sides = one.join(other, list(keys), "inner" if both else "full")
    if not both:
        sides = sides.withColumns({c: F.coalesce(c, F.lit(0)) for c in (measure, f"other_{measure}")})
    difference = F.col(measure) - F.col(f"other_{measure}")
    return sides.withColumn("difference", difference).filter("difference <> 0")
