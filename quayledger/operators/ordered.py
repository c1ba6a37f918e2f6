"""The row before, and the running count, of rows in time order within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .parts import PART_ROWS, carried, sampled_parts


def previous_row(
    df: DataFrame,
    by: str,
    order: Sequence[str],
    values: Sequence[str],
    *,
    prefix: str = "previous_",
    count_name: str = "occurrence",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add columns of the row before within ``by``, and the row's number there.

    ``order`` starts with the time column; ties go by ``values``, equal rows in any order. Rows are scanned in ranges of
    about ``part_rows`` rows by (key, order), sampled when the plan is built; each range starts with one extra row that
    holds the last row of the key the ranges before it end with, and how many rows of it they hold. A key is cut
    wherever a range ends, so its share of the rows is not the size of a task. Rows without a key or time have no row
    before and no number.
    """
    keyed = F.col(by).isNotNull() & F.col(order[0]).isNotNull()
    places = [F.col(c).alias(f"_o{i}") for i, c in enumerate([*order, *values])]
    rows = df.select(
        F.when(keyed, F.col(by)).alias("_key"),
        *places,
        F.xxhash64(*df.columns).alias("_tie"),
        F.struct(*values).alias("_values"),
        F.struct(*df.columns).alias("_row"),
    )
    position = ["_key", *[f"_o{i}" for i in range(len(places))], "_tie"]
    has_key = F.col("_key").isNotNull()
    part = sampled_parts(rows.filter(has_key), position, part_rows)
    # Rows without a key are hashed over parts of their own, which nothing is carried into.
    rows = rows.withColumn("_part", F.when(has_key, part).otherwise(-1 - F.pmod("_tie", F.lit(4096))).cast("bigint"))
    place = F.struct(*position)
    ends = (
        rows.filter(has_key)
        .groupBy("_part", "_key")
        .agg(F.max(F.struct(place.alias("_place"), "_values")).alias("_tail"), F.count(F.lit(1)).alias("_rows"))
        .groupBy("_part")
        .agg(F.max(F.struct("_key", "_tail", "_rows")).alias("_end"))
        .select("_part", "_end._key", F.col("_end._tail._values").alias("_values"), F.col("_end._rows").alias("_rows"))
    )
    state = lambda over: F.struct(F.last("_values").over(over).alias("_values"), F.sum("_rows").over(over).alias("_rows"))
    before = carried(ends, state).withColumnRenamed("_key", "_carried_key")
    # The carried row has no key of its own, so it comes first in its part.
    in_part = Window.partitionBy("_part").orderBy(*position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of_key = Window.partitionBy("_part", "_key").orderBy(*position[1:])
    carry = lambda c: F.first(c, ignorenulls=True).over(in_part)
    number = F.row_number().over(of_key)
    return (
        rows.unionByName(before, allowMissingColumns=True)
        .repartition("_part")  # serves both windows
        .withColumns({"_number": number, "_before": F.lag("_values").over(of_key), "_carried_key": carry("_carried_key"), "_carry": carry("_carry")})
        .filter(F.col("_row").isNotNull())
        .withColumn("_goes_on", F.coalesce(F.col("_carried_key") == F.col("_key"), F.lit(False)))
        .withColumn("_previous", F.when(F.col("_goes_on") & (F.col("_number") == 1), F.col("_carry._values")).otherwise(F.col("_before")))
        .select(
            "_row.*",
            *[F.when(has_key, F.col(f"_previous.{v}")).alias(prefix + v) for v in values],
            F.when(has_key, F.col("_number") + F.when(F.col("_goes_on"), F.col("_carry._rows")).otherwise(F.lit(0))).alias(count_name),
        )
    )
