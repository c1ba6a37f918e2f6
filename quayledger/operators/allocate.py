"""Pro-rata allocation of a group total over the measured rows of the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from .parts import PART_ROWS, sampled_parts


def with_group_totals(
    df: DataFrame, keys: Sequence[str], totals: dict[str, Column]
) -> DataFrame:
    """Add group sums to every row.

    Partial sums are combined before the shuffle and joined back, so that a hot
    group is split by the skew join instead of being windowed in one task. Null
    keys form a group, as in a window.
    """
    # A struct of the keys equals another null by null, and the sums are already dealt by it.
    sums = df.groupBy(F.struct(*keys).alias("_group")).agg(*[F.sum(c).alias(name) for name, c in totals.items()])
    return df.withColumn("_key", F.struct(*keys)).join(sums, F.col("_key") == F.col("_group"), "left").drop("_key", "_group")


def share(part: Column, whole: Column, target: Column) -> Column:
    """``part / whole * target`` in doubles, 0 when the whole is not positive."""
    ratio = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return F.when(whole > 0, ratio * target.cast("double")).otherwise(F.lit(0.0))


def shared_out(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: str,
    target: str,
    *,
    name: str,
    scale: int = 2,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Add each row's part of its group's ``target`` by ``weight``; the parts of a group sum to the target exactly.

    A part is the difference of two rounded running parts in ``order``: what the rows so far bear of the target, half up at
    ``scale`` decimals, less what those before bear. ``target`` is the same decimal in all rows of a group; weights are
    integers or decimals. Null keys form a group. A group whose weights sum to 0 or less gets 0, and so do null weights.

    Rows are scanned once, in sampled ranges of (keys, order): a group that ends in another range than it begins brings its
    total, and the weight before, as numbers of the few groups at the ranges' ends. No group is one task, and the rows are
    shuffled once.
    """
    kind = df.schema[weight].dataType
    digits = kind.scale if isinstance(kind, DecimalType) else 0
    rows = df.select(
        F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("_key"),
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
        F.xxhash64(*df.columns).alias("_tie"),
        (F.coalesce(F.col(weight), F.lit(0)) * F.lit(10**digits)).cast("decimal(28,0)").alias("_weight"),
        F.struct(*df.columns).alias("_row"),
    )
    position = [*[f"_k{i}" for i in range(len(keys))], *[f"_o{i}" for i in range(len(order))], "_tie"]
    rows = rows.withColumn("_part", sampled_parts(rows, position, part_rows))
    of_part = rows.groupBy("_part", "_key").agg(F.sum("_weight").alias("_held")).groupBy("_part")
    edges = of_part.agg(F.array_distinct(F.array(F.min(F.struct("_key", "_held")), F.max(F.struct("_key", "_held")))).alias("_edges"))
    along = Window.partitionBy("_key").orderBy("_part")
    ends = (
        edges.select("_part", F.explode("_edges").alias("_edge"))
        .select("_part", "_edge.*")
        .withColumn("_total", F.sum("_held").over(Window.partitionBy("_key")))
        .withColumn("_before", F.sum("_held").over(along) - F.col("_held"))
    )
    heads = ends.groupBy("_part").agg(F.collect_list(F.struct("_key", "_total", "_before")).alias("_ends"))  # two of a part
    in_part = Window.partitionBy("_part").orderBy(F.col("_row").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    group = Window.partitionBy("_part", "_key")
    so_far = group.orderBy(*position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = F.get(F.filter("_ends", lambda x: x["_key"] == F.col("_key")), 0)
    wide = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(38,0)")
    scanned = (
        rows.unionByName(heads, allowMissingColumns=True)
        .repartition("_part")
        .withColumns({"_ends": F.first("_ends", ignorenulls=True).over(in_part), "_in_part": F.sum("_weight").over(group), "_running": F.sum("_weight").over(so_far)})
        .filter(F.col("_row").isNotNull())
        .withColumn("_here", here)
        .withColumn("_whole", F.coalesce("_here._total", "_in_part").cast("decimal(38,0)"))
        .withColumn("_through", wide(F.col("_running")) + wide(F.col("_here._before")))
        .withColumn("_units", (F.col(f"_row.{target}") * F.lit(10**scale)).cast("decimal(38,0)"))
    )
    borne = lambda c: f"sign(_units * {c}) * ((2 * abs(_units * {c}) + _whole) div (2 * _whole))"
    units = F.when(F.col("_whole") > 0, F.expr(f"{borne('_through')} - {borne('(_through - _weight)')}")).otherwise(F.lit(0))
    part = (units.cast("decimal(28,0)") / F.lit(10**scale)).cast(f"decimal({min(38, 18 + scale)},{scale})")
    return scanned.select("_row.*", part.alias(name))
