"""Ranges of like size over sampled positions, for scans that carry a state from one range to the next.

A window over a key is one task for that key. Here rows are dealt by ranges of their whole position, (key, time, tie), so
a key with half of all rows lies in half of the ranges, and even rows of one instant are cut apart by the tie. What a
range must know of the ranges before it fits in one row per range: the state of the last key there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a range, about; the most ranges; positions sampled for each, which bounds what comes to the driver.
PART_ROWS, MOST_PARTS, SAMPLED = 250_000, 4096, 32


def _literal(text: str | None, kind: str) -> str:
    """SQL of a constant, by its text; bytes as hexadecimal digits need no escapes."""
    return f"CAST(NULL AS {kind})" if text is None else f"CAST(CAST(X'{text.encode().hex()}' AS string) AS {kind})"


def sampled_parts(rows: DataFrame, position: Sequence[str], part_rows: int = PART_ROWS) -> Column:
    """The number of the range a row's ``position`` columns lie in, from 0, in the order of the columns.

    Runs two jobs over these columns alone: a count and a sample of at most SAMPLED rows a range. The cuts stand in the
    expression itself and a row is placed by bisection, so every task, also a repeated one, places it alike. Columns
    must be of types that can be read back from their text.
    """
    known = rows.select(*position)
    n = known.count()
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MOST_PARTS, max(-(-n // part_rows), min(4 * spread, n // 256), 1))
    if parts == 1:
        return F.lit(0)
    share = min(1.0, SAMPLED * parts / n)
    sample = known.sample(share, seed=17) if share < 1 else known
    texts = [F.col(c).cast("string") for c in position]
    found = sample.repartition(1).sortWithinPartitions(*position).select(*texts).collect()
    kinds = [f.dataType.simpleString() for f in known.schema.fields]
    cuts = sorted({len(found) * k // parts for k in range(1, parts)})
    structs = [", ".join(f"'{c}', {_literal(v, t)}" for c, v, t in zip(position, found[k], kinds)) for k in cuts if k < len(found)]
    if not structs:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(structs).bit_length()))]
    bounds = "sort_array(array({}))".format(", ".join(f"named_struct({s})" for s in structs))
    here = "named_struct({})".format(", ".join(f"'{c}', `{c}`" for c in position))
    return F.expr(
        f"aggregate(array({', '.join(map(str, steps))}), 0, (low, step) -> if(coalesce(get({bounds}, low + step - 1) <= {here}, false), low + step, low))"
    )


def carried(ends: DataFrame, state: Callable[[Window], Column], *, backwards: bool = False) -> DataFrame:
    """``_part``, ``_key`` and ``_carry``: for each part, the key the parts before it end with and that key's state there.

    ``ends`` has a row per part: ``_part``, ``_key`` (its last key) and what ``state`` needs. ``state`` puts an
    aggregate over the unbroken run of parts that end with one key, up to the part itself. A row per part is all there is, at most
    MOST_PARTS of them.
    """
    order = F.col("_part").desc() if backwards else F.col("_part").asc()
    along = Window.partitionBy(F.lit(0)).orderBy(order)
    starts = F.when(F.lag("_key").over(along) == F.col("_key"), 0).otherwise(1)
    run = Window.partitionBy("_run").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = ends.withColumn("_starts", starts).withColumn("_run", F.sum("_starts").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = runs.withColumn("_state", state(run))
    before = last.select("_part", F.lag("_key").over(along).alias("_key"), F.lag("_state").over(along).alias("_carry"))
    return before.filter(F.col("_key").isNotNull())
