"""Result sinks: CSV, parquet and tables; one dataset, a group with its dependencies, or one period of a table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, timedelta
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.calendar import in_range

#: The partition column of tables that are replaced by period.
MONTH = "month"


@dataclass(frozen=True)
class Metrics:
    """What a write has seen: its rows, those that keep every rule, and for each rule the rows that break it."""

    rows: int
    valid: int
    broken: dict[str, int] = field(default_factory=dict)

    @property
    def empty(self) -> bool:
        return self.rows == 0


@dataclass(frozen=True)
class SaveResult:
    """Outcome of one write."""

    name: str
    path: str
    error: Exception | None = None
    metrics: Metrics | None = None


class NeededFailed(RuntimeError):
    """A dataset was not made because one that it is made from failed."""


def _observed(df: DataFrame, counts: Mapping[str, Column]) -> tuple[DataFrame, Callable[[str], int]]:
    """``df`` with conditions counted while it is written, and the counts by name to read after that."""
    seen = Observation()
    counted = df.observe(seen, *[F.count_if(c).alias(name) for name, c in counts.items()])
    # An input known to be empty is never scanned and has no counts.
    return counted, lambda name: seen.get.get(name) or 0


def measured(
    df: DataFrame, rules: Mapping[str, Column] | None = None, also: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Callable[[], Metrics], Callable[[str], int]]:
    """``df`` with its rows and rules counted while it is written; the counts, and those of ``also`` by name, to read after.

    The counts come from the job that writes, so a check costs no scan of its own. A rule that is null counts as broken.
    """
    kept = {name: F.coalesce(rule, F.lit(False)) for name, rule in (rules or {}).items()}
    every = F.lit(True)
    for rule in kept.values():
        every = every & rule
    broken = {f"broken {name}": ~rule for name, rule in kept.items()}
    counted, count = _observed(df, {"rows": F.lit(True), "valid": every, **broken, **(also or {})})
    return counted, lambda: Metrics(count("rows"), count("valid"), {name: count(f"broken {name}") for name in kept}), count


def save_csv(df: DataFrame, path: str, delimiter: str = ",", rules: Mapping[str, Column] | None = None) -> Metrics:
    """Write CSV part files with a header, replacing what is there; what was seen comes back."""
    counted, read, _ = measured(df, rules)
    counted.write.mode("overwrite").option("header", True).option("sep", delimiter).csv(path)
    return read()


def save_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, rules: Mapping[str, Column] | None = None) -> Metrics:
    """Write parquet, replacing what is there; what was seen comes back."""
    counted, read, _ = measured(df, rules)
    counted.write.mode("overwrite").partitionBy(*(partition_by or [])).parquet(path)
    return read()


def save_table(df: DataFrame, table: str, rules: Mapping[str, Column] | None = None) -> Metrics:
    """Create or replace a table with a result; what was seen comes back."""
    counted, read, _ = measured(df, rules)
    counted.write.mode("overwrite").saveAsTable(table)
    return read()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the time of one write, which for a table of the catalog is no option of the writer."""
    was = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def months_of(period: tuple[date, date]) -> list[str]:
    """The months of a period as ``yyyy-MM``; the period must hold them whole."""
    first, last = period
    if first.day != 1 or (last + timedelta(days=1)).day != 1 or last < first:
        raise ValueError(f"not whole months: {first} to {last}")
    count = (last.year - first.year) * 12 + last.month - first.month + 1
    numbers = [first.year * 12 + first.month - 1 + k for k in range(count)]
    return [f"{n // 12:04d}-{n % 12 + 1:02d}" for n in numbers]


def save_period(df: DataFrame, table: str, period: tuple[date, date], date_col: str = "date", rules: Mapping[str, Column] | None = None) -> Metrics:
    """Replace whole months of a table with the rows of ``df`` dated in them.

    The table is partitioned by month and made on the first call. Only partitions of the period are written or dropped, also
    those that no longer have rows; the files of other months stay as they are. Rows of other dates are left out.
    """
    spark, months = df.sparkSession, months_of(period)
    rows = df.filter(in_range(F.col(date_col), period)).withColumn(MONTH, F.date_format(date_col, "yyyy-MM"))
    in_month = {m: F.col(MONTH) == m for m in months}
    # A month is one task's file, unless it is large enough to be split.
    counted, read, count = measured(rows.hint("rebalance", MONTH), rules, in_month)
    if not spark.catalog.tableExists(table):
        counted.write.partitionBy(MONTH).saveAsTable(table)
        return read()
    columns = spark.table(table).columns
    if set(columns) != set(rows.columns):
        raise ValueError(f"{table}: columns {sorted(set(columns) ^ set(rows.columns))} differ")
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        counted.select(*columns).write.mode("overwrite").insertInto(table)
    for month in months:  # what the write had no rows for is still the old month's
        if not count(month):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({MONTH} = '{month}')")
    return read()


def table_period(spark: SparkSession, table: str, period: tuple[date, date], date_col: str = "date") -> DataFrame:
    """The rows of a table by period within the period's dates; only the partitions of its months are read."""
    first, last = period
    held = F.col(MONTH).between(f"{first:%Y-%m}", f"{last:%Y-%m}")
    return spark.table(table).filter(held & in_range(F.col(date_col), period))


def save_group(
    builders: Mapping[str, Callable[[Mapping[str, DataFrame]], DataFrame]],
    root: str,
    needs: Mapping[str, Sequence[str]] | None = None,
    wanted: Sequence[str] | None = None,
    rules: Mapping[str, Mapping[str, Column]] | None = None,
) -> list[SaveResult]:
    """Write datasets as CSV in the order of their dependencies; a failure is recorded and the rest go on.

    ``builders`` take the results they need by name. A result that is used more than once, written or needed, is made
    once: it is staged as parquet under ``root``, and its readers and its CSV come from there. What hangs on a failed
    dataset is not tried and says so. Staged results are removed at the end. Results stand in the order of ``wanted``
    (every builder, if not given) with their metrics.
    """
    wanted, needs, rules = list(wanted or builders), needs or {}, rules or {}
    TopologicalSorter(needs).prepare()  # a circle of needs is an error before anything is made
    chosen: dict[str, None] = {}

    def choose(name: str) -> None:
        for other in needs.get(name, ()):
            choose(other)
        chosen[name] = None

    for name in wanted:
        choose(name)
    uses = {n: (n in wanted) + sum(n in needs.get(m, ()) for m in chosen) for n in chosen}
    staging = f"{root}/_staged-{uuid.uuid4().hex}"
    made: dict[str, DataFrame] = {}
    results: dict[str, SaveResult] = {}
    session: SparkSession | None = None
    try:
        for name in TopologicalSorter({n: needs.get(n, ()) for n in chosen}).static_order():
            path, metrics = f"{root}/{name}", None
            try:
                for other in needs.get(name, ()):
                    if other not in made:
                        raise NeededFailed(f"{name} needs {other}: {results[other].error}") from results[other].error
                df = builders[name]({n: made[n] for n in needs.get(name, ())})
                if uses[name] > 1:
                    session = df.sparkSession
                    df.write.parquet(f"{staging}/{name}")
                    df = session.read.schema(df.schema).parquet(f"{staging}/{name}")
                if name in wanted:
                    metrics = save_csv(df, path, rules=rules.get(name))
                made[name] = df
                results[name] = SaveResult(name, path, metrics=metrics)
            except Exception as error:  # noqa: BLE001 - one bad dataset must not stop the others
                results[name] = SaveResult(name, path, error)
    finally:
        if session is not None:
            folder = session.sparkContext._jvm.org.apache.hadoop.fs.Path(staging)
            folder.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return [results[n] for n in wanted]
