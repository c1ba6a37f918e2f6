"""Compare every registered query with its oracle over one directory of given tables."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from .derived import GIVEN
from .oracle import oracle_queries
from .queries import registered_queries


def _cell(value: object) -> object:
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "-"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> dict[str, str]:
    """Names of the queries that differ from their oracle, with what differs."""
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    found, oracles = {}, oracle_queries()
    for name, query in registered_queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = query(spark, sf_dir)
            ours = _rows(df.columns, [tuple(r) for r in df.collect()])
            spent = time.time() - started
            if name not in oracles:
                print(f"{name}: {len(ours)} rows, no oracle, {spent:.1f}s")
                continue
            result = con.execute(oracles[name])
            columns = [d[0] for d in result.description]
            theirs = _rows(columns, result.fetchall())
        except Exception as error:  # noqa: BLE001 - report and go on
            found[name] = f"failed: {str(error)[:600]}"
            print(f"{name}: {found[name]}")
            continue
        if sorted(columns) != sorted(df.columns):
            found[name] = f"columns {sorted(set(columns) ^ set(df.columns))}"
        elif ours != theirs:
            ours_only, theirs_only = set(ours) - set(theirs), set(theirs) - set(ours)
            found[name] = (
                f"rows {len(ours)} / {len(theirs)}, {len(ours_only)} differ, "
                f"{sorted(df.columns)} {sorted(ours_only)[:1]} {sorted(theirs_only)[:1]}"
            )
        print(f"{name}: {found.get(name, f'{len(ours)} rows agree')}, {spent:.1f}s", flush=True)
    return found


if __name__ == "__main__":
    from quayledger.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    bad = differences(session, sys.argv[1], sys.argv[2:])
    print(f"{len(bad)} differ: {sorted(bad)}")
