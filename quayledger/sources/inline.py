"""Small inline relations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def inline_table(
    spark: SparkSession, columns: dict[str, str], rows: Sequence[Sequence[str]]
) -> DataFrame:
    """A VALUES relation of text cells cast to the named column types.

    Unlike a Python list handed to ``createDataFrame`` it stays in the plan as a
    local relation of known size, which Spark broadcasts by itself.
    """
    def cell(value: str) -> str:
        return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"

    values = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns.items())
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({', '.join(columns)})")
