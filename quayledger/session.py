"""Session settings the plans are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Methods above 8000 bytes of code are never compiled by the JVM, so a stage that
    # would generate one runs faster without whole-stage code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    # Call-site capture doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


#: Those of the settings that a running session takes, and that decide how fast and how evenly the plans run.
RUNTIME = ("spark.sql.adaptive.forceOptimizeSkewedJoin", "spark.sql.codegen.hugeMethodLimit")


def tuned(spark: SparkSession) -> SparkSession:
    """The session with the runtime settings the plans are written for, where it has none of its own."""
    for key in RUNTIME:
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, SETTINGS[key])
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **more: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("quayledger")
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), **more}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
