"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the caller of every column expression multiplies planning time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # HotSpot does not compile methods over 8000 bytes; let Spark split such stages.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keypoint aggregation keeps small lists per run; the default of 128 keys
    # would push nearly every task to the sort-based path.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def build_session(app: str = "ridelabel", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
