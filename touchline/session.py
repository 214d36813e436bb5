"""A session with the settings the engine is meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Run-time plans: merge small partitions, split skewed joins, broadcast by measured size.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Pages are wide rows: keep the batches that go to Python small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session; on a cluster leave `master` out and let spark-submit set it."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
