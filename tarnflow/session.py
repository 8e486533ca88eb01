"""Session settings the library is tuned for.

Nothing in the library depends on the session time zone: all time arithmetic is done on
``TIMESTAMP_NTZ``. The zone is pinned to UTC only so that ad-hoc SQL gives the same answers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parquet timestamps without a zone stay TIMESTAMP_NTZ.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(app_name: str = "tarnflow", master: str | None = None, **overrides) -> SparkSession:
    """Create (or get) a session. ``overrides`` are extra settings, dots written as given keys."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
