"""Session settings that the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str = "local[*]", name: str = "quillstone", **more: str) -> SparkSession:
    """A session with those settings; shuffle partitions follow the master's cores unless given."""
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
