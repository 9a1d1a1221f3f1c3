"""Session builder with the settings that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(app: str = "sievemark", **conf: str) -> SparkSession:
    """A session with UTC times and adaptive execution; other settings, such as the master, come from ``conf`` or the cluster."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
