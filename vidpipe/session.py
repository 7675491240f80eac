"""A session as the library expects it."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "vidpipe", **conf: str) -> SparkSession:
    """UTC clock and adaptive execution; other settings by keyword, dots as double underscores."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
