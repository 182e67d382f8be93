"""Session builder with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "filmlens", master: str | None = None, **conf: str) -> SparkSession:
    """Start (or reuse) a session.

    Adaptive execution coalesces small shuffle partitions, turns joins with a
    small measured side into broadcasts and splits skewed join partitions, so
    no partition count is fixed here; callers pass ``conf`` to override.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
