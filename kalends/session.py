"""A Spark session with the settings the plans rely on, for benches, tests and scripts."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A session on this machine. On a cluster, use the session it provides.

    Adaptive execution joins small shuffle partitions, turns a join into a broadcast once a
    side is measured to be small, and splits hot keys of shuffled joins.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName("kalends")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
