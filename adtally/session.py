"""Session settings shared by tests, benchmark and interactive use."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with UTC time, ANSI arithmetic and adaptive execution.

    On a cluster leave `master` and `shuffle_partitions` unset and let spark-submit decide; adaptive
    execution then coalesces or splits the shuffle partitions by their measured size.
    """
    builder = (
        SparkSession.builder.appName("adtally")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
