"""Session settings the operators are written against."""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # write a few output directories at a time without sorting the task's rows first
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    app_name: str = "curbair",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session with the settings above.

    Leave ``shuffle_partitions`` unset on a cluster and give the cluster's own
    default instead: AQE merges small partitions but cannot add missing ones, so
    the starting number should be generous for the largest shuffle.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    wanted = dict(SESSION_SETTINGS)
    if shuffle_partitions:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    wanted.update(settings or {})
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_session(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session made elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.adaptive.enabled"):
        spark.conf.set(key, SESSION_SETTINGS[key])
    return spark
