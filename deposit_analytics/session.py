"""Session settings the reports are meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "deposit-analytics",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **settings: str,
) -> SparkSession:
    """Gets or creates a session; on a cluster the launcher gives the master."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        # Adaptive execution merges partitions but never adds any.
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions)).config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_partitions)
        )
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
