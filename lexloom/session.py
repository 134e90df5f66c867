"""Session settings for stand-alone use; jobs also accept any other session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app_name: str = "lexloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the jobs are tuned for.

    ``conf`` uses ``__`` for dots: ``spark__sql__shuffle__partitions="4000"``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Splits a hot (year, doc_type) partition when the silver layer is written.
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shuffle_width(spark: SparkSession) -> int:
    """The session's shuffle partition count, the unit in which work is split."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
