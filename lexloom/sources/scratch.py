"""Intermediate tables in the folder all executors share.

A written table cuts lineage, survives the loss of executors and gives the
optimizer the real size of what was computed, so it broadcasts a small result
and shuffles a large one without a hint.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="lexloom-")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from the setting or ``setCheckpointDir``; a local one only in local mode."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    return _local_folder()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for one table of this application."""
    return f"{shared_folder(spark)}/lexloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once, with options of the Parquet writer, and return the stored table."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
