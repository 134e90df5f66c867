"""Layers that appear whole or not at all, and partial re-runs that touch only what changed.

A published layer is a folder of versions and a table of commits.  A version is
written to a folder of its own while its rows are measured; only if the
measures pass, one commit row that names the folder is appended.  Readers take
the folder of the last commit.  A job that fails or is killed, and a gate that stops it, leave
a folder that no commit names, so the layer before stays.  One job writes a layer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.plans.medallion import read_silver, to_silver
from lexloom.plans.quality import QualityReport, quality_measures, raise_on_findings
from lexloom.schemas import SILVER_PARTITION_COLUMNS, SILVER_SCHEMA
from lexloom.sources.readers import read_parquet
from lexloom.sources.scratch import materialize
from lexloom.sources.writers import append, replace_partitions

_COMMIT = "number LONG, folder STRING, rows LONG, committed_at TIMESTAMP"


@dataclass(frozen=True)
class Commit:
    """A version that readers see."""

    number: int
    folder: str
    rows: int


def last_commit(spark: SparkSession, path: str) -> Commit | None:
    """The version that readers of a layer follow; None before the first."""
    commits = f"{path.rstrip('/')}/commits"
    place = spark._jvm.org.apache.hadoop.fs.Path(commits)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    last = spark.read.schema(_COMMIT).parquet(commits).orderBy(F.desc("number"), F.desc("committed_at")).first()
    return last and Commit(last.number, last.folder, last.rows)


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The last committed version of a layer."""
    commit = last_commit(spark, path)
    if commit is None:
        raise FileNotFoundError(f"{path} has no committed version")
    return read_parquet(spark, f"{path.rstrip('/')}/{commit.folder}", schema)


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    measures: Sequence[Column] = (),
    gate: Callable[[dict], None] | None = None,
) -> Commit:
    """Write a version of a layer, measured on the way, and commit it if ``gate`` does not raise.

    ``df`` is computed once: its rows and ``measures`` are counted by the write itself, behind
    the exchange that evens out the files, where a repeated task is not counted twice.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = last_commit(spark, path)
    folder = f"versions/{uuid.uuid4().hex}"
    found = Observation()
    rows = F.count(F.lit(1)).alias("__rows")
    written = (df.hint("rebalance", *partition_by) if partition_by else df).observe(found, rows, *measures)
    writer = written.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{folder}")
    counts = found.get
    commit = Commit(before.number + 1 if before else 1, folder, counts.pop("__rows"))
    if gate:
        gate(counts)
    row = spark.createDataFrame([Row(number=commit.number, folder=commit.folder, rows=commit.rows)], "number LONG, folder STRING, rows LONG")
    append(row.withColumn("committed_at", F.current_timestamp()).coalesce(1), f"{path}/commits")
    return commit


def publish_silver(
    spark: SparkSession, bronze: str | DataFrame, path: str, strict: bool = False, max_year: int | None = None
) -> tuple[Commit, QualityReport]:
    """Silver from bronze as a published layer: cleaned, written and checked in one pass over the texts.

    ``strict`` raises ``DataQualityError`` on any finding, and the version is not committed.
    """
    rows = to_silver(read_parquet(spark, bronze) if isinstance(bronze, str) else bronze)
    reports: list[QualityReport] = []

    def gate(counts: dict) -> None:
        reports.append(QualityReport.of(counts))
        if strict:
            raise_on_findings(reports[0])

    commit = publish(rows, path, SILVER_PARTITION_COLUMNS, quality_measures(max_year=max_year), gate)
    return commit, reports[0]


def read_published_silver(spark: SparkSession, path: str) -> DataFrame:
    return read_published(spark, path, SILVER_SCHEMA).select(*SILVER_SCHEMA.names)


def refresh_silver(spark: SparkSession, bronze: DataFrame, silver_path: str) -> DataFrame:
    """Bring changed documents into a stored silver layer; returns the ``(year, doc_type)`` that were replaced.

    ``bronze`` holds all rows of every document that is new or changed.  Their rows
    replace those of the same ``celex_id``; the directories they lie in are written
    again, all others keep their files.  An id names its year and type, so a document stays
    in its directory.  A missing id is an id like any other.
    """
    changed = materialize(to_silver(bronze), "changed-silver")
    touched = materialize(changed.select(*SILVER_PARTITION_COLUMNS).distinct(), "touched-directories")
    ids = materialize(changed.select(F.col("celex_id").alias("__id")).distinct(), "changed-ids")
    stored = read_silver(spark, silver_path)
    places = touched.select(*[F.col(c).alias(f"__{c}") for c in SILVER_PARTITION_COLUMNS])
    same_place = [stored[c].eqNullSafe(places[f"__{c}"]) for c in SILVER_PARTITION_COLUMNS]
    # Stored directories prune the scan; ids that came again are left behind.
    kept = stored.join(places, same_place, "left_semi").join(ids, F.col("celex_id").eqNullSafe(F.col("__id")), "left_anti")
    replace_partitions(kept.unionByName(changed), silver_path, SILVER_PARTITION_COLUMNS)
    return touched
