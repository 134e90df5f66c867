"""Star storage that later queries profit from: months that prune, and buckets that join without an exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexloom.session import shuffle_width
from lexloom.sources.scratch import materialize

MONTH = "month_key"


def month_key(day: Column | str) -> Column:
    """The month of a day as a number like 199704; what facts and calendar meet on."""
    return (F.year(day) * 100 + F.month(day)).cast("int")


def store_by_month(fact: DataFrame, day: str, path: str) -> None:
    """Store a fact in one directory per month of ``day``; rows without a day have their own."""
    rows = fact.withColumn(MONTH, month_key(day))
    rows.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def join_calendar(fact: DataFrame, calendar: DataFrame, day: str) -> DataFrame:
    """Facts with the calendar's columns for their day, the fact reading only months the calendar has left.

    ``fact`` was stored by ``store_by_month``; ``calendar`` has ``full_date`` and any filters.  The
    months take part in the join, so whatever filters the calendar prunes directories of the
    fact at run time, without a literal in the query.
    """
    days = calendar.withColumn("__month", month_key("full_date"))
    joined = fact.join(days, (F.col(MONTH) == F.col("__month")) & (F.col(day) == F.col("full_date")))
    return joined.drop("__month", MONTH)


def store_bucketed(df: DataFrame, table: str, key: str, path: str, buckets: int | None = None) -> None:
    """Store a table in buckets of ``key``, each sorted by it.

    Tables of the same number of buckets join and aggregate on their keys without an exchange, however often.
    ``buckets`` defaults to the session's shuffle width; size it so that a bucket fits a task.
    """
    buckets = buckets or shuffle_width(df.sparkSession)
    # One file a bucket: the rows are dealt out as the buckets are.
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def linked_measures(spark: SparkSession, fact: str, bridge: str, key: str, measure: str, link: str) -> DataFrame:
    """Per fact of a bucketed fact and bridge table: its measure, its links and the share of each.

    Counted and joined where the buckets lie.  A key with many links is one bucket's work, but only its count leaves it.
    """
    links = spark.table(bridge).groupBy(F.col(key).alias("__key")).agg(F.count(link).alias("links"))
    linked = spark.table(fact).join(links, F.col(key) == F.col("__key"), "left")
    counted = F.coalesce("links", F.lit(0).cast("long"))
    return linked.select(key, measure, counted.alias("links"), (F.col(measure) / F.nullif(counted, F.lit(0).cast("long"))).alias("share"))


def compact_files(spark: SparkSession, path: str, columns: Sequence[str], target_bytes: int = 128 << 20) -> DataFrame:
    """Bring small files of a partitioned table together; returns files and bytes of each directory that was written again.

    Files go into bins of about ``target_bytes`` in the order of their names, from file sizes alone: rows are read
    once, to be written.  Directories whose files already are as few as their bytes need keep them.
    """
    stored = spark.read.parquet(path)
    files = stored.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    # Metadata only: Parquet reads no column for it.
    files = materialize(files.groupBy(*columns, "file").agg(F.max("size").alias("size")), "file-sizes")
    before = Window.partitionBy(*columns).orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    binned = files.withColumn("bin", F.floor(F.coalesce(F.sum("size").over(before), F.lit(0)) / F.lit(target_bytes)).cast("int"))
    per_place = files.groupBy(*[F.col(c).alias(f"__{c}") for c in columns]).agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"))
    small = materialize(per_place.filter(F.col("files") > F.ceil(F.col("bytes") / F.lit(target_bytes))), "small-files")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in columns]
    binned = binned.join(small, same, "left_semi")
    # Places are numbered by a hash, so that a bin has one number and meets another in a task only by chance.
    binned = binned.select(F.col("file").alias("__file"), F.xxhash64(*columns, "bin").alias("bin"))
    bins = materialize(binned, "file-bins")
    tasks = bins.select(F.count_distinct("bin")).first()[0]
    if tasks:
        rows = stored.select("*", F.col("_metadata.file_path").alias("__path")).join(bins, F.col("__path") == F.col("__file"))
        # A bin is one task's rows, and so one file of its directory.
        dealt = rows.repartition(tasks, "bin").drop("__path", "__file", "bin")
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)
    return small.select(*[F.col(f"__{c}").alias(c) for c in columns], "files", "bytes")
