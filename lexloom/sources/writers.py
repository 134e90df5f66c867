"""Sinks, and what they left on disk."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.sources.scratch import materialize

#: Numbers as differences, in the bits they need: for rows that one task is to read in great number.
PACKED = {"compression": "zstd", "parquet.writer.version": "v2"}


def overwrite(df: DataFrame, path: str) -> None:
    """Idempotent Parquet write, one file per task."""
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    """Add rows to a stored table (``INSERT ... SELECT``)."""
    df.write.mode("append").parquet(path)


def overwrite_partitioned(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Hive-partitioned overwrite with few, evenly sized files.

    The rebalance shuffle brings the rows of a directory together, so a small
    partition gets one file, and adaptive execution splits a hot one over
    several tasks, which a plain ``repartition(columns)`` could not.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Replace the directories that ``df`` has rows for; all others keep their files.

    New files are staged and moved when all are written, so ``df`` may read from ``path``.
    """
    rows = df.hint("rebalance", *columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy(*columns).parquet(path)


def overwrite_json(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.mode("overwrite").json(path)


def overwrite_compact(df: DataFrame, path: str, files: int | None = None, exchange: bool = True) -> None:
    """Overwrite with as few files as the size warrants.

    ``files`` forces a count (1 for a tiny table).  ``coalesce`` has no shuffle
    of its own and would pull the stage before it into that many tasks, so the
    rows are exchanged instead; by default adaptive execution picks the count.
    ``exchange=False`` coalesces all the same, to bring down the files of a wide job without
    an exchange: its tasks store their rows first, so that one of the few that write the files
    reads its share of the rows, once, and nothing of what they came from.
    """
    if files is None:
        if not exchange:
            raise ValueError("without an exchange, say how many files")
        compact = df.hint("rebalance")
    elif exchange:
        compact = df.repartition(files)
    else:
        compact = _stored_in_groups(df, files).coalesce(files)
    compact.write.mode("overwrite").parquet(path)


def _stored_in_groups(df: DataFrame, groups: int) -> DataFrame:
    """Store ``df`` by its own tasks; small files, too, are read by as many tasks as there are groups of them."""
    stored = materialize(df, "compact-rows", **PACKED)
    paths = sorted(unquote(p) for p in stored.inputFiles())
    reader = df.sparkSession.read.schema(df.schema)
    return reduce(DataFrame.union, [reader.parquet(*paths[k::groups]) for k in range(min(groups, len(paths)))])


def overwrite_csv(df: DataFrame, path: str, date_format: str = "yyyy-MM-dd") -> None:
    """CSV with a header line."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", date_format).csv(path)


def stored_rows(spark: SparkSession, path: str) -> int:
    """Rows that landed on disk, from the Parquet footers alone."""
    return spark.read.parquet(path).count()


def layout_report(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Files, bytes and rows per partition directory of a stored table."""
    located = stored.select(*columns, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
    per_file = located.groupBy(*columns, "file").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    return per_file.groupBy(*columns).agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("rows").alias("rows")
    )
