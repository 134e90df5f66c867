"""Bronze, silver and gold: ingest, clean and label, derive the graph tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.celex import with_celex_components, with_doc_type_label
from lexloom.functions.text import with_clean_text
from lexloom.operators.groups import one_row_per_key
from lexloom.plans.quality import assert_silver_quality
from lexloom.schemas import BRONZE_SCHEMA, GOLD_DOCUMENTS_SCHEMA, SILVER_PARTITION_COLUMNS, SILVER_SCHEMA
from lexloom.sources.readers import REJECTED, read_corpus, read_json_lines, read_parquet
from lexloom.sources.writers import overwrite, overwrite_compact, overwrite_partitioned, stored_rows


def ingest(
    spark: SparkSession,
    source: str | DataFrame,
    output: str,
    split: str | None = None,
    split_column: str | None = None,
    subset_size: int | None = None,
) -> int:
    """Store a corpus in bronze shape; returns the rows on disk."""
    overwrite(read_corpus(spark, source, split, split_column, subset_size), output)
    return stored_rows(spark, output)


@dataclass(frozen=True)
class JsonIngest:
    """What an ingest of JSON lines stored and what it set aside."""

    rows: int
    rejected: int


def ingest_json(spark: SparkSession, source: str, output: str, rejects: str) -> JsonIngest:
    """Store a JSON-lines corpus in bronze shape; lines that do not fit go to ``rejects`` with their file.

    Both counts come from the write.  The source is read again only if there are lines to set aside.
    """
    lines = read_json_lines(spark, source, BRONZE_SCHEMA)
    counts = Observation()
    bad = F.col(REJECTED).isNotNull()
    counted = lines.observe(counts, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
    overwrite(counted.filter(~bad).select(*BRONZE_SCHEMA.names), output)
    found = JsonIngest(**counts.get)
    # With what could be read of the record: all of it, since Spark only checks the columns it reads.
    aside = lines.select(F.col("_metadata.file_path").alias("file"), F.col(REJECTED).alias("line"), F.struct(*BRONZE_SCHEMA.names).alias("read"))
    overwrite(aside.filter("line IS NOT NULL") if found.rejected else spark.createDataFrame([], aside.schema), rejects)
    return found


def to_silver(bronze: DataFrame) -> DataFrame:
    """Parsed, labelled and cleaned documents: narrow work, no shuffle."""
    steps = bronze.transform(with_celex_components).transform(with_doc_type_label).transform(with_clean_text)
    return steps.select(*SILVER_SCHEMA.names)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The stored silver layer in contract order, partition types pinned."""
    return read_parquet(spark, path, SILVER_SCHEMA).select(*SILVER_SCHEMA.names)


def bronze_to_silver(spark: SparkSession, bronze_path: str, silver_path: str, strict: bool = False) -> int:
    """Build the silver layer, partitioned by year and type; returns the rows on disk.

    ``strict`` raises ``DataQualityError`` before anything is published, so the layer
    that was there stays.
    """
    silver = to_silver(read_parquet(spark, bronze_path))
    if strict:
        assert_silver_quality(silver)
    overwrite_partitioned(silver, silver_path, SILVER_PARTITION_COLUMNS)
    return stored_rows(spark, silver_path)


def build_documents(silver: DataFrame) -> DataFrame:
    """Document nodes, one per ``celex_id``.

    Of several rows the one with a title, then the longest text, then the lowest
    text digest and title is kept, however the input is partitioned.
    """
    preference = [F.col("title").isNull(), F.length("text").desc(), F.md5("text"), F.col("title")]
    return one_row_per_key(silver.select(*GOLD_DOCUMENTS_SCHEMA.names), "celex_id", preference)


def _topic_codes(silver: DataFrame, *keep: str) -> DataFrame:
    # Repeats within a document go before the explode; a missing array makes no row.
    codes = F.explode(F.array_distinct("eurovoc_concepts")).alias("eurovoc_code")
    return silver.select(*keep, codes).filter(F.col("eurovoc_code").isNotNull())


def build_topics(silver: DataFrame) -> DataFrame:
    """Topic nodes: every code in use, once."""
    return _topic_codes(silver).distinct()


def build_belongs_to(silver: DataFrame) -> DataFrame:
    """Document-topic edges, each once."""
    return _topic_codes(silver, "celex_id").distinct()


def silver_to_gold(
    spark: SparkSession, silver_path: str, gold_path: str, strict: bool = False, files: int | None = None
) -> dict[str, int]:
    """Store the three graph tables; returns the rows of each on disk.

    Document nodes keep the file layout of their tasks: moving every text again
    to even out files would be the largest shuffle of the job.  ``files=1`` gives
    single-file tables for a small corpus.
    """
    silver = read_silver(spark, silver_path)
    if strict:
        assert_silver_quality(silver)
    documents = build_documents(silver)
    if files is None:
        overwrite(documents, f"{gold_path}/documents")
    else:
        overwrite_compact(documents, f"{gold_path}/documents", files)
    overwrite_compact(build_belongs_to(silver), f"{gold_path}/belongs_to", files)
    # The stored edges hold every code already, and are far smaller than the texts' layer.
    stored_edges = read_parquet(spark, f"{gold_path}/belongs_to")
    overwrite_compact(stored_edges.select("eurovoc_code").distinct(), f"{gold_path}/topics", files)
    return {name: stored_rows(spark, f"{gold_path}/{name}") for name in ("documents", "topics", "belongs_to")}
