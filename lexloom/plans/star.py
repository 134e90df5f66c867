"""The star schema: stored tables, SQL views, and its constraints as checks.

Files enforce no keys, so every declared constraint becomes a count of the rows
that break it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions.dates import calendar
from lexloom.operators.bridges import pair_with_all
from lexloom.operators.groups import duplicated_keys, orphan_keys
from lexloom.schemas import STAR_SCHEMAS
from lexloom.sources.readers import read_table
from lexloom.sources.writers import overwrite

# The keys, references, required columns and defaults of the model.

UNIQUE_KEYS = {
    "dim_date": [("date_key",), ("full_date",)],
    "dim_document_type": [("type_id",), ("type_code",)],
    "dim_institution": [("institution_id",), ("institution_code",)],
    "dim_topic": [("topic_id",), ("topic_code",)],
    "dim_country": [("country_id",), ("country_code",)],
    "fact_documents": [("document_id",), ("celex_number",)],
    "bridge_document_topic": [("document_id", "topic_id")],
    "bridge_document_country": [("document_id", "country_id")],
    "document_references": [("source_document_id", "target_document_id", "reference_type")],
}

FOREIGN_KEYS = [
    ("fact_documents", "publication_date_key", "dim_date", "date_key"),
    ("fact_documents", "type_id", "dim_document_type", "type_id"),
    ("fact_documents", "institution_id", "dim_institution", "institution_id"),
    ("bridge_document_topic", "document_id", "fact_documents", "document_id"),
    ("bridge_document_topic", "topic_id", "dim_topic", "topic_id"),
    ("bridge_document_country", "document_id", "fact_documents", "document_id"),
    ("bridge_document_country", "country_id", "dim_country", "country_id"),
    ("document_references", "source_document_id", "fact_documents", "document_id"),
    ("document_references", "target_document_id", "fact_documents", "document_id"),
]

NULLABLE = {"description", "institution_type", "category", "join_year", "article_count", "text_length", "reference_count", "amendment_count"}

DEFAULTS = {
    "fact_documents": {"article_count": 0, "text_length": 0, "reference_count": 0, "amendment_count": 0},
    "document_references": {"reference_type": "cites"},
}


def store_star(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Store tables under their contract: column order, types and defaults."""
    for name, df in tables.items():
        contract = df.sparkSession.createDataFrame([], STAR_SCHEMAS[name]).schema
        filled = df.na.fill(DEFAULTS[name]) if name in DEFAULTS else df
        overwrite(filled.select(*[F.col(f.name).cast(f.dataType) for f in contract.fields]), f"{folder}/{name}.parquet")


def read_star(spark: SparkSession, folder: str, views: bool = False) -> dict[str, DataFrame]:
    """All tables of a stored star; ``views`` also registers them for ``spark.sql``."""
    tables = {name: read_table(spark, folder, name, schema) for name, schema in STAR_SCHEMAS.items()}
    if views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables


def date_dimension(spark: SparkSession, first_day: str, last_day: str) -> DataFrame:
    """The calendar between two ISO dates, both included."""
    days = spark.range(1).select(F.to_date(F.lit(first_day)).alias("first_day"), F.to_date(F.lit(last_day)).alias("last_day"))
    return calendar(days)


def affected_countries(fact: DataFrame, countries: DataFrame, leaver_code: str, last_date_key: int) -> DataFrame:
    """The country bridge: every document affects every member state.

    A state that left counts only for documents up to ``last_date_key``.
    """
    member = (F.col("publication_date_key") <= last_date_key) | ~F.col("country_code").eqNullSafe(leaver_code)
    documents = fact.select("document_id", "publication_date_key")
    pairs = pair_with_all(documents, countries, "country_id", member, carry=["country_code"])
    return pairs.select("document_id", "country_id")


def constraint_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per constraint of the given tables: kind, columns, violations."""

    def finding(df: DataFrame, table: str, kind: str, columns: str, violations) -> DataFrame:
        return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
            F.lit(table).alias("table"), F.lit(kind).alias("kind"), F.lit(columns).alias("columns"), "violations"
        )

    findings = []
    for name, df in tables.items():
        required = [c for c in df.columns if c not in NULLABLE]
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        findings.append(
            nulls.unpivot([], required, "columns", "violations").select(
                F.lit(name).alias("table"), F.lit("not null").alias("kind"), "columns", "violations"
            )
        )
        for key in UNIQUE_KEYS[name]:
            findings.append(finding(duplicated_keys(df, key), name, "unique", ", ".join(key), F.sum(F.col("n") - 1)))
    for child, key, parent, parent_key in FOREIGN_KEYS:
        if child in tables and parent in tables:
            orphans = orphan_keys(tables[child], key, tables[parent], parent_key)
            findings.append(finding(orphans, child, "foreign key", key, F.sum("n")))
    return reduce(DataFrame.unionByName, findings)
