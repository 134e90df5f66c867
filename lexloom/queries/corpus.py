"""Identifiers, labels, text cleaning, profiles and quality of the corpus."""

from pyspark.sql import functions as F

from lexloom.functions.celex import celex_doc_type, with_celex_components, with_doc_type_label, with_sector_label
from lexloom.functions.text import clean_body, trim_whitespace
from lexloom.plans.quality import quality_summary
from lexloom.queries.model import PARSED_SQL, SECTOR_LABEL_SQL, SILVER_SQL, TYPE_LABEL_SQL, BRONZE_SQL, bronze, silver
from lexloom.queries.registry import query


@query("celex_parse", f"WITH {PARSED_SQL} SELECT doc_id, celex_id, sector, year, doc_type FROM parsed")
def celex_parse(spark, folder):
    return with_celex_components(bronze(spark, folder).select("doc_id", "celex_id"))


@query(
    "celex_label",
    f"WITH {PARSED_SQL} SELECT doc_id, doc_type, {TYPE_LABEL_SQL} AS doc_type_label, {SECTOR_LABEL_SQL} AS sector_label FROM parsed",
)
def celex_label(spark, folder):
    parsed = with_celex_components(bronze(spark, folder).select("doc_id", "celex_id"))
    labelled = parsed.transform(with_doc_type_label).transform(with_sector_label)
    return labelled.select("doc_id", "doc_type", "doc_type_label", "sector_label")


@query("clean_text", f"WITH {SILVER_SQL} SELECT doc_id, title, md5(text) AS text_md5, CAST(length(text) AS INTEGER) AS text_length FROM silver")
def clean_text(spark, folder):
    cleaned = bronze(spark, folder).select("doc_id", trim_whitespace("title").alias("title"), clean_body("text").alias("text"))
    return cleaned.select("doc_id", "title", F.md5("text").alias("text_md5"), F.length("text").alias("text_length"))


@query(
    "silver",
    f"""WITH {SILVER_SQL}
    SELECT celex_id, sector, year, doc_type, doc_type_label, title, md5(text) AS text_md5,
      CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts FROM silver""",
)
def silver_layer(spark, folder):
    layer = silver(spark, folder)
    return layer.select(
        "celex_id", "sector", "year", "doc_type", "doc_type_label", "title",
        F.md5("text").alias("text_md5"), F.size("eurovoc_concepts").alias("n_concepts"),
    )


@query("doc_type_dist", f"WITH {PARSED_SQL} SELECT doc_type, COUNT(*) AS n FROM parsed GROUP BY doc_type")
def doc_type_dist(spark, folder):
    ids = bronze(spark, folder).select(celex_doc_type("celex_id").alias("doc_type"))
    return ids.groupBy("doc_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "corpus_profile",
    f"""WITH {BRONZE_SQL} SELECT doc_id, celex_id, CAST(length(title) AS INTEGER) AS title_len,
      CAST(length(text) AS INTEGER) AS text_len, CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts FROM bronze""",
)
def corpus_profile(spark, folder):
    return bronze(spark, folder).select(
        "doc_id", "celex_id", F.length("title").alias("title_len"), F.length("text").alias("text_len"),
        F.size("eurovoc_concepts").alias("n_concepts"),
    )


@query(
    "concept_stats",
    f"""WITH {BRONZE_SQL} SELECT celex_id, CAST(length(title) AS INTEGER) AS title_len, CAST(length(text) AS INTEGER) AS text_len,
      CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts
    FROM bronze ORDER BY n_concepts DESC NULLS LAST, doc_id LIMIT 5""",
)
def concept_stats(spark, folder):
    profile = corpus_profile(spark, folder)
    return profile.orderBy(F.desc("n_concepts"), "doc_id").limit(5).drop("doc_id")


@query(
    "quality_report",
    f"""WITH {SILVER_SQL}, flags AS (
      SELECT celex_id IS NULL AS c, year IS NULL AS y, doc_type IS NULL AS d, text IS NULL AS t,
        text IS NULL OR length(text) < 50 AS s, year IS NULL OR year < 1951 OR year > 2030 AS r FROM silver)
    SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (c) AS null_celex_id, COUNT(*) FILTER (y) AS null_year,
      COUNT(*) FILTER (d) AS null_doc_type, COUNT(*) FILTER (t) AS null_text, COUNT(*) FILTER (s) AS short_text_rows,
      COUNT(*) FILTER (r) AS year_out_of_range_rows, COUNT(*) FILTER (c OR y OR d OR t OR s OR r) AS violating_rows,
      COUNT(*) FILTER (c) + COUNT(*) FILTER (y) + COUNT(*) FILTER (d) + COUNT(*) FILTER (t) + COUNT(*) FILTER (s)
        + COUNT(*) FILTER (r) AS total_violations
    FROM flags""",
)
def quality_report(spark, folder):
    return quality_summary(silver(spark, folder), max_year=2030)
