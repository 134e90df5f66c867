"""Layer contracts and the fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

# The contracts of the layers and of the star schema.
#
# Spark relaxes nullable=False when it reads files, so these flags document the
# contract; lexloom.plans.quality is what enforces it.

BRONZE_SCHEMA = T.StructType(
    [
        T.StructField("celex_id", T.StringType(), nullable=False),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType(), nullable=False),
        T.StructField("eurovoc_concepts", T.ArrayType(T.StringType())),
    ]
)

SILVER_SCHEMA = T.StructType(
    [
        T.StructField("celex_id", T.StringType(), nullable=False),
        T.StructField("sector", T.StringType(), nullable=False),
        T.StructField("year", T.IntegerType(), nullable=False),
        T.StructField("doc_type", T.StringType(), nullable=False),
        T.StructField("doc_type_label", T.StringType(), nullable=False),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType(), nullable=False),
        T.StructField("eurovoc_concepts", T.ArrayType(T.StringType())),
    ]
)

GOLD_DOCUMENTS_SCHEMA = T.StructType(
    [
        T.StructField("celex_id", T.StringType(), nullable=False),
        T.StructField("title", T.StringType()),
        T.StructField("year", T.IntegerType(), nullable=False),
        T.StructField("doc_type", T.StringType(), nullable=False),
        T.StructField("doc_type_label", T.StringType(), nullable=False),
        T.StructField("text", T.StringType(), nullable=False),
    ]
)

GOLD_TOPICS_SCHEMA = T.StructType([T.StructField("eurovoc_code", T.StringType(), nullable=False)])

GOLD_BELONGS_TO_SCHEMA = T.StructType(
    [
        T.StructField("celex_id", T.StringType(), nullable=False),
        T.StructField("eurovoc_code", T.StringType(), nullable=False),
    ]
)

SILVER_PARTITION_COLUMNS = ("year", "doc_type")

# --- Fixed values ----------------------------------------------------------
# The meaning of CELEX sectors and document-type letters, the layout of the
# Official Journal running header, and the default quality limits.

SECTOR_LABELS = {
    "1": "Treaties",
    "2": "International Agreements",
    "3": "Legislation",
    "4": "Complementary Legislation",
    "5": "Preparatory Acts",
    "6": "Case Law",
    "7": "National Transposition",
    "8": "National Case Law",
    "9": "Parliamentary Questions",
}

DOC_TYPE_LABELS = {
    "R": "Regulation",
    "L": "Directive",
    "D": "Decision",
    "H": "Recommendation",
    "A": "Opinion",
    "G": "Resolution",
    "F": "Framework Decision",
    "J": "Joint Action",
    "M": "Merger Decision",
    "O": "Guideline",
    "Q": "Institutional Arrangement",
    "S": "ECSC General Decision",
    "X": "Other Act",
    "C": "Other (OJ C series)",
    "E": "EEA/EFTA Act",
    "K": "ECSC Recommendation",
}

OTHER_LABEL = "Other"

JOURNAL_HEADER_PATTERN = (
    r"^\s*\d{1,2}\.\d{1,2}\.\d{4}\s+[A-Z]{2}\s+"
    r"Official Journal of the European Union\s+[LC]\s+\d+/\d+\s*"
)

REQUIRED_SILVER_COLUMNS = ("celex_id", "year", "doc_type", "text")
MIN_TEXT_LENGTH = 50
MIN_YEAR = 1951

# --- Star schema -----------------------------------------------------------

STAR_SCHEMAS = {
    "dim_date": "date_key INT, full_date DATE, year INT, quarter INT, month INT, month_name STRING, "
    "day INT, day_of_week INT, day_name STRING, is_weekend BOOLEAN",
    "dim_document_type": "type_id INT, type_code STRING, type_name STRING, description STRING",
    "dim_institution": "institution_id INT, institution_code STRING, institution_name STRING, institution_type STRING",
    "dim_topic": "topic_id INT, topic_code STRING, topic_name STRING, category STRING",
    "dim_country": "country_id INT, country_code STRING, country_name STRING, join_year INT",
    "fact_documents": "document_id INT, celex_number STRING, title STRING, publication_date_key INT, type_id INT, "
    "institution_id INT, article_count INT, text_length INT, reference_count INT, amendment_count INT",
    "bridge_document_topic": "document_id INT, topic_id INT",
    "bridge_document_country": "document_id INT, country_id INT",
    "document_references": "source_document_id INT, target_document_id INT, reference_type STRING",
}
