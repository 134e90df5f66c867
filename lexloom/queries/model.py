"""The given tables in the roles of the legislative model.

``orders`` are the documents (measure ``o_totalprice``), order priority is the
document type, ``part`` holds the topics, the distinct (order, part) pairs of
``lineitem`` are the topic bridge, and ``documents`` is the raw corpus.  The
derivations below keep every row; the SQL next to each states the same thing
for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.operators.bridges import bridge
from lexloom.plans.medallion import to_silver
from lexloom.schemas import DOC_TYPE_LABELS, JOURNAL_HEADER_PATTERN, OTHER_LABEL, SECTOR_LABELS
from lexloom.sources.readers import read_table

HEADER = "1.7.2014 EN Official Journal of the European Union L 192/42\n"


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "orders")


def order_day() -> Column:
    return F.to_date("o_orderdate")


def topic_bridge(spark: SparkSession, folder: str) -> DataFrame:
    return bridge(read_table(spark, folder, "lineitem"), "l_orderkey", "l_partkey")


BRIDGE_SQL = "b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem)"


def bronze(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """The raw corpus in bronze shape, plus ``doc_id`` and ``more`` of its columns.

    Ids are built from the text length, so copies of a text share an id and
    some acts have several versions; one source delivers malformed ids.
    The texts get the dirt that cleaning has to remove.  Concept codes are
    the line lengths: repeated codes, NULL for blank lines, and no array at all
    for texts of one line.
    """
    n = F.col("n_chars")
    letter = F.substring(F.lit("RLDZ"), (n % 4 + 1).cast("int"), F.lit(1))
    celex_id = F.concat(F.lit("3"), (1951 + n % 70).cast("string"), letter, n.cast("string"))
    body = F.replace(F.replace("text", F.lit(".\n"), F.lit(".\n\n\n\n")), F.lit(". "), F.lit(".  \t"))
    lines = F.split("text", "\n")
    return read_table(spark, folder, "documents").select(
        "doc_id",
        *more,
        F.when(F.col("source") == "src7", F.concat(F.lit("BAD"), F.col("doc_id").cast("string")))
        .otherwise(celex_id)
        .alias("celex_id"),
        F.when(F.col("lang") != "de", F.concat(F.lit("  "), "source", F.lit(" / "), "lang", F.lit("\n"))).alias("title"),
        F.when(F.col("lang") == "en", F.concat(F.lit(HEADER), body)).otherwise(body).alias("text"),
        F.when(
            F.contains("text", F.lit("\n")),
            F.transform(lines, lambda line: F.nullif(F.length(line).cast("string"), F.lit("0"))),
        ).alias("eurovoc_concepts"),
    )


BRONZE_SQL = r"""bronze AS (
  SELECT doc_id,
    CASE WHEN source = 'src7' THEN 'BAD' || CAST(doc_id AS VARCHAR)
         ELSE '3' || CAST(1951 + n_chars % 70 AS VARCHAR) || substr('RLDZ', CAST(n_chars % 4 + 1 AS INTEGER), 1)
              || CAST(n_chars AS VARCHAR) END AS celex_id,
    CASE WHEN lang <> 'de' THEN '  ' || source || ' / ' || lang || chr(10) END AS title,
    CASE WHEN lang = 'en' THEN '1.7.2014 EN Official Journal of the European Union L 192/42' || chr(10) ELSE '' END
      || replace(replace(text, '.' || chr(10), '.' || repeat(chr(10), 4)), '. ', '.  ' || chr(9)) AS text,
    CASE WHEN strpos(text, chr(10)) > 0 THEN
      [nullif(CAST(length(line) AS VARCHAR), '0') for line in string_split(text, chr(10))] END AS eurovoc_concepts
  FROM documents)"""


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return to_silver(bronze(spark, folder))


def case_of(column: str, labels: dict[str, str], default: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in labels.items()) + f" ELSE {default} END"


PARSED_SQL = BRONZE_SQL + r""", parsed AS (
  SELECT *, nullif(regexp_extract(celex_id, '^(\d)', 1), '') AS sector,
    TRY_CAST(nullif(regexp_extract(celex_id, '^\d(\d{4})', 1), '') AS INTEGER) AS year,
    nullif(regexp_extract(celex_id, '^\d{5}([A-Z])', 1), '') AS doc_type
  FROM bronze)"""

TYPE_LABEL_SQL = case_of("doc_type", DOC_TYPE_LABELS, f"'{OTHER_LABEL}'")
SECTOR_LABEL_SQL = case_of("sector", SECTOR_LABELS, "NULL")

SILVER_SQL = PARSED_SQL + rf""", silver AS (
  SELECT doc_id, celex_id, sector, year, doc_type, {TYPE_LABEL_SQL} AS doc_type_label,
    regexp_replace(title, '^\s+|\s+$', '', 'g') AS title,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '{JOURNAL_HEADER_PATTERN}', ''),
      '[ \t]+', ' ', 'g'), '\n{{3,}}', repeat(chr(10), 2), 'g'), '^\s+|\s+$', '', 'g') AS text,
    eurovoc_concepts
  FROM parsed)"""
