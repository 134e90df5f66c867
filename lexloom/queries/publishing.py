"""Layers that are published behind a gate, refreshed in part, and fed from JSON lines."""

from pyspark.sql import functions as F

from lexloom.plans.medallion import bronze_to_silver, ingest, ingest_json, read_silver
from lexloom.plans.publish import last_commit, publish_silver, read_published_silver, refresh_silver
from lexloom.plans.quality import DataQualityError
from lexloom.queries.model import BRONZE_SQL, SILVER_SQL, bronze
from lexloom.queries.registry import query
from lexloom.schemas import BRONZE_SCHEMA, SILVER_PARTITION_COLUMNS
from lexloom.sources.readers import read_parquet
from lexloom.sources.scratch import fresh_path

FITS_SQL = "celex_id IS NOT NULL AND year BETWEEN 1951 AND 2030 AND doc_type IS NOT NULL AND length(text) >= 50"


def _published(spark, folder):
    """A layer after a strict run over the rows that pass the gate, and one over all rows, which it stops."""
    path = fresh_path(spark, "published-silver")
    raw = bronze(spark, folder).select(*BRONZE_SCHEMA.names)
    whole_ids = raw.filter(F.col("celex_id").rlike(r"^\d{5}[A-Z]") & (F.length("text") >= 200))
    commit, report = publish_silver(spark, whole_ids, path, strict=True, max_year=2030)
    try:
        publish_silver(spark, raw, path, strict=True, max_year=2030)
        stopped = False
    except DataQualityError:
        stopped = True
    return path, commit, report, stopped


WHOLE_SQL = f"""WITH {SILVER_SQL}, raw AS (SELECT doc_id FROM bronze WHERE regexp_matches(celex_id, '^\\d{{5}}[A-Z]') AND length(text) >= 200)"""


@query(
    "publish_layer",
    f"""{WHOLE_SQL} SELECT celex_id, sector, year, doc_type, doc_type_label, title, md5(text) AS text_md5,
      CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts FROM silver JOIN raw USING (doc_id)""",
)
def publish_layer(spark, folder):
    """What readers see after a run that was committed and one that the gate stopped."""
    path, *_ = _published(spark, folder)
    return read_published_silver(spark, path).select(
        "celex_id", "sector", "year", "doc_type", "doc_type_label", "title",
        F.md5("text").alias("text_md5"), F.size("eurovoc_concepts").alias("n_concepts"),
    )


@query(
    "publish_gate",
    f"""{WHOLE_SQL}, kept AS (SELECT silver.* FROM silver JOIN raw USING (doc_id))
    SELECT CAST(1 AS BIGINT) AS last_commit, (SELECT COUNT(*) FROM kept) AS rows_written, (SELECT COUNT(*) FROM kept) AS rows_read,
      (SELECT COUNT(*) FROM kept WHERE NOT coalesce({FITS_SQL}, false)) AS violating_rows,
      EXISTS (SELECT 1 FROM silver WHERE NOT coalesce({FITS_SQL}, false)) AS second_run_stopped""",
)
def publish_gate(spark, folder):
    """Counts that the write itself took, against what readers then find."""
    path, commit, report, stopped = _published(spark, folder)
    stored = read_published_silver(spark, path).agg(F.count(F.lit(1)).alias("rows_read"))
    return stored.select(
        F.lit(last_commit(spark, path).number).cast("long").alias("last_commit"), F.lit(commit.rows).cast("long").alias("rows_written"),
        "rows_read", F.lit(report.violating_rows).cast("long").alias("violating_rows"), F.lit(stopped).alias("second_run_stopped"),
    )


@query(
    "refresh_partitions",
    f"""WITH {SILVER_SQL} SELECT year, doc_type, COUNT(*) AS rows, CAST(SUM(length(text)) AS BIGINT) AS chars,
      CAST(SUM(ascii(right(md5(text || coalesce(title, '-')), 1))) AS BIGINT) AS content,
      coalesce(year BETWEEN 1960 AND 1969, false) AS replaced, NOT coalesce(year BETWEEN 1960 AND 1969, false) AS files_kept
    FROM silver GROUP BY year, doc_type""",
)
def refresh_partitions(spark, folder):
    """A layer whose sixties were stale, brought up to date in part: equal to a full build, other files untouched."""
    bronze_path, silver_path = fresh_path(spark, "bronze"), fresh_path(spark, "silver")
    sixties = F.substring("celex_id", 2, 3) == "196"
    raw = bronze(spark, folder).select(*BRONZE_SCHEMA.names)
    stale = raw.withColumn("text", F.when(sixties, F.concat(F.lit("Draft. "), "text")).otherwise(F.col("text")))
    ingest(spark, stale, bronze_path)
    bronze_to_silver(spark, bronze_path, silver_path)
    files = _files(spark, silver_path)
    touched = refresh_silver(spark, raw.filter(sixties), silver_path)
    marked = touched.withColumn("replaced", F.lit(True)).withColumnsRenamed({c: f"__{c}" for c in SILVER_PARTITION_COLUMNS})
    now = _files(spark, silver_path).withColumnsRenamed({c: f"n_{c}" for c in SILVER_PARTITION_COLUMNS}).withColumnRenamed("files", "now")
    content = F.ascii(F.right(F.md5(F.concat("text", F.coalesce("title", F.lit("-")))), F.lit(1)))
    layer = read_silver(spark, silver_path).groupBy(*SILVER_PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("text").cast("long")).alias("chars"), F.sum(content.cast("long")).alias("content")
    )
    for other, prefix in ((files.withColumnsRenamed({c: f"f_{c}" for c in SILVER_PARTITION_COLUMNS}), "f_"), (now, "n_"), (marked, "__")):
        layer = layer.join(other, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in SILVER_PARTITION_COLUMNS], "left")
    replaced = F.coalesce("replaced", F.lit(False))
    return layer.select(*SILVER_PARTITION_COLUMNS, "rows", "chars", "content", replaced.alias("replaced"), (F.col("files") == F.col("now")).alias("files_kept"))


def _files(spark, path):
    """Names of the files in each directory, as they are now."""
    found = read_silver_files(spark, path).groupBy(*SILVER_PARTITION_COLUMNS).agg(F.sort_array(F.collect_set("file")).alias("files"))
    rows = found.collect()  # one row per directory
    return spark.createDataFrame(rows, found.schema)


def read_silver_files(spark, path):
    return read_parquet(spark, path).select(*[F.col(c) for c in SILVER_PARTITION_COLUMNS], F.col("_metadata.file_name").alias("file"))


def _ingested(spark, folder):
    """The corpus through JSON lines, a tenth of which were cut in the middle."""
    lines, stored, rejects = (fresh_path(spark, name) for name in ("json-lines", "json-bronze", "json-rejects"))
    rows = bronze(spark, folder)
    line = F.to_json(F.struct(*BRONZE_SCHEMA.names))
    cut = F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))
    rows.select(F.when(F.col("doc_id") % 10 == 3, cut).otherwise(line).alias("value")).write.text(lines)
    return ingest_json(spark, lines, stored, rejects), stored, rejects


@query(
    "ingest_json_lines",
    f"""WITH {BRONZE_SQL} SELECT celex_id, title, md5(text) AS text_md5, CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts
    FROM bronze WHERE doc_id % 10 <> 3""",
)
def ingest_json_lines(spark, folder):
    _, stored, _ = _ingested(spark, folder)
    return read_parquet(spark, stored).select(
        "celex_id", "title", F.md5("text").alias("text_md5"), F.size("eurovoc_concepts").alias("n_concepts")
    )


@query(
    "ingest_json_rejects",
    """SELECT COUNT(*) FILTER (doc_id % 10 <> 3) AS rows, COUNT(*) FILTER (doc_id % 10 = 3) AS rejected,
      COUNT(*) FILTER (doc_id % 10 = 3) AS lines_kept, true AS name_their_file FROM documents""",
)
def ingest_json_rejects(spark, folder):
    """Counts from the write, and the lines that were set aside."""
    counts, _, rejects = _ingested(spark, folder)
    aside = read_parquet(spark, rejects).agg(F.count("line").alias("lines_kept"), F.every(F.col("file").contains("json-lines")).alias("name_their_file"))
    return aside.select(F.lit(counts.rows).cast("long").alias("rows"), F.lit(counts.rejected).cast("long").alias("rejected"), "lines_kept", "name_their_file")
