"""Sources, sinks and the layered jobs, through disk."""

from pyspark.sql import Row
from pyspark.sql import functions as F

from lexloom.functions.dates import calendar
from lexloom.operators.groups import collected
from lexloom.plans.medallion import (
    bronze_to_silver,
    build_belongs_to,
    build_documents,
    build_topics,
    ingest,
    read_silver,
    silver_to_gold,
    to_silver,
)
from lexloom.plans.changes import apply_changes, read_gold
from lexloom.plans.costore import compact_files
from lexloom.queries.model import BRIDGE_SQL, BRONZE_SQL, SILVER_SQL, bronze, order_day, orders, silver, topic_bridge
from lexloom.queries.registry import query
from lexloom.schemas import SILVER_PARTITION_COLUMNS
from lexloom.sources.readers import read_csv, read_parquet, read_table, register_views
from lexloom.sources.scratch import fresh_path, materialize
from lexloom.sources.writers import append, layout_report, overwrite, overwrite_compact, overwrite_csv, overwrite_partitioned


@query("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders")
def scan_parquet(spark, folder):
    return orders(spark, folder).withColumn("o_orderdate", order_day())


@query("scan_explicit_schema", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_explicit_schema(spark, folder):
    return read_table(spark, folder, "documents", "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG")


@query("csv_roundtrip", "SELECT o_orderkey, o_orderpriority, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def csv_roundtrip(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "o_orderpriority", "o_totalprice", order_day().alias("o_orderdate"))
    path = fresh_path(spark, "orders-csv")
    overwrite_csv(rows, path)
    return read_csv(spark, path, rows.schema)


@query(
    "inline_values",
    """SELECT label, COUNT(*) AS n FROM orders
    JOIN (VALUES ('O', 'Open'), ('F', 'Fulfilled'), ('P', 'Pending')) AS v(code, label) ON o_orderstatus = code GROUP BY label""",
)
def inline_values(spark, folder):
    labels = spark.sql("SELECT * FROM VALUES ('O', 'Open'), ('F', 'Fulfilled'), ('P', 'Pending') AS v(code, label)")
    counted = orders(spark, folder).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(labels, F.col("o_orderstatus") == F.col("code")).select("label", "n")


@query(
    "inferred_rows",
    """SELECT label, CAST(r AS BIGINT) AS rank, COUNT(*) AS n FROM orders
    JOIN (VALUES ('O', 'Open', 1), ('F', 'Fulfilled', 2), ('P', 'Pending', 3)) AS v(code, label, r) ON o_orderstatus = code GROUP BY label, r""",
)
def inferred_rows(spark, folder):
    """Rows made in the program, their types taken from the values."""
    labels = spark.createDataFrame([Row(code="O", label="Open", rank=1), Row(code="F", label="Fulfilled", rank=2), Row(code="P", label="Pending", rank=3)])
    counted = orders(spark, folder).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(labels, F.col("o_orderstatus") == F.col("code")).select("label", "rank", "n")


@query(
    "coalesced_files",
    "SELECT COUNT(*) AS rows, CAST(2 AS BIGINT) AS files FROM lineitem",
)
def coalesced_files(spark, folder):
    """A wide job's rows in two files without moving one of them."""
    path = fresh_path(spark, "coalesced")
    lines = read_table(spark, folder, "lineitem").select("l_orderkey", "l_partkey")
    even = F.col("l_orderkey") % 2 == 0
    overwrite_compact(lines.filter(even).unionByName(lines.filter(~even)), path, 2, exchange=False)
    return read_parquet(spark, path).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_metadata.file_path").alias("files"))


@query(
    "sql_views",
    """SELECT o_orderpriority, COUNT(*) AS num_orders FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderpriority""",
)
def sql_views(spark, folder):
    register_views(spark, folder, ["orders", "customer"])
    return spark.sql(
        """SELECT o_orderpriority, COUNT(*) AS num_orders FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_mktsegment = 'BUILDING' GROUP BY o_orderpriority"""
    )


@query(
    "dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
      CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
      CAST(day(d) AS INTEGER) AS day, CAST(isodow(d) AS INTEGER) AS day_of_week, dayname(d) AS day_name, isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM (
      SELECT CAST(date_trunc('year', MIN(o_orderdate)) AS TIMESTAMP) AS first_day,
        CAST(date_trunc('year', MAX(o_orderdate)) AS TIMESTAMP) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS last_day FROM orders))""",
)
def dim_date(spark, folder):
    days = orders(spark, folder).agg(F.min(order_day()).alias("low"), F.max(order_day()).alias("high"))
    bounds = days.select(
        F.trunc("low", "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc("high", "year"), 12), 1).alias("last_day"),
    )
    return calendar(bounds)


@query("ingest_bronze", f"WITH {BRONZE_SQL} SELECT celex_id, title, md5(text) AS text_md5, CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts FROM bronze")
def ingest_bronze(spark, folder):
    path = fresh_path(spark, "bronze")
    ingest(spark, bronze(spark, folder), path)
    return _digest(read_parquet(spark, path))


@query(
    "ingest_bronze_subset",
    f"""WITH {BRONZE_SQL} SELECT celex_id, title, md5(text) AS text_md5, CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts
    FROM bronze ORDER BY celex_id, md5(text), title LIMIT 500""",
)
def ingest_bronze_subset(spark, folder):
    path = fresh_path(spark, "bronze-subset")
    ingest(spark, bronze(spark, folder), path, subset_size=500)
    return _digest(read_parquet(spark, path))


@query(
    "ingest_bronze_split",
    f"""WITH {BRONZE_SQL} SELECT celex_id, title, md5(bronze.text) AS text_md5, CAST(len(eurovoc_concepts) AS INTEGER) AS n_concepts
    FROM bronze JOIN documents USING (doc_id) WHERE lang = 'fr'""",
)
def ingest_bronze_split(spark, folder):
    path = fresh_path(spark, "bronze-split")
    ingest(spark, bronze(spark, folder, "lang"), path, split="fr", split_column="lang")
    return _digest(read_parquet(spark, path))


def _digest(bronze_rows):
    return bronze_rows.select(
        "celex_id", "title", F.md5("text").alias("text_md5"), F.size("eurovoc_concepts").alias("n_concepts")
    )


def _stored_silver(spark, folder):
    bronze_path, silver_path = fresh_path(spark, "bronze"), fresh_path(spark, "silver")
    ingest(spark, bronze(spark, folder), bronze_path)
    bronze_to_silver(spark, bronze_path, silver_path)
    return silver_path


@query("partition_roundtrip", f"WITH {SILVER_SQL} SELECT year, doc_type, COUNT(*) AS n, CAST(SUM(length(text)) AS BIGINT) AS chars FROM silver GROUP BY year, doc_type")
def partition_roundtrip(spark, folder):
    stored = read_silver(spark, _stored_silver(spark, folder))
    return stored.groupBy("year", "doc_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("bigint")).alias("chars"))


@query("layout_report")
def layout(spark, folder):
    """Files, bytes and rows of every directory; bytes are the encoder's, so ``layout_rows`` states what SQL can."""
    path = fresh_path(spark, "silver-layout")
    overwrite_partitioned(silver(spark, folder), path, SILVER_PARTITION_COLUMNS)
    return layout_report(read_parquet(spark, path), SILVER_PARTITION_COLUMNS)


@query(
    "layout_rows",
    f"""WITH {SILVER_SQL} SELECT year, doc_type, COUNT(*) AS rows, CAST(1 AS BIGINT) AS files, true AS filled
    FROM silver GROUP BY year, doc_type""",
)
def layout_rows(spark, folder):
    """Small directories are one file each, and hold bytes for their rows."""
    found = layout(spark, folder)
    return found.select("year", "doc_type", "rows", "files", (F.col("bytes") > F.col("rows")).alias("filled"))


@query(
    "compact_layer",
    f"""WITH {SILVER_SQL} SELECT year, doc_type, COUNT(*) AS rows, CAST(SUM(length(text)) AS BIGINT) AS chars,
      COUNT(DISTINCT doc_id % 4) AS files_before, CAST(1 AS BIGINT) AS files_after FROM silver GROUP BY year, doc_type""",
)
def compact_layer(spark, folder):
    """A layer that four small runs appended to, brought together: the same rows in one file a directory."""
    path = fresh_path(spark, "silver-small-files")
    raw = bronze(spark, folder)
    for turn in range(4):
        to_silver(raw.filter(F.col("doc_id") % 4 == turn)).hint("rebalance", *SILVER_PARTITION_COLUMNS).write.mode("append").partitionBy(*SILVER_PARTITION_COLUMNS).parquet(path)
    before = layout_report(read_parquet(spark, path), SILVER_PARTITION_COLUMNS)
    before = spark.createDataFrame(before.collect(), before.schema)  # one row a directory, as it was
    compact_files(spark, path, SILVER_PARTITION_COLUMNS)
    stored = read_silver(spark, path).groupBy(*SILVER_PARTITION_COLUMNS).agg(F.sum(F.length("text").cast("long")).alias("chars"))
    after = layout_report(read_parquet(spark, path), SILVER_PARTITION_COLUMNS)
    by_place = lambda df, prefix: df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns})
    out = after
    for other, prefix in ((by_place(before, "b_"), "b_"), (by_place(stored, "s_"), "s_")):
        out = out.join(other, [F.col(c).eqNullSafe(F.col(prefix + c)) for c in SILVER_PARTITION_COLUMNS])
    return out.select(*SILVER_PARTITION_COLUMNS, "rows", F.col("s_chars").alias("chars"), F.col("b_files").alias("files_before"), F.col("files").alias("files_after"))


@query(
    "insert_select",
    """SELECT kind, COUNT(*) AS pairs, COUNT(DISTINCT l_orderkey) AS docs FROM (
      SELECT DISTINCT l_orderkey, l_partkey, 'returned' AS kind FROM lineitem WHERE l_returnflag = 'R'
      UNION ALL SELECT DISTINCT l_orderkey, l_partkey, 'kept' AS kind FROM lineitem WHERE l_returnflag <> 'R') GROUP BY kind""",
)
def insert_select(spark, folder):
    lines = read_table(spark, folder, "lineitem")
    path = fresh_path(spark, "bridge-append")
    pairs = lines.select("l_orderkey", "l_partkey")
    overwrite(pairs.filter(lines.l_returnflag == "R").distinct().withColumn("kind", F.lit("returned")), path)
    append(pairs.filter(lines.l_returnflag != "R").distinct().withColumn("kind", F.lit("kept")), path)
    stored = read_parquet(spark, path).groupBy("kind")
    return stored.agg(F.count(F.lit(1)).alias("pairs"), F.count_distinct("l_orderkey").alias("docs"))


GOLD_DOCUMENTS_SQL = """documents_node AS (
  SELECT * FROM (SELECT celex_id, title, year, doc_type, doc_type_label, text, row_number() OVER (PARTITION BY celex_id
    ORDER BY title IS NULL, length(text) DESC, md5(text), title) AS rn FROM silver) WHERE rn = 1)"""
GOLD_EDGES_SQL = """edge AS (
  SELECT DISTINCT celex_id, eurovoc_code FROM (SELECT celex_id, unnest(eurovoc_concepts) AS eurovoc_code FROM silver)
  WHERE eurovoc_code IS NOT NULL)"""


@query(
    "gold_documents",
    f"WITH {SILVER_SQL}, {GOLD_DOCUMENTS_SQL} SELECT celex_id, title, year, doc_type, doc_type_label, md5(text) AS text_md5 FROM documents_node",
)
def gold_documents(spark, folder):
    nodes = build_documents(silver(spark, folder))
    return nodes.withColumn("text_md5", F.md5("text")).drop("text")


@query("gold_topics", f"WITH {SILVER_SQL}, {GOLD_EDGES_SQL} SELECT DISTINCT eurovoc_code FROM edge")
def gold_topics(spark, folder):
    return build_topics(silver(spark, folder))


@query("gold_belongs_to", f"WITH {SILVER_SQL}, {GOLD_EDGES_SQL} SELECT celex_id, eurovoc_code FROM edge")
def gold_belongs_to(spark, folder):
    return build_belongs_to(silver(spark, folder))


@query(
    "gold_tables",
    f"""WITH {SILVER_SQL}, {GOLD_DOCUMENTS_SQL}, {GOLD_EDGES_SQL}
    SELECT 'documents' AS table_name, COUNT(*) AS n FROM documents_node
    UNION ALL SELECT 'topics', COUNT(DISTINCT eurovoc_code) FROM edge UNION ALL SELECT 'belongs_to', COUNT(*) FROM edge""",
)
def gold_tables(spark, folder):
    gold_path = fresh_path(spark, "gold")
    tables = silver_to_gold(spark, _stored_silver(spark, folder), gold_path)
    counts = [
        read_parquet(spark, f"{gold_path}/{name}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name in tables
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(
    "gold_single_files",
    "SELECT 'documents' AS table_name, 1 AS files UNION ALL SELECT 'topics', 1 UNION ALL SELECT 'belongs_to', 1",
)
def gold_single_files(spark, folder):
    """The gold tables of a small corpus, each in one file."""
    gold_path = fresh_path(spark, "gold-single")
    tables = silver_to_gold(spark, _stored_silver(spark, folder), gold_path, files=1)
    files = [
        read_parquet(spark, f"{gold_path}/{name}").agg(F.count_distinct("_metadata.file_path").cast("int").alias("files"))
        .select(F.lit(name).alias("table_name"), "files")
        for name in tables
    ]
    return files[0].unionByName(files[1]).unionByName(files[2])


LEFT_SQL = f"""{SILVER_SQL}, left_over AS (SELECT silver.* FROM silver JOIN documents USING (doc_id) WHERE n_chars % 7 <> 5)"""


def _gold_in_batches(spark, folder):
    """A third of the corpus with old titles, a third more, then the rest, the right titles, and a seventh that is gone."""
    path = fresh_path(spark, "gold-by-year")
    raw, n = bronze(spark, folder, "n_chars"), F.col("n_chars")
    none = raw.select("celex_id").limit(0)
    old = raw.filter(n % 3 == 0).withColumn("title", F.lit("old"))
    apply_changes(spark, to_silver(old), none, path)
    apply_changes(spark, to_silver(raw.filter(n % 3 == 1)), none, path)
    apply_changes(spark, to_silver(raw.filter((n % 3 != 1) & (n % 7 != 5))), raw.filter(n % 7 == 5).select("celex_id"), path)
    return read_gold(spark, path)


@query(
    "gold_in_batches",
    f"WITH {LEFT_SQL}, {GOLD_DOCUMENTS_SQL.replace('FROM silver', 'FROM left_over')} SELECT celex_id, title, year, doc_type, doc_type_label, md5(text) AS text_md5 FROM documents_node",
)
def gold_in_batches(spark, folder):
    """Nodes after three change sets: those of one full build."""
    return _gold_in_batches(spark, folder)["documents"].withColumn("text_md5", F.md5("text")).drop("text")


@query(
    "gold_edges_in_batches",
    f"""WITH {LEFT_SQL}, {GOLD_EDGES_SQL.replace('FROM silver', 'FROM left_over')} SELECT celex_id, eurovoc_code FROM edge
    UNION ALL SELECT NULL, eurovoc_code FROM (SELECT DISTINCT eurovoc_code FROM edge)""",
)
def gold_edges_in_batches(spark, folder):
    """Edges, and topics as rows without a document."""
    tables = _gold_in_batches(spark, folder)
    topics = tables["topics"].select(F.lit(None).cast("string").alias("celex_id"), "eurovoc_code")
    return tables["belongs_to"].unionByName(topics)


@query("collect_topics", f"""WITH {BRIDGE_SQL}, numbered AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS rn FROM b)
    SELECT l_orderkey, CAST((rn - 1) // 1000 AS INTEGER) AS chunk, CAST(COUNT(*) AS INTEGER) AS n_topics,
      string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS topics
    FROM numbered GROUP BY l_orderkey, (rn - 1) // 1000""")
def collect_topics(spark, folder):

    lists = collected(materialize(topic_bridge(spark, folder), "bridge"), "l_orderkey", "l_partkey")
    return lists.select(
        "l_orderkey", "chunk", F.size("elements").alias("n_topics"), F.array_join("elements", ",").alias("topics")
    )
