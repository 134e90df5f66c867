"""The given tables in the roles of the star schema: stored under its contract, read back, and checked."""

import uuid

from pyspark.sql import functions as F

from lexloom.functions.dates import calendar
from lexloom.operators.bridges import bridge
from lexloom.plans.costore import join_calendar, linked_measures, store_bucketed, store_by_month
from lexloom.plans.star import FOREIGN_KEYS, NULLABLE, UNIQUE_KEYS, affected_countries, constraint_report, date_dimension, read_star, store_star
from lexloom.queries.model import orders
from lexloom.queries.registry import query
from lexloom.schemas import STAR_SCHEMAS
from lexloom.sources.readers import read_table
from lexloom.sources.scratch import fresh_path

# The calendar covers two years only, so documents of others break their reference to it.
FIRST_DAY, LAST_DAY, LAST_KEY = "1996-01-01", "1997-12-31", 19971231

ROLES = {
    "dim_date": f"SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, 1 AS year, 1 AS quarter, 1 AS month, '' AS month_name, "
    f"1 AS day, 1 AS day_of_week, '' AS day_name, true AS is_weekend FROM (SELECT unnest(generate_series(DATE '{FIRST_DAY}', DATE '{LAST_DAY}', INTERVAL 1 DAY)) AS d)",
    "dim_document_type": "SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS type_id, o_orderpriority AS type_code, o_orderpriority AS type_name FROM orders",
    "dim_institution": "SELECT c_custkey AS institution_id, c_name AS institution_code, c_name AS institution_name FROM customer",
    "dim_topic": "SELECT p_partkey AS topic_id, CAST(p_partkey AS VARCHAR) AS topic_code, p_name AS topic_name FROM part",
    "dim_country": "SELECT n_nationkey AS country_id, n_name AS country_code, n_name AS country_name FROM nation",
    "fact_documents": "SELECT o_orderkey AS document_id, '3' || o_orderkey AS celex_number, o_orderstatus AS title, "
    "CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS publication_date_key, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS type_id, o_custkey AS institution_id FROM orders",
    "bridge_document_topic": "SELECT DISTINCT l_orderkey AS document_id, l_partkey AS topic_id FROM lineitem",
    "bridge_document_country": f"SELECT document_id, country_id FROM fact_documents CROSS JOIN dim_country WHERE publication_date_key <= {LAST_KEY} OR country_code <> 'NATION_24'",
    "document_references": "SELECT o_orderkey AS source_document_id, o_custkey AS target_document_id, 'cites' AS reference_type FROM orders",
}


def _report_sql() -> str:
    parts = []
    for table in ROLES:
        required = [c.split()[0] for c in STAR_SCHEMAS[table].split(", ") if c.split()[0] not in NULLABLE]
        parts += [f"SELECT '{table}' AS \"table\", 'not null' AS kind, '{c}' AS columns, COUNT(*) FILTER ({c} IS NULL) AS violations FROM {table}" for c in required]
        parts += [
            f"SELECT '{table}', 'unique', '{', '.join(k)}', CAST(coalesce(SUM(n - 1), 0) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM {table} GROUP BY {', '.join(k)})"
            for k in UNIQUE_KEYS[table]
        ]
    parts += [f"SELECT '{c}', 'foreign key', '{k}', COUNT(*) FROM {c} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {pk} FROM {p})" for c, k, p, pk in FOREIGN_KEYS]
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in ROLES.items()) + " " + " UNION ALL ".join(parts)


def _star_tables(spark, folder):
    none = F.lit(None)
    placed = orders(spark, folder)
    kind = F.substring("o_orderpriority", 1, 1).cast("int")
    customers, parts = read_table(spark, folder, "customer"), read_table(spark, folder, "part")
    nations = read_table(spark, folder, "nation")
    tables = {
        "dim_date": date_dimension(spark, FIRST_DAY, LAST_DAY),
        "dim_document_type": placed.select(kind.alias("type_id"), F.col("o_orderpriority").alias("type_code"), F.col("o_orderpriority").alias("type_name")).distinct().withColumn("description", none),
        "dim_institution": customers.select(F.col("c_custkey").alias("institution_id"), F.col("c_name").alias("institution_code"), F.col("c_name").alias("institution_name"), F.col("c_mktsegment").alias("institution_type")),
        "dim_topic": parts.select(F.col("p_partkey").alias("topic_id"), F.col("p_partkey").alias("topic_code"), F.col("p_name").alias("topic_name"), F.col("p_brand").alias("category")),
        "dim_country": nations.select(F.col("n_nationkey").alias("country_id"), F.col("n_name").alias("country_code"), F.col("n_name").alias("country_name"), none.alias("join_year")),
        "fact_documents": placed.select(
            F.col("o_orderkey").alias("document_id"), F.concat(F.lit("3"), "o_orderkey").alias("celex_number"), F.col("o_orderstatus").alias("title"),
            F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("publication_date_key"), kind.alias("type_id"), F.col("o_custkey").alias("institution_id"),
            *[none.cast("int").alias(c) for c in ("article_count", "text_length", "reference_count", "amendment_count")],
        ),
        "bridge_document_topic": bridge(read_table(spark, folder, "lineitem"), "l_orderkey", "l_partkey").toDF("document_id", "topic_id"),
        "document_references": placed.select(F.col("o_orderkey").alias("source_document_id"), F.col("o_custkey").alias("target_document_id"), none.cast("string").alias("reference_type")),
    }
    return tables | {"bridge_document_country": affected_countries(tables["fact_documents"], tables["dim_country"], "NATION_24", LAST_KEY)}


@query("star_constraints", _report_sql())
def star_constraints(spark, folder):
    path = fresh_path(spark, "star")
    store_star(_star_tables(spark, folder), path)
    return constraint_report(read_star(spark, path))


@query(
    "pruned_fact",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, o_orderpriority, COUNT(*) AS orders,
      CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
    FROM orders WHERE quarter(o_orderdate) = 2 AND dayofweek(o_orderdate) NOT IN (0, 6) GROUP BY 1, 2, 3""",
)
def pruned_fact(spark, folder):
    """Working days of second quarters: the calendar's filter prunes the fact's months at run time."""
    path = fresh_path(spark, "orders-by-month")
    placed = orders(spark, folder).select("o_orderkey", "o_orderpriority", "o_totalprice", F.to_date("o_orderdate").alias("day"))
    store_by_month(placed, "day", path)
    bounds = placed.agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    days_path = fresh_path(spark, "calendar")
    calendar(bounds).write.parquet(days_path)
    days = spark.read.parquet(days_path).filter("quarter = 2 AND NOT is_weekend").select("full_date", "year", "month")
    joined = join_calendar(spark.read.parquet(path), days, "day")
    return joined.groupBy("year", "month", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total")
    )


@query(
    "bucketed_shares",
    """WITH b AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), n AS (SELECT l_orderkey, COUNT(*) AS links FROM b GROUP BY l_orderkey)
    SELECT o_orderkey, o_totalprice, coalesce(links, 0) AS links, o_totalprice / links AS share FROM orders LEFT JOIN n ON o_orderkey = l_orderkey""",
)
def bucketed_shares(spark, folder):
    """Orders and their links stored in the same buckets, then counted and joined without an exchange."""
    name = uuid.uuid4().hex
    fact, links = f"orders_{name}", f"links_{name}"
    store_bucketed(orders(spark, folder).select("o_orderkey", "o_totalprice"), fact, "o_orderkey", fresh_path(spark, "bucketed-orders"))
    pairs = bridge(read_table(spark, folder, "lineitem"), "l_orderkey", "l_partkey").toDF("o_orderkey", "l_partkey")
    store_bucketed(pairs, links, "o_orderkey", fresh_path(spark, "bucketed-links"))
    return linked_measures(spark, fact, links, "o_orderkey", "o_totalprice", "l_partkey")
