"""Window reports over all rows."""

from pyspark.sql import functions as F

from lexloom.functions.numbers import as_whole, mean, percent_of, total
from lexloom.operators.groups import with_group_values
from lexloom.operators.ranked import Desc, ranked
from lexloom.operators.running import running
from lexloom.operators.trends import with_previous
from lexloom.queries.model import BRIDGE_SQL, order_day, orders, topic_bridge
from lexloom.queries.registry import query
from lexloom.sources.readers import read_table
from lexloom.sources.scratch import materialize

SUM_OVER = "SUM(o_totalprice) OVER (PARTITION BY o_orderpriority)"


def _priced(spark, folder):
    return orders(spark, folder).select("o_orderkey", "o_orderpriority", "o_totalprice")


def _dated(spark, folder):
    return orders(spark, folder).select("o_orderkey", order_day().alias("published"))


@query(
    "win_avg_partition",
    f"""SELECT o_orderkey, o_orderpriority, o_totalprice,
      CAST(round(AVG(o_totalprice) OVER (PARTITION BY o_orderpriority)) AS INTEGER) AS type_mean,
      COUNT(*) OVER (PARTITION BY o_orderpriority) AS type_docs FROM orders""",
)
def win_avg_partition(spark, folder):
    values = {"type_mean": as_whole(mean("o_totalprice")), "type_docs": F.count("*")}
    return with_group_values(_priced(spark, folder), ["o_orderpriority"], values)


ROW_NUMBER_SQL = """SELECT o_orderkey, o_orderpriority, o_totalprice,
      row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rn,
      dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS dense,
      MAX(o_totalprice) OVER (PARTITION BY o_orderpriority) AS type_max FROM orders"""


def _row_numbers(spark, folder, **limits):
    priced = with_group_values(_priced(spark, folder), ["o_orderpriority"], {"type_max": F.max("o_totalprice")})
    return ranked(
        priced, partition_by=["o_orderpriority"], order_by=[Desc("o_totalprice")],
        tie_break=["o_orderkey"], row_number="rn", dense_rank="dense", **limits,
    )


@query("win_row_number", ROW_NUMBER_SQL)
def win_row_number(spark, folder):
    return _row_numbers(spark, folder)


@query("win_row_number_by_ranges", ROW_NUMBER_SQL)
def win_row_number_by_ranges(spark, folder):
    """The same through key ranges, the way a large input takes."""
    return _row_numbers(spark, folder, direct_rows=0)


RANK_SQL = """SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_num,
      rank() OVER (ORDER BY o_totalprice DESC) AS rnk, dense_rank() OVER (ORDER BY o_totalprice DESC) AS dense_rnk FROM orders"""


def _global_ranks(spark, folder, **limits):
    rows = orders(spark, folder).select("o_orderkey", "o_totalprice")
    return ranked(
        rows, order_by=[Desc("o_totalprice")], tie_break=["o_orderkey"],
        row_number="row_num", rank="rnk", dense_rank="dense_rnk", **limits,
    )


@query("win_rank_global", RANK_SQL)
def win_rank_global(spark, folder):
    return _global_ranks(spark, folder)


@query("win_rank_global_by_ranges", RANK_SQL)
def win_rank_global_by_ranges(spark, folder):
    """The same through key ranges, the way a large input takes."""
    return _global_ranks(spark, folder, direct_rows=0)


@query("win_max_global", "SELECT o_orderkey, o_totalprice, MAX(o_totalprice) OVER () AS max_price FROM orders")
def win_max_global(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "o_totalprice")
    return with_group_values(rows, [], {"max_price": F.max("o_totalprice")})


@query(
    "win_lag_value",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS published, lag(o_orderkey) OVER (ORDER BY o_orderdate, o_orderkey) AS previous_order FROM orders""",
)
def win_lag_value(spark, folder):
    return ranked(_dated(spark, folder), order_by=["published"], tie_break=["o_orderkey"], lag={"previous_order": "o_orderkey"})


@query(
    "win_lead",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS published, lead(o_orderkey) OVER (ORDER BY o_orderdate, o_orderkey) AS next_order,
    lead(CAST(o_orderdate AS DATE)) OVER (ORDER BY o_orderdate, o_orderkey) AS next_day FROM orders""",
)
def win_lead(spark, folder):
    lead = {"next_order": "o_orderkey", "next_day": "published"}
    return ranked(_dated(spark, folder), order_by=["published"], tie_break=["o_orderkey"], lead=lead)


DAYS_SQL = """SELECT o_orderkey, published, lag(published) OVER w AS previous_day,
      CAST(date_diff('day', lag(published) OVER w, published) AS INTEGER) AS days_since
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS published FROM orders) WINDOW w AS (ORDER BY published, o_orderkey)"""


def _with_days(rows, partition_by=(), **limits):
    gaps = ranked(
        rows, partition_by=partition_by, order_by=["published"], tie_break=["o_orderkey"], lag={"previous_day": "published"}, **limits
    )
    return gaps.withColumn("days_since", F.datediff("published", "previous_day"))


@query("days_since_prev", DAYS_SQL)
def days_since_prev(spark, folder):
    return _with_days(_dated(spark, folder))


@query("days_since_prev_by_ranges", DAYS_SQL)
def days_since_prev_by_ranges(spark, folder):
    """The same through key ranges, the way a large input takes."""
    return _with_days(_dated(spark, folder), direct_rows=0)


TOPIC_DAYS_SQL = f"""WITH {BRIDGE_SQL}, of_topic AS (
      SELECT DISTINCT p_brand, o_orderkey, CAST(o_orderdate AS DATE) AS published FROM orders
      JOIN b ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey {{where}})
    SELECT p_brand, o_orderkey, published, lag(published) OVER w AS previous_day,
      CAST(date_diff('day', lag(published) OVER w, published) AS INTEGER) AS days_since
    FROM of_topic WINDOW w AS (PARTITION BY p_brand ORDER BY published, o_orderkey)"""


def _documents_of_topics(spark, folder, parts):
    linked = topic_bridge(spark, folder).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    linked = linked.select("p_brand", F.col("l_orderkey").alias("o_orderkey")).distinct()
    return materialize(linked.join(_dated(spark, folder), "o_orderkey"), "topic-documents")


@query("days_since_prev_topic", TOPIC_DAYS_SQL.format(where="WHERE p_brand = 'Brand#13'"))
def days_since_prev_topic(spark, folder):
    parts = read_table(spark, folder, "part").filter(F.col("p_brand") == "Brand#13").select("p_partkey", "p_brand")
    return _with_days(_documents_of_topics(spark, folder, parts), ["p_brand"])


@query("days_since_prev_each_topic", TOPIC_DAYS_SQL.format(where=""))
def days_since_prev_each_topic(spark, folder):
    parts = read_table(spark, folder, "part").select("p_partkey", "p_brand")
    return _with_days(_documents_of_topics(spark, folder, parts), ["p_brand"])


PER_YEAR_SQL = "SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, COUNT(*) AS n FROM orders GROUP BY 1"


def _per_year(spark, folder):
    return orders(spark, folder).groupBy(F.year("o_orderdate").alias("yr")).agg(F.count("*").alias("n"))


@query("yoy_delta", f"SELECT yr, n, lag(n) OVER (ORDER BY yr) AS previous, n - lag(n) OVER (ORDER BY yr) AS change FROM ({PER_YEAR_SQL}) ORDER BY yr")
def yoy_delta(spark, folder):
    return with_previous(_per_year(spark, folder), "yr", "n").drop("running_total").orderBy("yr")


@query("running_total", f"SELECT yr, n, CAST(SUM(n) OVER (ORDER BY yr) AS BIGINT) AS running_total FROM ({PER_YEAR_SQL}) ORDER BY yr")
def running_total(spark, folder):
    return with_previous(_per_year(spark, folder), "yr", "n").select("yr", "n", "running_total").orderBy("yr")


RUNNING_SQL = """SELECT o_orderkey, {keys}CAST(o_orderdate AS DATE) AS day,
      CAST(SUM(CAST(o_totalprice AS DECIMAL(18, 2))) OVER w AS DOUBLE) AS total, COUNT(*) OVER w AS orders_so_far,
      MIN(o_totalprice) OVER w AS least, MAX(o_totalprice) OVER w AS most
    FROM orders WINDOW w AS ({by}ORDER BY CAST(o_orderdate AS DATE))"""


def _running(spark, folder, *groups):
    placed = orders(spark, folder).select("o_orderkey", *groups, order_day().alias("day"), "o_totalprice")
    values = {
        "total": ("sum", F.col("o_totalprice").cast("decimal(18,2)")),
        "orders_so_far": ("count", F.lit(1)),
        "least": ("min", "o_totalprice"),
        "most": ("max", "o_totalprice"),
    }
    return running(placed, ["day"], values, partition_by=groups).drop("o_totalprice").withColumn("total", F.col("total").cast("double"))


@query("running_by_day", RUNNING_SQL.format(keys="", by=""))
def running_by_day(spark, folder):
    """Every order with the totals up to its day, days being peers; no task sees all days."""
    return _running(spark, folder)


@query("running_by_day_each_priority", RUNNING_SQL.format(keys="o_orderpriority, ", by="PARTITION BY o_orderpriority "))
def running_by_day_each_priority(spark, folder):
    return _running(spark, folder, "o_orderpriority")


@query(
    "pct_of_group",
    f"""SELECT o_orderkey, o_orderpriority, o_totalprice, round({SUM_OVER}, 2) AS type_total,
      round(100.0::DOUBLE * o_totalprice / nullif({SUM_OVER}, 0), 4) AS pct FROM orders""",
)
def pct_of_group(spark, folder):
    rows = with_group_values(_priced(spark, folder), ["o_orderpriority"], {"type_total": total("o_totalprice")})
    whole = F.nullif(F.col("type_total"), F.lit(0.0))  # a group without an amount has no shares
    return rows.withColumn("pct", percent_of(F.col("o_totalprice"), whole, 4)).withColumn("type_total", F.round("type_total", 2))


NTILE_SQL = """SELECT o_orderkey, o_totalprice, CAST(q AS INTEGER) AS quartile, CASE q WHEN 1 THEN 'simple' WHEN 2 THEN 'moderate'
      WHEN 3 THEN 'complex' WHEN 4 THEN 'very complex' END AS level
    FROM (SELECT o_orderkey, o_totalprice, ntile(4) OVER (ORDER BY o_totalprice, o_orderkey) AS q FROM orders)"""


def _levels(spark, folder, **limits):
    rows = orders(spark, folder).select("o_orderkey", "o_totalprice")
    tiled = ranked(rows, order_by=["o_totalprice"], tie_break=["o_orderkey"], ntile={"quartile": 4}, **limits)
    level = "CASE quartile WHEN 1 THEN 'simple' WHEN 2 THEN 'moderate' WHEN 3 THEN 'complex' WHEN 4 THEN 'very complex' END"
    return tiled.withColumn("level", F.expr(level))


@query("ntile_level", NTILE_SQL)
def ntile_level(spark, folder):
    return _levels(spark, folder)


@query("ntile_level_by_ranges", NTILE_SQL)
def ntile_level_by_ranges(spark, folder):
    """The same through key ranges, the way a large input takes."""
    return _levels(spark, folder, direct_rows=0)
