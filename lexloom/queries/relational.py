"""Projections, filters, joins, aggregates and constraint checks."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.functions.dates import in_years
from lexloom.functions.numbers import as_whole, mean, total
from lexloom.operators.bridges import full_outer, left_counts, links_per, pair_with_all, star
from lexloom.operators.groups import duplicated_keys, null_counts, orphan_keys, with_defaults
from lexloom.operators.quantiles import summary
from lexloom.queries.model import BRIDGE_SQL, order_day, orders, topic_bridge
from lexloom.queries.registry import query
from lexloom.sources.readers import read_table

# Sums of doubles differ in their last bits with the order of the rows, so reports round them.
MONEY_SUM = "round(SUM(o_totalprice), 2)"


# --- projections -------------------------------------------------------------


@query("project_rename", "SELECT o_orderkey AS document_id, o_orderpriority AS doc_type, CAST(o_orderdate AS DATE) AS published FROM orders")
def project_rename(spark, folder):
    renamed = orders(spark, folder).withColumnRenamed("o_orderkey", "document_id").withColumn("published", order_day())
    return renamed.drop("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate").withColumnRenamed("o_orderpriority", "doc_type")


@query("computed_col", "SELECT o_orderkey, o_totalprice, o_totalprice * 2 AS doubled, o_totalprice - 1000 AS reduced FROM orders")
def computed_col(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", "o_totalprice")
    return rows.withColumn("doubled", F.col("o_totalprice") * 2).withColumn("reduced", F.col("o_totalprice") - 1000)


@query(
    "size_bucket",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS yr, CASE WHEN o_totalprice > 300000 THEN 'large'
      WHEN o_totalprice > 150000 THEN 'medium' ELSE 'small' END AS size FROM orders WHERE year(o_orderdate) = 1996""",
)
def size_bucket(spark, folder):
    price = F.col("o_totalprice")
    size = F.when(price > 300000, "large").when(price > 150000, "medium").otherwise("small")
    rows = orders(spark, folder).filter(in_years("o_orderdate", 1996, 1996))
    return rows.select("o_orderkey", F.year("o_orderdate").alias("yr"), size.alias("size"))


# --- filters -----------------------------------------------------------------


@query(
    "filter_basic",
    """SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
      AND o_totalprice >= 100000 AND o_totalprice < 200000 AND (o_custkey > 10 OR o_orderkey < 1000)""",
)
def filter_basic(spark, folder):
    rows = orders(spark, folder).filter(F.col("o_orderstatus") == "F").filter(F.col("o_orderpriority") != "5-LOW")
    rows = rows.filter("o_totalprice >= 100000 AND o_totalprice < 200000")
    return rows.filter((F.col("o_custkey") > 10) | (F.col("o_orderkey") < 1000)).select("o_orderkey", "o_totalprice")


@query(
    "filter_and_sort",
    """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders WHERE o_totalprice > 300000 AND o_orderstatus = 'O'
    ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey""",
)
def filter_and_sort(spark, folder):
    rows = orders(spark, folder).filter((F.col("o_totalprice") > 300000) & (F.col("o_orderstatus") == "O"))
    rows = rows.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return rows.orderBy("o_orderpriority", F.desc("o_totalprice"), "o_orderkey")


@query("filter_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%'")
def filter_like(spark, folder):
    return read_table(spark, folder, "part").filter(F.col("p_name").like("%ring%")).select("p_partkey", "p_name")


@query("limit_n", "SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def limit_n(spark, folder):
    """Five rows, by key so that everyone gets the same ones; the plan keeps five rows a task and never sorts all."""
    return orders(spark, folder).select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice").orderBy("o_orderkey").limit(5)


# --- joins -------------------------------------------------------------------


def _customers(spark, folder):
    return read_table(spark, folder, "customer").select("c_custkey", "c_name")


def _placed(spark, folder):
    return orders(spark, folder).select("o_orderkey", "o_custkey")


JOINED = "SELECT c_custkey, c_name, o_orderkey FROM"


@query("join_inner", f"{JOINED} customer JOIN orders ON c_custkey = o_custkey")
def join_inner(spark, folder):
    customers = _customers(spark, folder).withColumnRenamed("c_custkey", "o_custkey")
    joined = customers.join(_placed(spark, folder), on="o_custkey")
    return joined.select(F.col("o_custkey").alias("c_custkey"), "c_name", "o_orderkey")


@query("join_right", f"{JOINED} customer RIGHT JOIN orders ON c_custkey = o_custkey")
def join_right(spark, folder):
    customers, placed = _customers(spark, folder), _placed(spark, folder)
    return customers.join(placed, customers.c_custkey == placed.o_custkey, "right").drop("o_custkey")


@query("join_full", f"{JOINED} customer FULL JOIN orders ON c_custkey = o_custkey")
def join_full(spark, folder):
    joined = full_outer(_placed(spark, folder), _customers(spark, folder), "o_custkey", "c_custkey")
    return joined.select("c_custkey", "c_name", "o_orderkey")


@query(
    "join_star",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, c_name, n_name, r_name FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    ORDER BY o_orderdate DESC, o_orderkey LIMIT 10""",
)
def join_star(spark, folder):
    nations = star(read_table(spark, folder, "nation"), [(read_table(spark, folder, "region"), "n_regionkey", "r_regionkey")])
    placed = orders(spark, folder).select("o_orderkey", "o_custkey", order_day().alias("o_orderdate"))
    joined = star(placed, [(read_table(spark, folder, "customer"), "o_custkey", "c_custkey"), (nations, "c_nationkey", "n_nationkey")])
    joined = joined.select("o_orderkey", "o_orderdate", "c_name", "n_name", "r_name")
    return joined.orderBy(F.desc("o_orderdate"), "o_orderkey").limit(10)


@query(
    "citation_counts",
    f"WITH {BRIDGE_SQL} SELECT o_orderkey, COUNT(l_partkey) AS cited FROM orders LEFT JOIN b ON o_orderkey = l_orderkey GROUP BY o_orderkey",
)
def citation_counts(spark, folder):
    pairs = topic_bridge(spark, folder).withColumnRenamed("l_orderkey", "o_orderkey")
    return left_counts(orders(spark, folder).select("o_orderkey"), pairs, "o_orderkey", "cited")


@query(
    "cross_bridge",
    """SELECT o_orderkey, n_nationkey FROM orders CROSS JOIN nation WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND n_name <> 'NATION_24'
    UNION ALL SELECT o_orderkey, n_nationkey FROM orders CROSS JOIN nation WHERE o_orderdate < TIMESTAMP '1998-01-01'""",
)
def cross_bridge(spark, folder):
    placed = orders(spark, folder).select("o_orderkey", "o_orderdate")
    from_1998 = F.to_timestamp(F.lit("1998-01-01"))
    late, early = F.col("o_orderdate") >= from_1998, F.col("o_orderdate") < from_1998
    nations = read_table(spark, folder, "nation")
    pairs = pair_with_all(placed, nations, "n_nationkey", early | (late & (F.col("n_name") != "NATION_24")), carry=["n_name"])
    return pairs.select("o_orderkey", "n_nationkey")


@query("fanout_none", f"SELECT COUNT(*) AS docs, {MONEY_SUM} AS total FROM orders")
def fanout_none(spark, folder):
    return orders(spark, folder).agg(F.count("*").alias("docs"), total("o_totalprice", 2).alias("total"))


@query("fanout_inflated", f"WITH {BRIDGE_SQL} SELECT COUNT(*) AS docs, {MONEY_SUM} AS total FROM orders JOIN b ON o_orderkey = l_orderkey")
def fanout_inflated(spark, folder):
    joined = orders(spark, folder).join(topic_bridge(spark, folder), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.agg(F.count("*").alias("docs"), total("o_totalprice", 2).alias("total"))


@query(
    "fanout_inflated_sub",
    f"""WITH {BRIDGE_SQL} SELECT round(SUM(contribution), 2) AS inflated_total FROM (
      SELECT o_totalprice * COUNT(*) AS contribution FROM orders JOIN b ON o_orderkey = l_orderkey
      GROUP BY o_orderkey, o_totalprice)""",
)
def fanout_inflated_sub(spark, folder):
    links = links_per(topic_bridge(spark, folder), "l_orderkey")
    joined = orders(spark, folder).join(links, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.agg(total(F.col("o_totalprice") * F.col("links"), 2).alias("inflated_total"))


@query(
    "fanout_distinct",
    f"""WITH {BRIDGE_SQL}, once AS (SELECT DISTINCT o_orderkey, o_totalprice FROM orders JOIN b ON o_orderkey = l_orderkey)
    SELECT COUNT(DISTINCT o_orderkey) AS docs, {MONEY_SUM} AS total FROM once""",
)
def fanout_distinct(spark, folder):
    linked = read_table(spark, folder, "lineitem").select("l_orderkey").distinct()
    priced = orders(spark, folder).select("o_orderkey", "o_totalprice")
    # A semi join repeats nothing; distinct reuses its partitioning.
    once = priced.join(linked, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").distinct()
    return once.agg(F.count_distinct("o_orderkey").alias("docs"), total("o_totalprice", 2).alias("total"))


# --- aggregates ----------------------------------------------------------------

MEAN = "AVG(o_totalprice)"


@query(
    "agg_global",
    f"""SELECT COUNT(*) AS n, round({MEAN}, 4) AS mean_price, MIN(o_totalprice) AS min_price, MAX(o_totalprice) AS max_price,
    {MONEY_SUM} AS total FROM orders""",
)
def agg_global(spark, folder):
    price = F.col("o_totalprice")
    return orders(spark, folder).agg(
        F.count("*").alias("n"), F.round(mean("o_totalprice"), 4).alias("mean_price"), F.min(price).alias("min_price"),
        F.max(price).alias("max_price"), total("o_totalprice", 2).alias("total"),
    )


@query(
    "describe_measure",
    f"""SELECT COUNT(o_totalprice) AS n, round({MEAN}, 2) AS mean, round(stddev_samp(o_totalprice), 2) AS stddev,
    MIN(o_totalprice) AS min, MAX(o_totalprice) AS max FROM orders""",
)
def describe_measure(spark, folder):
    price = F.col("o_totalprice")
    return orders(spark, folder).agg(
        F.count(price).alias("n"), F.round(mean("o_totalprice"), 2).alias("mean"),
        F.round(F.stddev_samp(price), 2).alias("stddev"), F.min(price).alias("min"), F.max(price).alias("max"),
    )


@query(
    "summary_quartiles",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT({c}) AS n, COUNT(*) - COUNT({c}) AS missing, CAST(MIN({c}) AS DOUBLE) AS least, CAST(round(AVG({c}), 2) AS DOUBLE) AS mean,
      CAST(MAX({c}) AS DOUBLE) AS greatest, """
        + ", ".join(f"(SELECT CAST({c} AS DOUBLE) FROM (SELECT {c}, row_number() OVER (ORDER BY {c}) AS r, COUNT(*) OVER () AS n FROM {t}) WHERE r = ceil(n * {q})) AS q{q[2:]}" for q in ("0.25", "0.50", "0.75"))
        + f" FROM {t}"
        for t, c in (("orders", "o_totalprice"), ("orders", "o_custkey"), ("lineitem", "l_quantity"), ("lineitem", "l_discount"))
    ),
)
def summary_quartiles(spark, folder):
    """Exact quartiles by selection; no sort of all rows."""
    of_orders = summary(orders(spark, folder), ["o_totalprice", "o_custkey"])
    of_lines = summary(read_table(spark, folder, "lineitem"), ["l_quantity", "l_discount"])
    return of_orders.unionByName(of_lines).withColumn("mean", F.round("mean", 2))


@query("agg_by_key", f"SELECT o_orderpriority, COUNT(*) AS n, {MONEY_SUM} AS total FROM orders GROUP BY o_orderpriority ORDER BY n DESC, o_orderpriority")
def agg_by_key(spark, folder):
    grouped = orders(spark, folder).groupBy("o_orderpriority").agg(F.count("*").alias("n"), total("o_totalprice", 2).alias("total"))
    return grouped.orderBy(F.desc("n"), "o_orderpriority")


@query(
    "agg_by_dimension",
    "SELECT n_name, COUNT(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name ORDER BY n DESC, n_name",
)
def agg_by_dimension(spark, folder):
    # Orders are counted per customer before they meet the dimension.
    per_customer = orders(spark, folder).groupBy("o_custkey").agg(F.count("*").alias("n"))
    customers = read_table(spark, folder, "customer")
    joined = star(per_customer, [(customers, "o_custkey", "c_custkey"), (read_table(spark, folder, "nation"), "c_nationkey", "n_nationkey")])
    return joined.groupBy("n_name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "n_name")


@query(
    "agg_two_keys",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, o_orderpriority, COUNT(*) AS n FROM orders GROUP BY 1, 2
    ORDER BY yr, n DESC, o_orderpriority""",
)
def agg_two_keys(spark, folder):
    grouped = orders(spark, folder).groupBy(F.year("o_orderdate").alias("yr"), "o_orderpriority").count()
    return grouped.withColumnRenamed("count", "n").orderBy("yr", F.desc("n"), "o_orderpriority")


@query("agg_having", "SELECT o_custkey, COUNT(*) AS n FROM orders GROUP BY o_custkey HAVING COUNT(*) > 12")
def agg_having(spark, folder):
    return orders(spark, folder).groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n > 12")


@query(
    "avg_rounded",
    f"SELECT o_orderpriority, COUNT(*) AS n, round({MEAN}, 1) AS mean_1, CAST(round({MEAN}) AS INTEGER) AS mean_whole FROM orders GROUP BY o_orderpriority",
)
def avg_rounded(spark, folder):
    price = mean("o_totalprice")
    return orders(spark, folder).groupBy("o_orderpriority").agg(
        F.count("*").alias("n"), F.round(price, 1).alias("mean_1"), as_whole(price).alias("mean_whole")
    )


@query(
    "replication_hist",
    f"WITH {BRIDGE_SQL} SELECT links, COUNT(*) AS docs FROM (SELECT l_orderkey, COUNT(*) AS links FROM b GROUP BY l_orderkey) GROUP BY links ORDER BY links",
)
def replication_hist(spark, folder):
    per_document = links_per(topic_bridge(spark, folder), "l_orderkey")
    return per_document.groupBy("links").agg(F.count("*").alias("docs")).orderBy("links")


# --- constraints ---------------------------------------------------------------

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("constraint_not_null", "SELECT " + ", ".join(f"COUNT(*) FILTER ({c} IS NULL) AS {c}" for c in ORDER_COLUMNS) + " FROM orders")
def constraint_not_null(spark, folder):
    return null_counts(orders(spark, folder), ORDER_COLUMNS)


@query(
    "default_values",
    "SELECT o_orderkey, COALESCE(lines, 0) AS lines FROM orders LEFT JOIN (SELECT l_orderkey, COUNT(*) AS lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey",
)
def default_values(spark, folder):
    counted = read_table(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("lines"))
    joined = orders(spark, folder).select("o_orderkey").join(counted, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return with_defaults(joined.select("o_orderkey", "lines"), {"lines": 0})


@query("constraint_unique", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def constraint_unique(spark, folder):
    return duplicated_keys(read_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


FOREIGN_KEYS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    ("documents", "doc_id", "labels", "doc_id"),
]


@query(
    "constraint_fk",
    " UNION ALL ".join(
        f"SELECT '{c}.{k}' AS foreign_key, '{p}.{pk}' AS parent_key, COUNT(*) AS orphan_rows, COUNT(DISTINCT {k}) AS orphan_keys "
        f"FROM {c} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {pk} FROM {p})"
        for c, k, p, pk in FOREIGN_KEYS
    ),
)
def constraint_fk(spark, folder):
    def orphans(child: str, key: str, parent: str, parent_key: str) -> DataFrame:
        keys = orphan_keys(read_table(spark, folder, child), key, read_table(spark, folder, parent), parent_key)
        counts = keys.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"), F.count("*").alias("orphan_keys"))
        return counts.select(F.lit(f"{child}.{key}").alias("foreign_key"), F.lit(f"{parent}.{parent_key}").alias("parent_key"), "*")

    return reduce(DataFrame.unionByName, [orphans(*k) for k in FOREIGN_KEYS])
