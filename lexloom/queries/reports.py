"""Topic reports through the bridge."""

from pyspark.sql import functions as F

from lexloom.functions.numbers import total
from lexloom.operators.bridges import attributed, links_per, share_per_link
from lexloom.operators.groups import first_per_group
from lexloom.operators.ranked import Desc, ranked
from lexloom.operators.trends import compare_periods
from lexloom.queries.model import BRIDGE_SQL, order_day, orders, topic_bridge
from lexloom.queries.registry import query
from lexloom.sources.readers import read_table
from lexloom.sources.scratch import materialize

def _parts(spark, folder, *columns):
    return read_table(spark, folder, "part").select("p_partkey", *columns)


def _bridge(spark, folder):
    return topic_bridge(spark, folder).withColumnRenamed("l_orderkey", "o_orderkey")


@query(
    "top_topics",
    f"""WITH {BRIDGE_SQL} SELECT p_brand, p_type, COUNT(*) AS num_docs FROM b JOIN part ON l_partkey = p_partkey
    GROUP BY p_brand, p_type ORDER BY num_docs DESC, p_brand, p_type LIMIT 5""",
)
def top_topics(spark, folder):
    per_part = links_per(topic_bridge(spark, folder), "l_partkey", "n")
    joined = per_part.join(_parts(spark, folder, "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    counted = joined.groupBy("p_brand", "p_type").agg(F.sum("n").alias("num_docs"))
    return counted.orderBy(F.desc("num_docs"), "p_brand", "p_type").limit(5)


@query(
    "per_topic_share",
    f"""WITH {BRIDGE_SQL}, n AS (SELECT l_orderkey, COUNT(*) AS links FROM b GROUP BY l_orderkey)
    SELECT o_orderkey, o_totalprice, links, o_totalprice * 1.0::DOUBLE / links AS price_per_link
    FROM orders JOIN n ON o_orderkey = l_orderkey""",
)
def per_topic_share(spark, folder):
    linked = share_per_link(orders(spark, folder), _bridge(spark, folder), "o_orderkey", "o_totalprice")
    return linked.select("o_orderkey", "o_totalprice", "links", F.col("share").alias("price_per_link"))


@query(
    "fair_attribution",
    f"""WITH {BRIDGE_SQL}, n AS (SELECT l_orderkey, COUNT(*) AS links FROM b GROUP BY l_orderkey)
    SELECT p_brand, round(SUM(o_totalprice * 1.0::DOUBLE / links), 2) AS attributed
    FROM b JOIN n USING (l_orderkey) JOIN orders ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY p_brand""",
)
def fair_attribution(spark, folder):
    per_part = attributed(orders(spark, folder), _bridge(spark, folder), "o_orderkey", "l_partkey", "o_totalprice")
    joined = per_part.join(_parts(spark, folder, "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_brand").agg(total("attributed", 2).alias("attributed"))


@query(
    "trend_by_topic",
    f"""WITH {BRIDGE_SQL}, per_year AS (
      SELECT p_brand, year(o_orderdate) AS yr, COUNT(*) AS n FROM orders JOIN b ON o_orderkey = l_orderkey
      JOIN part ON l_partkey = p_partkey GROUP BY 1, 2),
    compared AS (SELECT p_brand, CAST(SUM(CASE WHEN yr BETWEEN 1995 AND 1997 THEN n ELSE 0 END) AS BIGINT) AS early,
      CAST(SUM(CASE WHEN yr BETWEEN 1999 AND 2001 THEN n ELSE 0 END) AS BIGINT) AS recent FROM per_year GROUP BY p_brand)
    SELECT p_brand, early, recent, recent - early AS change, CASE WHEN recent > early THEN 'accelerating'
      WHEN recent = early THEN 'stable' ELSE 'slowing' END AS trend FROM compared ORDER BY change DESC, p_brand""",
)
def trend_by_topic(spark, folder):
    dated = orders(spark, folder).select("o_orderkey", F.year("o_orderdate").alias("yr"))
    # Counted per part and year before the topic table joins in.
    per_part = _bridge(spark, folder).join(dated, "o_orderkey").groupBy("l_partkey", "yr").agg(F.count("*").alias("n"))
    per_year = per_part.join(_parts(spark, folder, "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    per_year = per_year.groupBy("p_brand", "yr").agg(F.sum("n").alias("n"))
    return compare_periods(per_year, "p_brand", "yr", "n", (1995, 1997), (1999, 2001)).orderBy(F.desc("change"), "p_brand")


@query(
    "topic_ranking",
    f"""WITH {BRIDGE_SQL}, per_topic AS (SELECT p_brand, SUM(o_totalprice) AS total
      FROM orders JOIN b ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey GROUP BY p_brand)
    SELECT row_number() OVER (ORDER BY total DESC, p_brand) AS ranking, p_brand, round(total, 2) AS total
    FROM per_topic ORDER BY ranking""",
)
def topic_ranking(spark, folder):
    priced = _bridge(spark, folder).join(orders(spark, folder).select("o_orderkey", "o_totalprice"), "o_orderkey")
    per_part = priced.groupBy("l_partkey").agg(total("o_totalprice").alias("part_total"))
    joined = per_part.join(_parts(spark, folder, "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    per_topic = materialize(joined.groupBy("p_brand").agg(total("part_total").alias("total")), "topic-totals")
    numbered = ranked(per_topic, order_by=[Desc("total")], tie_break=["p_brand"], row_number="ranking")
    return numbered.select("ranking", "p_brand", F.round("total", 2).alias("total")).orderBy("ranking")


@query(
    "top1_per_group",
    f"""WITH {BRIDGE_SQL} SELECT p_brand, o_orderkey, published FROM (
      SELECT p_brand, o_orderkey, CAST(o_orderdate AS DATE) AS published,
        row_number() OVER (PARTITION BY p_brand ORDER BY o_orderdate DESC, o_orderkey) AS rn
      FROM orders JOIN b ON o_orderkey = l_orderkey JOIN part ON l_partkey = p_partkey) WHERE rn = 1""",
)
def top1_per_group(spark, folder):
    dated = orders(spark, folder).select("o_orderkey", order_day().alias("published"))
    newest = [F.desc("published"), F.col("o_orderkey")]
    # The newest of a topic is the newest of its parts' newest; repeated links
    # change nothing, so they need no shuffle of their own.
    links = read_table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    per_part = first_per_group(links.join(dated, "o_orderkey"), ["l_partkey"], newest)
    joined = per_part.join(_parts(spark, folder, "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return first_per_group(joined.select("p_brand", "o_orderkey", "published"), ["p_brand"], newest)
