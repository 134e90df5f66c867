"""Citation chains.

A line's part "cites" the part of the order's next line.  The edge list is
derived from all of ``lineitem``; chains start from one part.
"""

from pyspark.sql import functions as F

from lexloom.operators.references import chain_sql, citation_chain, reach, successor_edges
from lexloom.queries.registry import query
from lexloom.sources.readers import read_table

SEED = 42

EDGES_SQL = """lines AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey FROM lineitem),
    e AS (SELECT DISTINCT source, target FROM (SELECT l_partkey AS source, lead(l_partkey) OVER (
      PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS target FROM lines) WHERE target IS NOT NULL)"""


def _edges(spark, folder):
    return successor_edges(read_table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber", "l_partkey")


def _nodes(spark, folder):
    return read_table(spark, folder, "part").select(F.col("p_partkey").alias("node"), F.col("p_name").alias("name"))


@query("reference_edges", f"WITH {EDGES_SQL} SELECT source, target FROM e")
def reference_edges(spark, folder):
    return _edges(spark, folder)


CHAIN_SQL = f"""WITH RECURSIVE {EDGES_SQL}, chain AS (
      SELECT p_partkey AS node, p_name AS name, 0 AS depth, p_name AS path FROM part WHERE p_partkey = {SEED}
      UNION ALL SELECT p_partkey, p_name, depth + 1, path || ' → ' || p_name FROM chain
        JOIN e ON node = target JOIN part ON source = p_partkey WHERE depth < 3)
    SELECT node, name, depth, path FROM chain"""


@query("ref_chain", CHAIN_SQL)
def ref_chain(spark, folder):
    nodes = _nodes(spark, folder)
    return citation_chain(nodes.filter(F.col("node") == SEED), _edges(spark, folder), nodes, max_depth=3)


@query("ref_chain_sql", CHAIN_SQL)
def ref_chain_sql(spark, folder):
    """The chain as users write it, a recursive query over views."""
    _edges(spark, folder).createOrReplaceTempView("citation")
    _nodes(spark, folder).createOrReplaceTempView("cited_part")
    return spark.sql(chain_sql(f"node = {SEED}", "citation", "cited_part", max_depth=3))


@query(
    "ref_reach",
    f"""WITH RECURSIVE {EDGES_SQL}, chain AS (
      SELECT p_partkey AS node, 0 AS depth FROM part WHERE p_partkey = {SEED}
      UNION ALL SELECT source, depth + 1 FROM chain JOIN e ON node = target WHERE depth < 3)
    SELECT node, MIN(depth) AS depth FROM chain GROUP BY node""",
)
def ref_reach(spark, folder):
    return reach(_nodes(spark, folder).filter(F.col("node") == SEED), _edges(spark, folder), max_depth=3)
