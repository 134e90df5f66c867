"""Citation graph: edges, bounded chains and reachability.

Each round joins the last level with the stored edges and stores the new
level, so its true size picks the join, lineage stays one step long, and a lost
executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.operators.ranked import ranked
from lexloom.sources.scratch import materialize

PATH_SEPARATOR = " → "


def successor_edges(rows: DataFrame, group: str, position: str, item: str) -> DataFrame:
    """Edges ``source -> target`` from each item of an ordered group to the next one.

    ``rows`` may repeat; a group makes one edge per distinct row, not one per pair.
    """
    lines = materialize(rows.select(group, position, item).distinct(), "lines")
    followed = ranked(lines, partition_by=[group], order_by=[position], tie_break=[item], lead={"target": item})
    edges = followed.filter(F.col("target").isNotNull())
    return materialize(edges.select(F.col(item).alias("source"), "target").distinct(), "edges")


def _citing(level: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows of ``level`` once per node that cites their ``node``, as ``citing``."""
    return level.join(edges.select(F.col("source").alias("citing"), "target"), F.col("node") == F.col("target")).drop("target")


def chain_sql(seed: str, edges: str, names: str, max_depth: int) -> str:
    """The same chain as one recursive query over views; ``seed`` is a condition on ``node``.

    The views have the columns that ``citation_chain`` asks of its tables.  Spark ends the recursion with an error
    beyond ``spark.sql.cteRecursionRowLimit`` rows (a million by default) or ``spark.sql.cteRecursionLevelLimit``
    levels (100); a cycle ends at ``max_depth`` only.  ``citation_chain`` has no such limits.
    """
    return f"""WITH RECURSIVE chain (node, name, depth, path) AS (
        SELECT node, name, 0, name FROM {names} WHERE {seed}
        UNION ALL
        SELECT e.source, n.name, depth + 1, concat(path, '{PATH_SEPARATOR}', n.name)
        FROM chain JOIN {edges} e ON e.target = chain.node JOIN {names} n ON n.node = e.source
        WHERE depth < {max_depth})
      SELECT node, name, depth, path FROM chain"""


def citation_chain(seeds: DataFrame, edges: DataFrame, names: DataFrame, max_depth: int = 3) -> DataFrame:
    """All citation paths that end in a seed, with depth and path text.

    ``seeds`` and ``names`` have ``node`` and ``name``; ``edges`` has ``source``
    (the citing node) and ``target``.  Paths are enumerated: a node reached twice
    appears twice, and only the depth guard ends a cycle.
    """
    level = seeds.select("node", "name", F.lit(0).alias("depth"), F.col("name").alias("path"))
    levels = [level]
    titled = names.select(F.col("node").alias("citing"), F.col("name").alias("citing_name"))
    for _ in range(max_depth):
        step = _citing(level, edges).join(titled, "citing").select(
            F.col("citing").alias("node"),
            F.col("citing_name").alias("name"),
            (F.col("depth") + 1).alias("depth"),
            F.concat("path", F.lit(PATH_SEPARATOR), "citing_name").alias("path"),
        )
        level = materialize(step, "chain-level")
        levels.append(level)
    chain = levels[0]
    for level in levels[1:]:
        chain = chain.unionByName(level)
    return chain


def reach(seeds: DataFrame, edges: DataFrame, max_depth: int = 3) -> DataFrame:
    """Every node that cites a seed directly or through others, with its least depth.

    Each node is expanded once, so the work is bounded by the edges even where
    the number of paths explodes.
    """
    level = materialize(seeds.select("node").distinct().withColumn("depth", F.lit(0)), "reach-level")
    visited = level
    for depth in range(1, max_depth + 1):
        new = _citing(level, edges).select(F.col("citing").alias("node")).distinct()
        new = new.join(visited.select("node"), "node", "left_anti").withColumn("depth", F.lit(depth))
        level = materialize(new, "reach-level")
        if level.isEmpty():
            break
        visited = visited.unionByName(level)
    return visited
