"""Connected components of an edge table that may be larger than any one machine.

Large-star and small-star steps in turn: every node's neighbours are hung on the
smallest node seen, until the graph is a star per component.  Minima are
aggregated before the shuffle, so a node with very many edges costs one row per
task, and each round is stored, so a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.sources.scratch import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with an edge to another one; the component is its smallest node.

    Null ends, loops and repeated edges are ignored.
    """
    edges = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    edges = edges.filter(F.col("a").isNotNull() & (F.col("a") != F.col("b")) & F.col("b").isNotNull())
    stars, state = materialize(edges.distinct(), "edges"), None
    while True:
        stars = materialize(_small_star(_large_star(stars)), "stars")
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = now


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest one."""
    smallest = edges.select(F.col("a").alias("u"), F.col("b").alias("m")).unionByName(edges.select(F.col("b").alias("u"), F.col("b").alias("m")))
    smallest = smallest.groupBy("u").agg(F.min("m").alias("m"))
    return edges.withColumnRenamed("b", "u").join(smallest, "u").select("a", F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(smallest, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct()
