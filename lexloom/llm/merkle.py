"""Merkle manifest of a table: digests of rows, of runs of them, of groups and of all, with a proof for every row.

Each group of rows (a language, say) is a tree over its rows in order, ``ARITY``
children to a node; the groups' roots are the leaves of one more tree.  A node is
labelled with the interval of leaf ranks that it covers.  Intervals nest, so
everything about the shape is a comparison of labels:

* the parent of a node is the one interval of the next level that contains its
  own; both ends carry the same bucket (rank divided by the width of that
  level), which makes the containment an equi-join on (tree, bucket);
* the siblings of a node are what its parent's interval leaves when its own is
  taken away: the children before its low end and those from its high end on.

Levels are built upwards, each stored and an eighth of the one below, and paths
are handed down the same way, one join per level, so only the rows' own digests
are ever moved by the number of rows.  A hot group is ranked in ranges and joined by
runs of eight, so it meets in no task.

Defined results: null values are told from empty ones; rows without an order
value come first; rows with equal order values are ordered by digest, and equal rows stay as
many; a null group is a group, the first one; a group of one row has its leaf as
root; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.operators.ranked import ranked
from lexloom.sources.scratch import materialize

ARITY = 8
#: Groups above this many rows are ranked in ranges; a task then sorts about so few.
DIRECT_ROWS = 10_000
_NO_PATH = "array<struct<before:string,after:string>>"


def digest_of(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of values that are told apart by their lengths; ``-`` is a missing one."""
    parts = []
    for column in columns:
        text = column.cast("string")
        parts.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)


def _node(children: Column) -> Column:
    """Digest of a node from the digests of its children."""
    return F.sha2(F.concat_ws("", F.transform(children, lambda c: c["digest"])), 256)


def _siblings(children: Column, lo: Column, hi: Column) -> Column:
    """What the parent's children leave of its interval without [lo, hi): digests before and after."""
    before = F.filter(children, lambda c: c["hi"] <= lo)
    after = F.filter(children, lambda c: c["lo"] >= hi)
    text = lambda cs: F.concat_ws("", F.transform(cs, lambda c: c["digest"]))
    return F.struct(text(before).alias("before"), text(after).alias("after"))


class _Forest:
    """Trees over numbered leaves: ``runs[k]`` are the nodes of level k + 1 with their children."""

    def __init__(self, leaves: DataFrame, order_by: Sequence[str]):
        """``leaves``: a stored table of tree (text, not null), digest, the order columns and others, which stay with them."""
        sizes = leaves.groupBy("tree").agg(F.count(F.lit(1)).alias("size"))
        # Levels above the leaves: the least power of ARITY that is not below the size.
        powers = F.array(*[F.lit(ARITY**k).cast("long") for k in range(21)])
        height = F.size(F.filter(powers, lambda p: p < F.col("size")))
        sizes = materialize(sizes.select(F.col("tree").alias("__tree"), height.alias("height")), "merkle-sizes")
        numbered = ranked(leaves, partition_by=["tree"], order_by=order_by, tie_break=["digest"], row_number="lo", direct_rows=DIRECT_ROWS)
        numbered = numbered.withColumn("lo", F.col("lo") - 1).withColumn("hi", F.col("lo") + 1)
        numbered = numbered.join(sizes, F.col("tree") == F.col("__tree")).drop("__tree")
        self.height = sizes.agg(F.max("height")).first()[0] or 0
        others = [c for c in leaves.columns if c not in ("tree", "digest")]
        self.runs = [self._level(numbered, 1, others)]
        for level in range(2, self.height + 1):
            self.runs.append(self._level(self.runs[-1].filter(F.col("height") >= level), level, []))
        # The root of a tree is its only node of the last level, or its only leaf.
        only = F.when(F.col("height") == 0, F.col("children")[0]["digest"]).otherwise(F.col("digest"))
        of = [run.filter(F.col("height") <= level).select("tree", only.alias("root")) for level, run in enumerate(self.runs, 1)]
        roots = of[0]
        for more in of[1:]:
            roots = roots.unionByName(more)
        self.roots = materialize(roots, "merkle-roots")

    @staticmethod
    def _level(nodes: DataFrame, level: int, others: Sequence[str]) -> DataFrame:
        children = F.sort_array(F.collect_list(F.struct("lo", "hi", "digest", *others)))
        bucket = F.expr(f"lo div {ARITY**level}").alias("bucket")
        runs = nodes.groupBy("tree", "height", bucket).agg(children.alias("children"))
        ends = runs.select("*", F.col("children")[0]["lo"].alias("lo"), F.element_at("children", -1)["hi"].alias("hi"))
        return materialize(ends.withColumn("digest", _node(F.col("children"))), f"merkle-level-{level}")

    def leaves(self, tops: DataFrame) -> DataFrame:
        """All leaves with their path up to the roots and on as ``tops`` (tree, path and more columns) says.

        A path is an array of the siblings before and after, from the leaf's own run upwards.
        """
        carried = [c for c in tops.columns if c not in ("tree", "path")]
        at_top = tops.withColumnRenamed("tree", "__tree")
        above = None
        for level in range(len(self.runs), 0, -1):
            run = self.runs[level - 1]
            found = run.filter(F.col("height") <= level).join(at_top, F.col("tree") == F.col("__tree")).drop("__tree")
            if above is not None:
                # The ancestor whose interval contains this one lies in the same bucket of its level.
                parents = above.select(
                    F.col("tree").alias("__tree"), F.col("bucket").alias("__bucket"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                    F.col("children").alias("__children"), F.col("path").alias("__path"), *carried,
                )
                same = (F.col("tree") == F.col("__tree")) & (F.expr(f"lo div {ARITY ** (level + 1)}") == F.col("__bucket"))
                same &= (F.col("__lo") <= F.col("lo")) & (F.col("hi") <= F.col("__hi"))
                inside = run.filter(F.col("height") > level).join(parents, same)
                step = F.array(_siblings(F.col("__children"), F.col("lo"), F.col("hi")))
                inside = inside.select(*run.columns, F.concat(step, F.col("__path")).alias("path"), *carried)
                found = found.select(*run.columns, "path", *carried).unionByName(inside)
            above = found
        rows = above.select("tree", "height", "children", "path", *carried, F.explode("children").alias("leaf"))
        own = F.array(_siblings(F.col("children"), F.col("leaf")["lo"], F.col("leaf")["hi"]))
        path = F.when(F.col("height") == 0, F.col("path")).otherwise(F.concat(own, F.col("path")))
        return rows.select("tree", "leaf.*", path.alias("path"), *carried)


def fold_path(leaf: Column, path: Column) -> Column:
    """The root that a leaf leads to, taken up its path."""
    return F.aggregate(path, leaf, lambda at, step: F.sha2(F.concat(step["before"], at, step["after"]), 256))


def proof_digest(path: Column) -> Column:
    """One digest over all siblings of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"]))), 256)


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order_by: str = "doc_id",
    claims: dict[str, Column] | None = None,
    claimed: Column | None = None,
) -> DataFrame:
    """Per row: the order column, leaf, subroot, root, path, claimed (the digest to be proved) and folded_root.

    ``claims`` replaces columns of the rows where ``claimed`` is true, as someone else's copy of the table
    would have them; elsewhere the claimed digest is the leaf itself.
    """
    leaf = digest_of([F.col(f"`{c}`") for c in columns])
    other = digest_of([(claims or {}).get(c, F.col(f"`{c}`")) for c in columns])
    # Sorts as the groups do: the missing one first, then by UTF-8 bytes.
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    rows = docs.select(
        tree.alias("tree"),
        F.col(f"`{order_by}`").alias("key"),
        leaf.alias("digest"),
        # Only what differs is stored twice.
        (F.lit(None).cast("string") if claimed is None else F.when(claimed, other)).alias("claimed"),
    )
    forest = _Forest(materialize(rows, "merkle-leaves"), ["key"])
    subroots = forest.roots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), F.col("root").alias("digest"))
    top = _Forest(materialize(subroots, "merkle-subroots"), ["key"])
    tops = top.roots.select("tree", F.array().cast(_NO_PATH).alias("path"), "root")
    paths = top.leaves(tops).select(F.col("key").alias("tree"), F.col("digest").alias("subroot"), "path", "root")
    found = forest.leaves(materialize(paths, "merkle-top"))
    proved = F.coalesce("claimed", "digest")
    return found.select(
        F.col("key").alias(order_by), F.col("digest").alias("leaf"), "subroot", "root", "path",
        proved.alias("claimed"), fold_path(proved, F.col("path")).alias("folded_root"),
    )
