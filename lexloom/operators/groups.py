"""Group values on rows, duplicate removal, top-1, and constraint counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.operators.ranked import ranked
from lexloom.sources.scratch import materialize


# With more repeated keys than this, most rows would move anyway.
MANY_KEYS = 500_000


def with_group_values(df: DataFrame, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """Aggregates of each row's group, on every row (``agg OVER (PARTITION BY by)``).

    The groups are aggregated with map-side combining and joined back, so the
    rows of a hot group stay where they are.  The aggregate is stored first:
    its real size decides between a broadcast (no shuffle of the rows) and a
    shuffled join, which adaptive execution splits where a key is hot.
    """
    if not by:
        overall = df.agg(F.struct(*[v.alias(n) for n, v in values.items()]).alias("s")).scalar()
        return df.withColumns({name: overall[name] for name in values})
    keys = {f"__k{i}": name for i, name in enumerate(by)}
    grouped = df.groupBy(*[F.col(name).alias(k) for k, name in keys.items()]).agg(*[v.alias(n) for n, v in values.items()])
    grouped = materialize(grouped, "group-values")
    same = [df[name].eqNullSafe(grouped[k]) for k, name in keys.items()]
    return df.join(grouped, same, "left").drop(*keys)


def first_per_group(df: DataFrame, by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of every group; ``order_by`` must leave no ties.

    A row number that is compared with 1 right away becomes a group limit that
    runs before the shuffle, so a task sends one row per group at most.
    """
    first = F.row_number().over(Window.partitionBy(*by).orderBy(*order_by))
    return df.withColumn("__first", first).filter(F.col("__first") == 1).drop("__first")


def one_row_per_key(df: DataFrame, key: str, order_by: Sequence[Column]) -> DataFrame:
    """Deterministic duplicate removal on wide rows.

    Only the key column is shuffled to find the repeated keys.  While they are
    few, rows with a unique key pass through unmoved and the rest are reduced
    to the first row in ``order_by`` order.  Where many keys repeat, most rows
    would move anyway and all of them go through that reduction, in one shuffle.
    NULL is a key like any other.
    """
    repeated = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select("__key")
    repeated = materialize(repeated, "repeated-keys")
    if repeated.count() > MANY_KEYS:
        return first_per_group(df, [key], order_by)
    # The keys are stored, so their bytes decide whether they are sent to every task.
    same = df[key].eqNullSafe(repeated["__key"])
    unique = df.join(repeated, same, "left_anti")
    return unique.unionByName(first_per_group(df.join(repeated, same, "left_semi"), [key], order_by))


def collected(pairs: DataFrame, key: str, element: str, size: int = 1000) -> DataFrame:
    """Sorted lists of elements per key, the inverse of ``explode``.

    Long lists continue in further rows: ``chunk`` counts them from 0 and every
    list holds at most ``size`` elements, so no key makes one unbounded array.
    """
    numbered = ranked(pairs, partition_by=[key], order_by=[element], row_number="__rn")
    chunk = F.floor((F.col("__rn") - 1) / size).cast("int").alias("chunk")
    elements = F.transform(F.sort_array(F.collect_list(F.struct("__rn", element))), lambda e: e[element])
    return numbered.groupBy(key, chunk).agg(elements.alias("elements"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULLs per column, all in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Column defaults for missing values."""
    return df.na.fill(dict(defaults))


def duplicated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent and their number of rows.

    Keys are counted before the join, so a hot key is one row in it.
    """
    counted = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(F.count(F.lit(1)).alias("n"))
    parents = parent.select(F.col(parent_key).alias("__parent"))
    return counted.join(parents, F.col(child_key) == F.col("__parent"), "left_anti")
