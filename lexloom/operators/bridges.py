"""Many-to-many joins without the fan-out error.

A bridge has one row per (document, topic).  Joining a fact to it repeats the
fact's measures, so a measure is either summed before the join or divided by
the number of links.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.session import shuffle_width

# Dimensions up to this size are attached to every fact row as an array.
ARRAY_DIMENSION_ROWS = 1_000
# Join keys per task of a shuffle, to even out hashing.
SALTED_TASKS = 4


def bridge(links: DataFrame, left: str, right: str) -> DataFrame:
    """Distinct pairs; pairs with a missing side are no link."""
    return links.select(left, right).filter(F.col(left).isNotNull() & F.col(right).isNotNull()).distinct()


def links_per(pairs: DataFrame, key: str, name: str = "links") -> DataFrame:
    """Number of links of each key."""
    return pairs.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def share_per_link(fact: DataFrame, pairs: DataFrame, key: str, measure: str) -> DataFrame:
    """Facts that have links, with ``links`` and the ``share`` of the measure each link gets."""
    linked = fact.select(key, measure).join(links_per(pairs, key), key)
    return linked.withColumn("share", F.col(measure) / F.col("links"))


def attributed(fact: DataFrame, pairs: DataFrame, key: str, topic: str, measure: str) -> DataFrame:
    """Measure attributed to each topic key: every link carries an equal share.

    Measures are summed in their own type per topic and number of links and divided
    once per such group, so shares lose nothing on the way.  Summed per topic key
    here, so a later join with the topic dimension sees one row per topic whatever
    its number of links.
    """
    linked = share_per_link(fact, pairs, key, measure).select(key, measure, "links")
    sums = pairs.join(linked, key).groupBy(topic, "links").agg(F.sum(measure).alias("whole"))
    return sums.groupBy(topic).agg(F.sum(F.col("whole").cast("double") / F.col("links")).alias("attributed"))


def left_counts(fact: DataFrame, pairs: DataFrame, key: str, name: str) -> DataFrame:
    """Every fact with its number of links, 0 where there is none."""
    joined = fact.join(links_per(pairs, key, name), key, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))


def full_outer(fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str) -> DataFrame:
    """Full outer join of a fact with a dimension whose key is unique.

    A left join plus the dimension rows no fact refers to: unlike a full outer
    join, both can be split where one key holds many facts.
    """
    left = fact.join(dimension, fact[fact_key] == dimension[dimension_key], "left")
    used = fact.select(F.col(fact_key).alias("__used")).distinct()
    unused = dimension.join(used, dimension[dimension_key] == used["__used"], "left_anti")
    return left.unionByName(unused, allowMissingColumns=True)


def pair_with_all(
    fact: DataFrame, dimension: DataFrame, key: str, applies: Column | None = None, carry: Sequence[str] = ()
) -> DataFrame:
    """Pair every fact row with every row of a small dimension where ``applies`` holds.

    The pairs have the fact's columns, ``key`` and the dimension's ``carry``
    columns; ``applies`` may use all of these.  A NULL key is a row like any other,
    and a NULL condition does not hold.  Several rules over the same two tables are
    one condition here, so the fact is read once.  A dimension within the size
    check travels as one array that is exploded per row; a larger one is matched
    through hash buckets instead, never as a whole.
    """
    slim = dimension.select(key, *carry)
    rows = slim.limit(ARRAY_DIMENSION_ROWS + 1).count()
    if rows <= ARRAY_DIMENSION_ROWS:
        whole = slim.agg(F.sort_array(F.collect_list(F.struct(*slim.columns)))).scalar()
        paired = fact.withColumn("__row", F.explode(whole))
        pairs = paired.select(*fact.columns, *[F.col("__row")[c].alias(c) for c in slim.columns])
    else:
        buckets = slim.count() // ARRAY_DIMENSION_ROWS + 1
        # Few buckets would be few join keys with all facts each: a salt from the fact's hash deals them out,
        # and the dimension is repeated once per salt.
        salts = max(1, SALTED_TASKS * shuffle_width(fact.sparkSession) // buckets)
        numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1).cast("int")))
        keyed = slim.withColumn("__bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).withColumn("__salt", numbers(salts))
        repeated = fact.withColumn("__salt", F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")).withColumn("__bucket", numbers(buckets))
        pairs = repeated.join(keyed, ["__bucket", "__salt"]).drop("__bucket", "__salt")
    return pairs if applies is None else pairs.filter(applies)


def star(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Join a fact with its dimensions, each given with its fact key and its own key.

    Without hints: Catalyst broadcasts what it knows to be small and adaptive
    execution corrects the choice at run time.
    """
    for dimension, fact_key, dimension_key in dimensions:
        fact = fact.join(dimension, F.col(fact_key) == F.col(dimension_key))
    return fact
