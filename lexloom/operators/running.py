"""Running aggregates over any number of rows, as a window with its default frame gives them.

A window without a partition key runs in one task.  Rows with equal keys are peers
and share one value, so the rows are first aggregated per key (map-side, so a
key that holds a third of them is one row).  The keys are put in ranges and stored; each
range is accumulated by itself, and what lies before a range is one row per range,
carried over on the driver.  The results are joined back to the rows by their key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexloom.session import shuffle_width
from lexloom.sources.scratch import materialize

#: How the values of a key, of a range and of all ranges before are put together.
_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_CARRY = {
    "sum": lambda a, b: b if a is None else a if b is None else a + b,
    "count": lambda a, b: (a or 0) + b,
    "min": lambda a, b: b if a is None else a if b is None else min(a, b),
    "max": lambda a, b: b if a is None else a if b is None else max(a, b),
}
_JOINED = {
    "sum": lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b),
    "count": lambda a, b: F.coalesce(a, F.lit(0)) + b,
    "min": F.least,
    "max": F.greatest,
}


def running(
    df: DataFrame, order_by: Sequence[str], values: Mapping[str, tuple[str, str | Column]], partition_by: Sequence[str] = ()
) -> DataFrame:
    """Add running aggregates in ascending order of ``order_by``, within ``partition_by``.

    ``values`` maps an output column to (``sum``, ``count``, ``min`` or ``max``; what it is taken of).
    NULL keys come first and are peers; NULL values are left out, and an aggregate
    of none is NULL (0 for a count).
    """
    if not order_by:
        raise ValueError("order_by must name a column")
    unknown = {kind for kind, _ in values.values()} - _MERGE.keys()
    if unknown:
        raise ValueError(f"no running {sorted(unknown)}")
    groups = {f"__g{i}": c for i, c in enumerate(partition_by)}
    order = {f"__o{i}": c for i, c in enumerate(order_by)}
    keys = {**groups, **order}
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    per_key = df.groupBy(*[F.col(f"`{c}`").alias(k) for k, c in keys.items()]).agg(
        *[first[kind](F.col(of) if isinstance(of, str) else of).alias(f"__v{i}") for i, (kind, of) in enumerate(values.values())]
    )
    kinds = {f"__v{i}": kind for i, (kind, _) in enumerate(values.values())}
    ranged = per_key.repartitionByRange(shuffle_width(df.sparkSession), *keys).withColumn("__range", F.spark_partition_id())
    # Stored: a range is what was written, whatever is computed again.
    ranged = materialize(ranged, "running-keys")
    within = Window.partitionBy("__range", *groups).orderBy(*order)
    local = ranged.withColumns({f"__r{v[3:]}": _MERGE[kind](v).over(within) for v, kind in kinds.items()})
    before = _before(ranged, list(groups), kinds)
    if before is not None:
        same = F.col("__range") == F.col("__b_range")
        for g in groups:
            same &= F.col(g).eqNullSafe(F.col(f"__b{g}"))
        # At most one row per range: a group that goes on in a range is its first.
        local = local.join(F.broadcast(before), same, "left")
        local = local.withColumns({f"__r{v[3:]}": _JOINED[kind](F.col(f"__b{v}"), F.col(f"__r{v[3:]}")) for v, kind in kinds.items()})
    totals = local.select(*[F.col(k).alias(f"{k}_") for k in keys], *[F.col(f"__r{i}").alias(name) for i, name in enumerate(values)])
    totals = materialize(totals, "running-totals")  # their size decides how they meet the rows
    matches = [df[c].eqNullSafe(totals[f"{k}_"]) for k, c in keys.items()]
    return df.join(totals, matches, "left").select(*[df[c] for c in df.columns], *values)


def _before(ranged: DataFrame, groups: list[str], kinds: dict[str, str]) -> DataFrame | None:
    """What the groups that go on from one range into the next have before each range."""
    parts = ranged.groupBy(*groups, "__range").agg(*[_MERGE[kind](v).alias(v) for v, kind in kinds.items()])
    if groups:
        ends = parts.groupBy(*groups).agg(F.min("__range").alias("__low"), F.max("__range").alias("__high"))
        ends = ends.filter("__low < __high").withColumnsRenamed({g: f"{g}_" for g in groups})
        same = [F.col(g).eqNullSafe(F.col(f"{g}_")) for g in groups]
        parts = parts.join(ends, same).select(*parts.columns)
    # Ranges are contiguous, so at most two such groups lie in one: a bounded number of rows.
    found = parts.collect()
    carried, rows = {}, []
    for row in sorted(found, key=lambda r: r["__range"]):
        group = tuple(row[g] for g in groups)
        if group in carried:
            rows.append((row["__range"], *group, *carried[group]))
        held = carried.get(group, (None,) * len(kinds))
        carried[group] = tuple(_CARRY[kind](a, row[v]) for a, (v, kind) in zip(held, kinds.items()))
    if not rows:
        return None
    types = {f.name: f.dataType.simpleString() for f in parts.schema.fields}
    columns = ["__b_range int", *[f"__b{c} {types[c]}" for c in (*groups, *kinds)]]
    return ranged.sparkSession.createDataFrame(rows, ", ".join(columns))
