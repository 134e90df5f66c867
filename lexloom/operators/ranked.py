"""Ordered window functions over groups of any size.

A window without PARTITION BY, or with a key that holds a third of all rows,
runs in one task.  ``ranked`` cuts the sort order into ranges first and
makes the range part of the window's partition key, so each task sorts one
range.  What a range cannot know, the rows before it, is a handful of numbers
per range: these are aggregated, accumulated and joined back by broadcast.

* The cut points come from a bounded, deterministic sample of the keys and
  are literals in the plan.  They decide only how even the ranges are, never
  the result, and a lost task recomputes exactly the same ranges.
* A value that fills several ranges on its own is cut out exactly before its
  first and after its last row, so ties are recognised across ranges.
* Only groups that a cut point falls into can span ranges.  The broadcast
  table holds just those: at most two rows per range, whatever the data size.
* Every range moves to one task: one shuffle of the rows, as for a plain window.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexloom.session import shuffle_width

RANGES_PER_TASK = 4  # several ranges per shuffle partition even out hashing
SAMPLES_PER_RANGE = 16
ROWS_PER_RANGE = 5_000_000  # at most about so many, however many rows there are
DIRECT_ROWS = 500_000  # groups up to this many rows are windowed in one task


@dataclass(frozen=True)
class Desc:
    """Marks a sort column as descending."""

    name: str


def _name(key: str | Desc) -> str:
    return key.name if isinstance(key, Desc) else key


def _sort(key: str | Desc) -> Column:
    return F.desc(key.name) if isinstance(key, Desc) else F.asc(key)


def _ascending_fields(schema: T.StructType, key: str | Desc) -> list[Column]:
    """Columns that sort ascending the way ``key`` sorts.

    Spark's order is kept: NULL first ascending and last descending, NaN above
    every number.
    """
    name, descending = _name(key), isinstance(key, Desc)
    kind, value = schema[name].dataType, F.col(_name(key))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        number = F.coalesce(F.nanvl(value.cast("double"), F.lit(0.0)), F.lit(0.0))
        low, high = (F.lit(2), F.lit(0)) if descending else (F.lit(0), F.lit(2))
        rank = F.when(value.isNull(), low).when(F.isnan(value), high).otherwise(F.lit(1))
        return [rank, -number if descending else number]
    if isinstance(kind, T.DateType):
        value = F.unix_date(value)
    elif isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    elif isinstance(kind, T.TimestampNTZType):
        value = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), value)
    elif isinstance(kind, T.BooleanType):
        value = value.cast("int")
    elif isinstance(kind, T.DecimalType):
        return [value.isNull().cast("int"), -value] if descending else [value]
    elif isinstance(kind, T.StringType):
        return [value.isNull().cast("int"), _reversed_text(value)] if descending else [value]
    elif isinstance(kind, T.BinaryType):
        return [value.isNull().cast("int"), _reversed_text(value)] if descending else [F.hex(value)]
    elif not isinstance(kind, T.IntegralType):
        raise ValueError(f"cannot range over {name!r} of type {kind.simpleString()}")
    return [value.isNull().cast("int"), F.bitwise_not(value)] if descending else [value]


def _reversed_text(value: Column) -> Column:
    """Text that sorts ascending where ``value`` sorts descending: its bytes complemented, and an end above all of them."""
    return F.concat(F.translate(F.hex(value), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


class _Ranges:
    """Cut points of one input and the expressions that use them.

    A cut is ``(group and order fields, side, tie fields)``; side -1 lies before
    all rows of that value, 1 after them, and 0 between them at the tie fields.
    """

    def __init__(
        self, df: DataFrame, rows: int, groups: Sequence[str], order: Sequence[str | Desc], ties: Sequence[str | Desc]
    ):
        def fields(keys: Sequence[str | Desc], prefix: str) -> dict[str, Column]:
            columns = [c for k in keys for c in _ascending_fields(df.schema, k)]
            return {f"__{prefix}{i}": c for i, c in enumerate(columns)}

        group, ordered, tie = fields(groups, "g"), fields(order, "o"), fields(ties, "t")
        self.columns = {**group, **ordered, **tie}
        self.group_names, self.order_names, self.tie_names = list(group), list(ordered), list(tie)
        self.cuts: list[tuple] = []
        self.runs: list[int] = [0]
        wanted = max(RANGES_PER_TASK * shuffle_width(df.sparkSession), -(-rows // ROWS_PER_RANGE))
        keys = df.select(*[c.alias(n) for n, c in self.columns.items()])
        # Keys whose hash lies below a threshold: an even sample that every run repeats, of this many
        # rows in all whatever the number of tasks.  Equal keys come as one row with their count.
        share = min(1.0, SAMPLES_PER_RANGE * wanted / max(1, rows))
        below = F.pmod(F.xxhash64(*keys.columns), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)))
        sample = keys.filter(below).groupBy(*keys.columns).agg(F.count(F.lit(1)).alias("__copies")).collect()
        by_key = sorted((tuple(r) for r in sample), key=lambda row: [(v is not None, v) for v in row[:-1]])
        ends = list(accumulate(row[-1] for row in by_key))
        picked = [bisect_right(ends, i * ends[-1] // wanted) for i in range(1, wanted)] if ends else []
        self._cut([by_key[p][:-1] for p in picked])

    def _cut(self, picked: list[tuple]) -> None:
        head = len(self.group_names) + len(self.order_names)
        rows_of: dict[tuple, dict[tuple, None]] = {}
        for row in picked:
            rows_of.setdefault(row[:head], {})[row[head:]] = None
        for value, ties in rows_of.items():
            start = len(self.cuts) + 1
            inside = [(*value, 0, *tie) for tie in list(ties)[1:]]
            after = [(*value, 1)] if inside else []  # the value fills more than one range
            self.cuts += [(*value, -1), *inside, *after]  # missing tie fields become NULL
            self.runs += [start] * (1 + len(inside)) + [start + 1 + len(inside)] * len(after)

    def assign(self, df: DataFrame) -> DataFrame:
        """Add ``__range``, the number of cut points at or below the row.

        A binary search over a literal array.  It is evaluated as a loop, so its
        cost per row is the logarithm of the number of cuts and the compiled
        code stays small however many there are.
        """
        keyed = df.withColumns(self.columns)
        head = [*self.group_names, *self.order_names]
        key = F.struct(*head, F.lit(0).alias("side"), *self.tie_names)
        fields = [*head, "side", *self.tie_names]
        cuts = json.dumps([dict(zip(fields, cut)) for cut in self.cuts], default=str)
        types = {f.name: f.dataType.simpleString() for f in keyed.schema.fields} | {"side": "int"}
        ordered = F.sort_array(
            F.from_json(F.lit(cuts), "array<struct<" + ",".join(f"{f}:{types[f]}" for f in fields) + ">>")
        )
        steps = [1 << power for power in reversed(range(len(self.cuts).bit_length()))]

        def search(row_key: Column) -> Column:
            def advance(position: Column, step: Column) -> Column:
                ahead = position + step
                return F.when(F.get(ordered, ahead - 1) <= row_key, ahead).otherwise(position)

            return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), advance)

        # transform() over the single key binds it once per row.
        return keyed.withColumn("__range", F.get(F.transform(F.array(key), search), 0))

    def spanning_only(self, keyed: DataFrame) -> DataFrame:
        """Rows of the groups that a cut point falls into, the only ones that can span ranges."""
        if not self.group_names:
            return keyed
        names = [f"c{name}" for name in self.group_names]
        groups = dict.fromkeys(cut[: len(names)] for cut in self.cuts)  # at most one per cut
        text = json.dumps([dict(zip(names, group)) for group in groups], default=str)
        types = ",".join(f"c{name}:{keyed.schema[name].dataType.simpleString()}" for name in self.group_names)
        literal = F.from_json(F.lit(text), f"array<struct<{types}>>")
        cut_groups = F.broadcast(keyed.sparkSession.range(1).select(F.inline(literal)))
        same = [keyed[name].eqNullSafe(cut_groups[f"c{name}"]) for name in self.group_names]
        return keyed.join(cut_groups, same, "left_semi")

    def run(self) -> Column:
        """First range of the run of equal values that ``__range`` belongs to."""
        return F.get(F.from_json(F.lit(json.dumps(self.runs)), "array<int>"), F.col("__range"))


def ranked(
    df: DataFrame,
    *,
    order_by: Sequence[str | Desc],
    tie_break: Sequence[str | Desc] = (),
    partition_by: Sequence[str] = (),
    row_number: str | None = None,
    rank: str | None = None,
    dense_rank: str | None = None,
    ntile: Mapping[str, int] | None = None,
    lag: Mapping[str, str] | None = None,
    lead: Mapping[str, str] | None = None,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Add ordered window columns to ``df``.

    ``row_number``, ``rank`` and ``dense_rank`` name their output column;
    ``ntile`` maps an output column to its number of tiles, ``lag`` and ``lead``
    map one to the column whose neighbour it takes.  ``rank`` and ``dense_rank``
    compare ``order_by`` only; everything else also uses ``tie_break``, which
    together with ``order_by`` must identify a row within its group.

    Group sizes are checked first, and a plain window is used when no group has
    more than ``direct_rows`` rows.  The input is read several times for that and
    for the ranges, so pass a stored table (for which a count only reads
    footers) rather than the output of a join.
    """
    ntile, lag, lead = ntile or {}, lag or {}, lead or {}
    added = [n for n in (row_number, rank, dense_rank, *ntile, *lag, *lead) if n]
    output = [*df.columns, *added]
    for key in (*partition_by, *order_by, *tie_break):
        _ascending_fields(df.schema, key)  # the same keys are refused at any size
    rows = df.count()
    large = _has_group_above(df, rows, partition_by, direct_rows)
    ranges = _Ranges(df, rows, partition_by, order_by, tie_break) if large else None
    split = ranges is not None and bool(ranges.cuts)

    frame = ranges.assign(df) if split else df
    group = [*partition_by, "__range"] if split else list(partition_by)
    exact = Window.partitionBy(*group).orderBy(*[_sort(k) for k in (*order_by, *tie_break)])
    peers = Window.partitionBy(*group).orderBy(*[_sort(k) for k in order_by])
    whole = Window.partitionBy(*group)

    local: dict[str, Column] = {"__rn": F.row_number().over(exact)}
    local |= {f"__lag_{name}": F.lag(column).over(exact) for name, column in lag.items()}
    local |= {f"__lead_{name}": F.lead(column).over(exact) for name, column in lead.items()}
    if lead or ntile:
        local["__n"] = F.count(F.lit(1)).over(whole)
    result = frame.drop(*ranges.columns).withColumns(local) if split else frame.withColumns(local)
    # Ranks only need the prefix of that sort, so they add no second one.
    by_peers = {name: f().over(peers) for name, wanted, f in (("__rank", rank, F.rank), ("__dense", dense_rank, F.dense_rank)) if wanted}
    result = result.withColumns(by_peers) if by_peers else result

    if split:
        # Proven size: at most two groups per range.
        before = _before_each_range(frame, ranges, partition_by, lag, lead, bool(dense_rank))
        matches = F.col("__range") == F.col("__b_range")
        for name in partition_by:
            matches &= F.col(name).eqNullSafe(F.col(f"__b_{name}"))
        result = result.join(F.broadcast(before), matches, "left")

    def shifted(column: str, by: str) -> Column:
        return F.col(column) + F.coalesce(F.col(by), F.lit(0)) if split else F.col(column)

    number = shifted("__rn", "__rows_before").cast("bigint")
    columns: dict[str, Column] = {}
    if row_number:
        columns[row_number] = number
    if rank:
        columns[rank] = shifted("__rank", "__rows_before_run").cast("bigint")
    if dense_rank:
        columns[dense_rank] = shifted("__dense", "__values_before").cast("bigint")
    for name, tiles in ntile.items():
        size = F.coalesce(F.col("__rows_in_group"), F.col("__n")) if split else F.col("__n")
        columns[name] = _tile(number, size, tiles)
    for name in lag:
        local_value = F.col(f"__lag_{name}")
        columns[name] = F.when(F.col("__rn") == 1, F.col(f"__last_{name}")).otherwise(local_value) if split else local_value
    for name in lead:
        local_value = F.col(f"__lead_{name}")
        at_end = F.col("__rn") == F.col("__n")
        columns[name] = F.when(at_end, F.col(f"__first_{name}")).otherwise(local_value) if split else local_value
    return result.withColumns(columns).select(*output)


def _has_group_above(df: DataFrame, total: int, partition_by: Sequence[str], rows: int) -> bool:
    if total <= rows or not partition_by:
        return total > rows
    sizes = df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("n"))
    return not sizes.filter(F.col("n") > rows).isEmpty()


def _before_each_range(
    frame: DataFrame,
    ranges: _Ranges,
    partition_by: Sequence[str],
    lag: Mapping[str, str],
    lead: Mapping[str, str],
    dense: bool,
) -> DataFrame:
    """What the groups that span ranges have before (and after) each range."""
    position = [F.col(n) for n in ranges.columns]
    aggregates = [F.count(F.lit(1)).alias("__rows")]
    if lag:
        last = F.struct(*position, *[F.col(c).alias(f"v{i}") for i, c in enumerate(lag.values())])
        aggregates.append(F.max(last).alias("__last"))
    if lead:
        first = F.struct(*position, *[F.col(c).alias(f"v{i}") for i, c in enumerate(lead.values())])
        aggregates.append(F.min(first).alias("__first"))
    if dense:
        aggregates.append(F.count_distinct(F.struct(*ranges.order_names)).alias("__values"))
    per_range = ranges.spanning_only(frame).groupBy(*partition_by, "__range").agg(*aggregates)
    per_range = per_range.withColumn("__run", ranges.run())

    in_order = Window.partitionBy(*partition_by).orderBy("__range")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    up_to_here = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_run = Window.partitionBy(*partition_by, "__run")
    columns = [
        F.col("__range").alias("__b_range"),
        *[F.col(name).alias(f"__b_{name}") for name in partition_by],
        F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows_before"),
        F.sum("__rows").over(Window.partitionBy(*partition_by)).alias("__rows_in_group"),
        F.col("__run"),
    ]
    columns += [F.lag(F.col("__last")[f"v{i}"]).over(in_order).alias(f"__last_{n}") for i, n in enumerate(lag)]
    columns += [F.lead(F.col("__first")[f"v{i}"]).over(in_order).alias(f"__first_{n}") for i, n in enumerate(lead)]
    if dense:
        # Ranges of one run share their only value: it counts once, at the run's first range.
        per_range = per_range.withColumns(
            {
                "__values": F.max("__values").over(in_run),
                "__new": F.row_number().over(in_run.orderBy("__range")) == 1,
            }
        )
        seen = F.sum(F.when(F.col("__new"), F.col("__values")).otherwise(F.lit(0))).over(up_to_here)
        columns.append((seen - F.col("__values")).alias("__values_before"))
    before = per_range.select(*columns)
    run_start = Window.partitionBy(*[f"__b_{name}" for name in partition_by], "__run")
    return before.withColumn("__rows_before_run", F.min("__rows_before").over(run_start)).drop("__run")


def _tile(number: Column, size: Column, tiles: int) -> Column:
    """NTILE from the row number: the first ``size % tiles`` tiles get one row more."""
    small = F.floor(size / tiles)
    large_rows = (size % tiles) * (small + 1)
    in_large = F.floor((number - 1) / (small + 1)) + 1
    in_small = (size % tiles) + F.floor((number - large_rows - 1) / F.greatest(small, F.lit(1))) + 1
    return F.when(number <= large_rows, in_large).otherwise(in_small).cast("int")
