"""Exact quantiles by distributed selection.

Sorting everything to find a few ranks moves all rows.  Here a bounded sketch
proposes cut points, one pass counts the rows in each range, and only the range that
holds the rank is looked into, in the same way, until all of its values are equal
or they are few.  No pass moves more than one row per range and task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A range of so many rows is brought to the driver.
FEW_ROWS = 10_000
#: Error of the sketch as a share of the rows; its size does not depend on them.
SKETCH_ERROR = 0.001
_RANGES = 100


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> dict[float, object]:
    """The least value that at least each share of the values does not exceed (``percentile_disc``).

    NULL and NaN are no values; without any, every quantile is None.  Numbers of any kind.
    """
    if any(not 0 <= share <= 1 for share in shares):
        raise ValueError("shares lie between 0 and 1")
    kind = df.schema[column].dataType
    if not isinstance(kind, T.NumericType):
        raise ValueError(f"{column!r} is no number")
    values = df.select(F.col(f"`{column}`").alias("v")).filter("v IS NOT NULL")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        values = values.filter(~F.isnan("v"))
    n, low, high = values.agg(F.count("v"), F.min("v"), F.max("v")).first()
    # Rounded first, so that 0.1 of 30 values is the third.
    ranks = {share: max(1, ceil(round(share * n, 9))) for share in shares}
    return {share: _select(values, kind, rank, n, low, high) if n else None for share, rank in ranks.items()}


def _select(values: DataFrame, kind: T.DataType, rank: int, n: int, low, high):
    """The value at a rank, counted from 1, of n values between low and high."""
    while n > FEW_ROWS and low < high:
        place = _distance(kind, low)
        sketch = values.select(place.alias("d")).approxQuantile("d", [k / _RANGES for k in range(_RANGES)], SKETCH_ERROR)
        # The least value is a cut, so a range always loses some of its rows.
        cuts = sorted({float(low) if isinstance(kind, (T.FloatType, T.DoubleType)) else 0.0, *sketch})
        ranges = F.array_size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < place))
        counted = values.groupBy(ranges.alias("range")).agg(F.count("v").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for row in sorted(counted.collect(), key=lambda r: r.range):
            if row.n >= rank:
                break
            rank -= row.n
        values = values.filter(F.col("v").between(F.lit(row.low), F.lit(row.high)))
        n, low, high = row.n, row.low, row.high
    if low == high:
        return low
    return sorted(r.v for r in values.collect())[rank - 1]


def _distance(kind: T.DataType, low) -> Column:
    """A double in the order of the values: how far they lie above the least, the finer the closer the range."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.col("v").cast("double")
    exact = T.DecimalType(38, kind.scale if isinstance(kind, T.DecimalType) else 0)
    return (F.col("v").cast(exact) - F.lit(low).cast(exact)).cast("double")


def summary(df: DataFrame, columns: Sequence[str], shares: Mapping[str, float] | None = None) -> DataFrame:
    """One row per column: values, missing ones, least, mean, greatest, and exact quantiles by name."""
    shares = shares or {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    rows = []
    for column in columns:
        value = F.col(column)
        found = df.agg(F.count(value), F.count_if(value.isNull()), F.min(value), F.avg(value), F.max(value)).first()
        quantiles = exact_quantiles(df, column, list(shares.values()))
        numbers = [None if v is None else float(v) for v in (*found[2:], *(quantiles[s] for s in shares.values()))]
        rows.append((column, found[0], found[1], *numbers))
    names = ["column STRING", "n LONG", "missing LONG", "least DOUBLE", "mean DOUBLE", "greatest DOUBLE", *[f"{name} DOUBLE" for name in shares]]
    return df.sparkSession.createDataFrame(rows, ", ".join(names))
