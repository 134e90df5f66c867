"""Change over time, on counts that are already aggregated per period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def compare_periods(
    counts: DataFrame, group: str, year: str, count: str, early: tuple[int, int], recent: tuple[int, int]
) -> DataFrame:
    """Counts of two periods per group, their difference and its direction."""

    def within(period: tuple[int, int]) -> Column:
        return F.sum(F.when(F.col(year).between(*period), F.col(count)).otherwise(F.lit(0)))

    compared = counts.groupBy(group).agg(within(early).alias("early"), within(recent).alias("recent"))
    direction = F.signum(F.col("recent") - F.col("early"))
    trend = F.when(direction > 0, "accelerating").when(direction == 0, "stable").otherwise("slowing")
    return compared.withColumns({"change": F.col("recent") - F.col("early"), "trend": trend})


def with_previous(counts: DataFrame, period: str, count: str) -> DataFrame:
    """Add the previous period's count, the change, and the running total.

    ``counts`` has one row per calendar period, so one task orders it easily.
    """
    by_period = Window.orderBy(period)
    previous = F.lag(count).over(by_period)
    return counts.withColumns(
        {"previous": previous, "change": F.col(count) - previous, "running_total": F.sum(count).over(by_period)}
    )
