"""Date predicates and the generated calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_years(column: Column | str, first: int, last: int) -> Column:
    """``year(column) BETWEEN first AND last`` as a range that reaches the scan."""
    column = F.col(column) if isinstance(column, str) else column
    return (column >= F.lit(f"{first}-01-01").cast("timestamp_ntz")) & (
        column < F.lit(f"{last + 1}-01-01").cast("timestamp_ntz")
    )


def calendar(bounds: DataFrame) -> DataFrame:
    """The date dimension: one row per day from ``first_day`` to ``last_day``.

    ``bounds`` is a one-row frame with those two date columns.  Names are
    unpadded; days of the week count from Monday = 1.
    """
    days = bounds.select(F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    day = F.col("full_date")
    iso_day = F.weekday(day) + 1
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        iso_day.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )
