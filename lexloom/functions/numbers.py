"""Sums, means and shares in the measure's own type, and the rounding of the reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(column: Column | str, digits: int | None = None) -> Column:
    """Sum in the type of the amounts; rounded, if at all, after all of them are in it."""
    summed = F.sum(column)
    return summed if digits is None else F.round(summed, digits)


def mean(column: Column | str) -> Column:
    """Sum divided by the number of values."""
    return F.avg(column)


def as_whole(column: Column) -> Column:
    """Nearest integer, halves away from zero (a bare cast would truncate)."""
    return F.round(column).cast("int")


def percent_of(part: Column, whole: Column, digits: int) -> Column:
    return F.round(F.lit(100.0) * part / whole, digits)
