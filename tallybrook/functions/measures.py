"""Measures the business queries share."""

from __future__ import annotations

from pyspark.sql import Column as C
from pyspark.sql import functions as F


def line_value() -> C:
    return F.col("quantity") * F.col("unit_price")


def percentage(part: C, whole: C) -> C:
    """``part`` in percent of ``whole``, two decimals, NULL for an empty whole."""
    return F.round(F.lit(100.0).cast("decimal(4,1)") * part / F.nullif(whole, F.lit(0)), 2)


def money_average(total: C, count: C) -> C:
    """Mean of money, rounded half up to cents.

    The quotient has 16 decimals: with the six that ``avg`` keeps, a mean just below half
    a cent would be rounded up twice.
    """
    return F.round(total.cast("decimal(24,2)") / F.nullif(count, F.lit(0)).cast("decimal(14,0)"), 2)


def distinct_count(column: str, approximate: bool = False) -> C:
    return F.approx_count_distinct(column) if approximate else F.count_distinct(column)


def latest_marker() -> C:
    """Order of two changes of one key: source position, then place in its message."""
    return F.struct("_version", "_seq")
