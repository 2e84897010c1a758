"""Ratios that survive an empty denominator, and the rounding of reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share(part: Column, total: Column) -> Column:
    """part / total, 0 when total is 0 or null."""
    return F.coalesce(F.try_divide(part.cast("double"), total.cast("double")), F.lit(0.0))


def percent(part: Column, total: Column) -> Column:
    return share(part, total) * F.lit(100.0)


def one_decimal(value: Column) -> Column:
    """One decimal, ties to the even digit."""
    return F.rint(value * F.lit(10.0)) / F.lit(10.0)
