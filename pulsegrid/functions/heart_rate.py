"""Column expressions on a numeric heart rate. Null in gives null, or false where noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_reading(hr: Column) -> Column:
    """True for any reading but 0; false for null."""
    return F.coalesce(hr != 0, F.lit(False))


def is_worn(hr: Column) -> Column:
    """A reading above 0. Null stays null, so a filter drops it."""
    return hr > 0


def too_low(hr: Column, min_hr: float) -> Column:
    return hr < F.lit(float(min_hr))


def too_high(hr: Column, max_hr: float) -> Column:
    return hr > F.lit(float(max_hr))


def is_outlier(hr: Column, min_hr: float, max_hr: float) -> Column:
    return too_low(hr, min_hr) | too_high(hr, max_hr)
