"""Day tables used as lists of subject-days."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pulsegrid.sources.tables import as_day, as_flag, require_columns


def valid_day_keys(daily: DataFrame, filter_valid_days: bool = True) -> DataFrame:
    """subject_id, day_index, date of each (valid) row; repeated rows stay repeated."""
    needed = ["subject_id", "day_index", "date"] + (["is_valid_day"] if filter_valid_days else [])
    require_columns(daily, needed, "day table")
    kept = daily.where(as_flag(daily)) if filter_valid_days else daily
    return kept.select("subject_id", as_day(daily).alias("day_index"), "date")


def metric_keys(daily: DataFrame, filter_valid_days: bool = True) -> DataFrame:
    """Distinct subject_id, date. The filter applies only when the table has the flag."""
    require_columns(daily, ["subject_id", "date"], "key table")
    kept = daily.where(as_flag(daily)) if filter_valid_days and "is_valid_day" in daily.columns else daily
    return kept.select("subject_id", "date").distinct()
