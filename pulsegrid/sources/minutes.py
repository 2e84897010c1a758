"""The minute table and its derived columns."""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import MINUTE_COLUMNS
from pulsegrid.functions.clock import day_index, full_time, minute_of_day
from pulsegrid.functions.heart_rate import has_reading, is_worn
from pulsegrid.sources.tables import as_number, read_table, require_columns


def read_minutes(
    spark: SparkSession, path: str | PurePath, fmt: str = "csv", ordered: bool = True, layout: str = "scan"
) -> DataFrame:
    return read_table(spark, path, fmt, MINUTE_COLUMNS, ordered, layout)


def with_full_time(minutes: DataFrame, normalize: bool = True) -> DataFrame:
    return minutes.withColumn("time", full_time(F.col("time"))) if normalize else minutes


def parse_minutes(minutes: DataFrame) -> DataFrame:
    """Adds the numeric day, minute and heart rate, and whether each row is usable."""
    require_columns(minutes, MINUTE_COLUMNS, "minute table")
    return minutes.withColumns(
        {
            "time": full_time(F.col("time")),
            "day_index": day_index(F.col("date")),
            "minute_of_day": minute_of_day(F.col("time"), short=True),
            "hr_num": as_number(minutes, "hr"),
        }
    ).withColumns(
        {
            "ok_datetime": F.col("day_index").isNotNull() & F.col("minute_of_day").isNotNull(),
            "ok_hr_validminute": has_reading(F.col("hr_num")),
        }
    )


def worn_readings(minutes: DataFrame) -> DataFrame:
    """Readings above 0 on a valid day. The time of day is not looked at."""
    require_columns(minutes, MINUTE_COLUMNS, "minute table")
    return (
        minutes.select("subject_id", day_index(F.col("date")).alias("day_index"), as_number(minutes, "hr").alias("hr_num"))
        .where(F.col("day_index").isNotNull() & is_worn(F.col("hr_num")))
    )
