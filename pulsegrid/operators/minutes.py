"""Operators on minute rows: filters, dedup, outliers and their counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import DEDUP_KEY, MAX_HR, MIN_HR
from pulsegrid.functions.clock import day_index, is_day, is_time
from pulsegrid.functions.heart_rate import has_reading, is_outlier, is_worn, too_high, too_low
from pulsegrid.operators import packed
from pulsegrid.sources.tables import SRC_ORDER, as_digits, as_number, require_columns

COPIES = "copies"
UNRECORDED = "unrecorded"


def timed_rows(minutes: DataFrame, short: bool = False) -> DataFrame:
    """Rows with a valid day and a valid time, whatever the heart rate."""
    return minutes.where(is_day(F.col("date")) & is_time(F.col("time"), short))


def recorded_rows(minutes: DataFrame, short: bool = False) -> DataFrame:
    """Timed rows with a reading other than 0."""
    return timed_rows(minutes, short).where(has_reading(as_number(minutes, "hr")))


def worn_rows(minutes: DataFrame, short: bool = False) -> DataFrame:
    """Timed rows with a reading above 0."""
    return timed_rows(minutes, short).where(is_worn(as_number(minutes, "hr")))


def keep_one(
    rows: DataFrame, key: Sequence[str] = DEDUP_KEY, keep: str = "last", order: str = SRC_ORDER
) -> DataFrame:
    """One row per key, the first or last in ``order``, plus how many rows the key had.

    An aggregate rather than a ranking window: each task folds its own copies of a key to one
    row before the shuffle, so a key with a third of all rows still sends one row per task.
    The readings' texts make it a sort aggregate. A hash aggregate that carries them as numbers
    was tried and took longer. Null keys are equal to each other.
    """
    require_columns(rows, [*key, order], "rows to deduplicate")
    rest = [name for name in rows.columns if name not in key and name != order]
    pick = F.max if keep == "last" else F.min
    kept = rows.groupBy(*key).agg(
        pick(F.struct(order, *rest)).alias("_kept"),
        F.count(F.lit(1)).alias(COPIES),
    )
    names = [F.col(c) if c in key else F.col(f"_kept.{c}").alias(c) for c in rows.columns]
    return kept.select(*names, COPIES)


def keep_one_marked(
    minutes: DataFrame, key: Sequence[str] = DEDUP_KEY, keep: str = "last", short: bool = True
) -> DataFrame:
    """keep_one of the recorded rows, and in the same pass a marker row for each subject with other rows.

    A marker has ``unrecorded`` set, its number of rows in ``copies`` and nothing else but the subject.
    Each task folds a subject's other rows to one before the shuffle, so markers cost next to
    nothing, and who is only ever seen without a reading needs no second scan.

    Raw minutes with the usual key are moved packed, a subject-day to a row, and then come sorted by subject, day and time
    with those of a subject-day in one task. Other columns, types or keys go through keep_one.
    """
    require_columns(minutes.select(*key), ["subject_id", "date"], "dedup key")
    recorded = is_day(F.col("date")) & is_time(F.col("time"), short) & has_reading(as_number(minutes, "hr"))
    cells = [F.when(recorded, F.col(c)).alias(c) if c in key and c != "subject_id" else F.col(c) for c in minutes.columns]
    if packed.can_pack(minutes, key):
        blank = lambda c: F.when(recorded, F.col(c)).alias(c)
        rows = minutes.select(*[F.col(c) if c == "subject_id" else blank(c) for c in minutes.columns])
        return packed.keep_one(rows, keep).select(*minutes.columns, COPIES, UNRECORDED)
    kept = keep_one(minutes.select(*cells), key, keep)
    marker = F.col("date").isNull()  # a recorded row has a date
    empty = lambda c: c in ("subject_id", COPIES, *key)
    return kept.select(*[F.col(c) if empty(c) else F.when(~marker, F.col(c)).alias(c) for c in kept.columns], marker.alias(UNRECORDED))


def kept_by_day(deduped: DataFrame) -> DataFrame:
    """subject_id, day_index with the rows kept and removed, from the result of keep_one."""
    by_label = deduped.groupBy("subject_id", "date").agg(
        F.count(F.lit(1)).alias("kept"), F.sum(F.col(COPIES) - 1).alias("removed")
    )
    return by_label.groupBy("subject_id", day_index(F.col("date")).alias("day_index")).agg(
        F.sum("kept").alias("kept"), F.sum("removed").alias("removed")
    )


def duplicate_counts(by_day: DataFrame) -> DataFrame:
    """Rows kept, rows removed and days without a record, from kept_by_day.

    The days of the full grid are counted, not built: a subject whose last day is m adds m + 1.
    Days before 0 and days without a subject count only on the side of the recorded days.
    """
    by_subject = by_day.groupBy("subject_id").agg(
        F.max("day_index").alias("last_day"),
        F.count(F.lit(1)).alias("days"),
        F.sum("kept").alias("kept"),
        F.sum("removed").alias("removed"),
    )
    grid_days = F.when(F.col("subject_id").isNotNull(), F.greatest(F.col("last_day") + 1, F.lit(0)))
    zero = F.lit(0).cast("bigint")
    return by_subject.agg(
        F.coalesce(F.sum("kept"), zero).alias("filtered_rows"),
        F.coalesce(F.sum("removed"), zero).alias("removed_duplicates_rows"),
        (F.coalesce(F.sum(grid_days), zero) - F.coalesce(F.sum("days"), zero)).alias("non_wear_days"),
    )


def with_outlier_flags(minutes: DataFrame, min_hr: float = MIN_HR, max_hr: float = MAX_HR) -> DataFrame:
    """Adds hr_num and the three flags, which are null where the heart rate is."""
    hr = F.col("hr_num")
    return minutes.withColumn("hr_num", as_number(minutes, "hr")).withColumns(
        {
            "is_too_low": too_low(hr, min_hr),
            "is_too_high": too_high(hr, max_hr),
            "is_outlier": is_outlier(hr, min_hr, max_hr),
        }
    )


def with_parsed(minutes: DataFrame) -> tuple[DataFrame, str]:
    """The minutes with their reading as a number, and the name of that new column."""
    parsed, digits = (_free(f"_{name}", minutes.columns) for name in ("hr_num", "hr_digits"))
    rows = minutes.withColumn(digits, as_digits(minutes, "hr"))
    return rows.withColumn(parsed, as_number(rows, "hr", digits)).drop(digits), parsed


def _free(name: str, taken: Sequence[str]) -> str:
    return name if name not in taken else _free(f"_{name}", taken)


def clean_outliers(
    minutes: DataFrame, min_hr: float = MIN_HR, max_hr: float = MAX_HR, mode: str = "replace_zero", parsed: str | None = None
) -> DataFrame:
    """Zeroes the implausible readings, or drops them together with the rows without a reading.

    ``parsed`` names a column that holds the reading as a number already. Without it, each reading is
    parsed once, for both bounds.
    """
    if parsed is None:
        rows, parsed = with_parsed(minutes)
        return clean_outliers(rows, min_hr, max_hr, mode, parsed).drop(parsed)
    outside = is_outlier(as_number(minutes, parsed), min_hr, max_hr)
    if mode == "drop":
        return minutes.where(~outside)
    zero = F.lit("0").cast(minutes.schema["hr"].dataType)
    return minutes.withColumn("hr", F.when(outside, zero).otherwise(F.col("hr")))


def outlier_totals(
    minutes: DataFrame, min_hr: float = MIN_HR, max_hr: float = MAX_HR, parsed: str = "hr"
) -> list[Column]:
    """The four counts as aggregates over the minutes."""
    hr = as_number(minutes, parsed)
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(is_outlier(hr, min_hr, max_hr)).alias("outliers_detected"),
        F.count_if(too_low(hr, min_hr)).alias("outliers_too_low"),
        F.count_if(too_high(hr, max_hr)).alias("outliers_too_high"),
    ]


def outlier_counts(minutes: DataFrame, min_hr: float = MIN_HR, max_hr: float = MAX_HR) -> DataFrame:
    return minutes.agg(*outlier_totals(minutes, min_hr, max_hr))
