"""Subject-day operators: the full grid, adherence, and what a cohort collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import MINUTES_PER_DAY, ValidDays
from pulsegrid.functions.clock import day_label
from pulsegrid.functions.ratio import share

# Days per block when a subject's days are generated or scanned. An ordinary subject is one
# block; one with very many days is spread over many tasks.
BLOCK_DAYS = 1024


def block_of(day: Column) -> Column:
    return F.floor(day / F.lit(BLOCK_DAYS)).cast("bigint")


def last_days(days: DataFrame) -> DataFrame:
    """subject_id, last_day. Rows without a subject or a day are left out."""
    return (
        days.where(F.col("subject_id").isNotNull() & F.col("day_index").isNotNull())
        .groupBy("subject_id")
        .agg(F.max("day_index").alias("last_day"))
    )


def day_grid(ends: DataFrame, day_start: int | Column = 0, day_end: int | None = None) -> DataFrame:
    """Every subject_id, day_index from day_start to day_end, else to the subject's last_day.

    Blocks of days are generated first and spread over all partitions, then the days of each
    block. No array grows with a subject's length, nor does one task generate a whole subject.
    """
    first = F.lit(day_start) if isinstance(day_start, int) else day_start
    last = F.col("last_day") if day_end is None else F.lit(day_end)
    spans = ends.select(
        "subject_id", first.cast("bigint").alias("first_day"), last.cast("bigint").alias("end_day")
    ).where(F.col("end_day") >= F.col("first_day"))
    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = spans.withColumn(
        "block", F.explode(F.sequence(block_of(F.col("first_day")), block_of(F.col("end_day"))))
    ).repartition(tasks, "subject_id", "block")
    low = F.greatest(F.col("first_day"), F.col("block") * BLOCK_DAYS)
    high = F.least(F.col("end_day"), F.col("block") * BLOCK_DAYS + (BLOCK_DAYS - 1))
    return blocks.select("subject_id", F.explode(F.sequence(low, high)).alias("day_index"))


def patient_days(recorded: DataFrame, day_start: int = 0, day_end: int | None = None) -> DataFrame:
    """The grid with the recorded minutes of each day, 0 on days without any.

    ``recorded`` is read twice: settle it first when it is costly.
    """
    grid = day_grid(last_days(recorded), day_start, day_end)
    return grid.join(recorded, ["subject_id", "day_index"], "left").select(
        "subject_id", "day_index", F.coalesce("recorded_minutes", F.lit(0)).cast("bigint").alias("recorded_minutes")
    )


def collected_totals(recorded: DataFrame, day_start: int = 0, day_end: int | None = None) -> DataFrame:
    """Totals over patient_days, without building it: each subject's days follow from its last."""
    day = F.col("day_index")
    inside = day >= day_start
    if day_end is not None:
        inside = inside & (day <= day_end)
    by_subject = recorded.groupBy("subject_id").agg(
        F.max("day_index").alias("last_day"),
        F.sum(F.when(inside, F.col("recorded_minutes"))).alias("recorded"),
    )
    last = F.col("last_day") if day_end is None else F.lit(day_end).cast("bigint")
    spans = by_subject.withColumn("days", F.greatest(last - day_start + 1, F.lit(0))).where("days > 0")
    zero = F.lit(0).cast("bigint")
    totals = spans.agg(
        F.count(F.lit(1)).alias("n_subjects"),
        F.coalesce(F.sum("days"), zero).alias("total_patient_days"),
        (F.coalesce(F.sum("days"), zero) * MINUTES_PER_DAY).alias("total_expected_minutes"),
        F.coalesce(F.sum("recorded"), zero).alias("total_recorded_minutes"),
    )
    return totals


def with_recording_ratio(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "recording_ratio", share(F.col("total_recorded_minutes"), F.col("total_expected_minutes"))
    )


def daily_adherence(observed: DataFrame, cfg: ValidDays) -> DataFrame:
    """Every day of every subject with its worn minutes and whether that is enough.

    Days without a row have a null date and 0 minutes. ``observed`` is read twice, or three
    times when days do not start at 0: settle it first when it is costly.
    """
    if cfg.start_at_zero:
        first: int | Column = 0
    else:
        first = observed.agg(F.min("day_index")).scalar()
    grid = day_grid(last_days(observed), first)
    worn = F.coalesce(F.col("worn_minutes"), F.lit(0)).cast("bigint")
    return (
        grid.join(observed, ["subject_id", "day_index"], "left")
        .select("subject_id", "day_index", "date", worn.alias("worn_minutes"))
        .withColumns(
            {
                "expected_minutes": F.lit(cfg.expected_minutes).cast("bigint"),
                "adherence_ratio": F.col("worn_minutes") / F.lit(float(cfg.expected_minutes)),
                "is_valid_day": F.col("worn_minutes") >= F.lit(cfg.threshold),
            }
        )
    )


def valid_day_totals(daily: DataFrame, cfg: ValidDays) -> DataFrame:
    by_subject = daily.groupBy("subject_id").agg(
        F.count(F.lit(1)).alias("days"), F.count_if("is_valid_day").alias("valid")
    )
    zero = F.lit(0).cast("bigint")
    return by_subject.agg(
        F.count("subject_id").alias("n_subjects"),
        F.coalesce(F.sum("days"), zero).alias("total_patient_days"),
        F.coalesce(F.sum("valid"), zero).alias("total_valid_days"),
    ).select(
        "*",
        share(F.col("total_valid_days"), F.col("total_patient_days")).alias("valid_day_ratio"),
        F.lit(cfg.threshold).cast("bigint").alias("threshold_minutes"),
        F.lit(float(cfg.threshold_ratio)).alias("threshold_ratio"),
    )


def daily_compliance(observed: DataFrame, expected_minutes: int = MINUTES_PER_DAY) -> DataFrame:
    """Every day from 0 to the subject's last with its share of worn minutes."""
    grid = day_grid(last_days(observed))
    worn = F.coalesce(F.col("worn_minutes"), F.lit(0)).cast("bigint")
    return (
        grid.join(observed.select("subject_id", "day_index", "worn_minutes"), ["subject_id", "day_index"], "left")
        .select("subject_id", "day_index", day_label(F.col("day_index")).alias("date"), worn.alias("worn_minutes"))
        .withColumn("compliance", F.col("worn_minutes") / F.lit(float(expected_minutes)))
    )
