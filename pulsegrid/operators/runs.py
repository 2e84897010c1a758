"""Longest run of consecutive valid days, and the participants it selects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.config import ValidParticipants
from pulsegrid.functions.ratio import percent
from pulsegrid.operators.days import BLOCK_DAYS, block_of
from pulsegrid.sources.tables import as_day, as_flag, require_columns

# A subject's days are spread over this many tasks when they meet the list of subjects.
_SALTS = 32


def typed_days(daily: DataFrame) -> DataFrame:
    """The day table with a numeric day and a boolean flag, other columns as they are."""
    require_columns(daily, ["subject_id", "day_index", "is_valid_day"], "day table")
    return daily.withColumns({"day_index": as_day(daily), "is_valid_day": as_flag(daily)})


def in_day_range(daily: DataFrame, day_start: int | None = None, day_end: int | None = None) -> DataFrame:
    if day_start is not None:
        daily = daily.where(F.col("day_index") >= day_start)
    if day_end is not None:
        daily = daily.where(F.col("day_index") <= day_end)
    return daily


def longest_runs(daily: DataFrame) -> DataFrame:
    """subject_id, max_run_len, best_run_start_day, best_run_end_day; one row per subject.

    A day listed twice ends a run. Of equally long runs the earliest counts. A subject
    without a valid day has length 0 and null days.

    Runs are found within blocks of days, so that no task sorts a whole subject. Only runs
    that touch a block's edge are then sorted together per subject, to be joined to the
    run on the other side. The others keep to their block. All invalid days of a subject
    ride along as one row without a day, so the table is read once, and a day listed more
    than twice is folded to two, which end a run just as well.
    """
    day = F.col("day")
    valid_day = F.when(F.col("is_valid_day"), F.col("day_index"))
    days = (
        daily.where(F.col("subject_id").isNotNull())
        .select("subject_id", valid_day.alias("day"))
        .groupBy("subject_id", "day")
        .agg(F.least(F.count(F.lit(1)), F.lit(2)).alias("copies"))
        .select("subject_id", "day", block_of(day).alias("block"), F.explode(F.sequence(F.lit(1), "copies")))
    )
    within = Window.partitionBy("subject_id", "block").orderBy("day")
    pieces = (
        days.withColumn("starts", F.when(day == F.lag("day").over(within) + 1, 0).otherwise(1))
        .withColumn("piece", F.sum("starts").over(within.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("subject_id", "block", "piece")
        .agg(F.min("day").alias("first"), F.max("day").alias("last"), F.count("day").alias("n"))
    )
    first_of_block = F.col("block") * BLOCK_DAYS
    at_edge = (F.col("first") == first_of_block) | (F.col("last") == first_of_block + (BLOCK_DAYS - 1))
    # Null stands for the edge pieces of a subject, a block number for pieces inside it.
    # Only a piece that starts its block may go on from the one before, which then ends the
    # block before it: pieces inside a block are separate runs already.
    across = Window.partitionBy("subject_id", "home").orderBy("block", "piece")
    goes_on = (F.col("first") == first_of_block) & (F.col("first") == F.lag("last").over(across) + 1)
    runs = (
        pieces.withColumn("home", F.when(~at_edge, F.col("block")))
        .withColumn("starts", F.when(goes_on, 0).otherwise(1))
        .withColumn("run", F.sum("starts").over(across.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("subject_id", "home", "run")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    )
    best = runs.groupBy("subject_id").agg(
        F.max(F.struct("n", (-F.col("first")).alias("earliness"), "last")).alias("best")
    )
    found = F.col("best.n") > 0
    return best.select(
        "subject_id",
        F.col("best.n").alias("max_run_len"),
        F.when(found, -F.col("best.earliness")).alias("best_run_start_day"),
        F.when(found, F.col("best.last")).alias("best_run_end_day"),
    )


def participant_summary(daily: DataFrame, cfg: ValidParticipants) -> DataFrame:
    days = in_day_range(typed_days(daily), cfg.day_start, cfg.day_end)
    return longest_runs(days).withColumn("pass", F.col("max_run_len") >= cfg.min_consecutive_days)


def passing(summary: DataFrame) -> DataFrame:
    return summary.where(F.col("pass"))


def failing(summary: DataFrame) -> DataFrame:
    return summary.where(~F.col("pass"))


def days_of_passing(daily: DataFrame, summary: DataFrame, cfg: ValidParticipants) -> DataFrame:
    """All days, in the range, of the passing subjects.

    The subject list is repeated per salt and the days are salted by their number, so that a
    subject with a third of all days is not joined in one task. A short list is broadcast
    by the adaptive plan all the same.
    """
    days = in_day_range(typed_days(daily), cfg.day_start, cfg.day_end)
    subjects = passing(summary).select(
        "subject_id", F.explode(F.array(*[F.lit(i) for i in range(_SALTS)])).alias("salt")
    )
    salt = F.pmod(F.coalesce("day_index", F.lit(0)), F.lit(_SALTS)).cast("int")
    return days.withColumn("salt", salt).join(subjects, ["subject_id", "salt"], "left_semi").drop("salt")


def participant_counts(summary: DataFrame) -> DataFrame:
    """How many participants pass, and the run lengths of those."""
    length = F.when(F.col("pass"), F.col("max_run_len"))
    return summary.agg(
        F.count(F.lit(1)).alias("n_subjects"),
        F.count_if("pass").alias("n_pass"),
        F.count_if(~F.col("pass")).alias("n_fail"),
        percent(F.count_if("pass"), F.count(F.lit(1))).alias("pass_percent"),
        F.avg(length).alias("mean_run_len"),
        F.median(length).alias("median_run_len"),
        F.min(length).alias("min_run_len"),
        F.max(length).alias("max_run_len"),
    )
