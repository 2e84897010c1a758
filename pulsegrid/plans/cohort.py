"""The combined job: raw minutes and daily sources in, all result tables out.

The raw minutes are read once, for the dedup; rows without a reading leave a marker for each subject
there. One pass over the deduplicated table yields the daily facts, and every later table is made
from those.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import (
    ACTIVITY_METRICS,
    DAILY_HR_METRICS,
    DEDUP_KEY,
    MINUTE_COLUMNS,
    RESTING_METRICS,
    SLEEP_METRICS,
    Cohort,
)
from pulsegrid.operators import days, facts, metrics, minutes, packed, readings, runs, spread
from pulsegrid.sources.keys import metric_keys, valid_day_keys
from pulsegrid.sources.minutes import with_full_time
from pulsegrid.sources.settle import settle
from pulsegrid.sources.tables import SRC_ORDER, require_columns

Store = Callable[[str, DataFrame], DataFrame]

# Pages of the second version hold sorted numbers as differences: the row order takes next to nothing.
SMALL = {"compression": "zstd", "parquet.writer.version": "PARQUET_2_0"}


class Sources(NamedTuple):
    """The input tables. Without a daily heart-rate table the job's own statistics are used."""

    minutes: DataFrame
    activity: DataFrame
    resting: DataFrame
    sleep: DataFrame
    daily_hr: DataFrame | None = None


def clustered(rows: DataFrame) -> DataFrame:
    """The rows of a subject-day together and sorted, in partitions of even size.

    Later aggregates then fold a day within one task. Rebalancing, unlike a plain
    repartitioning, splits a partition that is too big, so no key can make a hot task.
    """
    return rows.hint("rebalance", "subject_id", "date").sortWithinPartitions("subject_id", "date", "time")


def _settle(name: str, table: DataFrame) -> DataFrame:
    return settle(table, SMALL)


def run(sources: Sources, cfg: Cohort = Cohort(), store: Store = _settle) -> dict[str, DataFrame]:
    """All result tables by name.

    ``store`` keeps a named table and returns it as read back. It is called, and its job run,
    for each table that later ones are made from.
    """
    raw = require_columns(sources.minutes, [*MINUTE_COLUMNS, SRC_ORDER], "minute table")
    if not {"subject_id", "date"} <= set(cfg.duplicates.key):
        raise ValueError(f"the combined job needs subject_id and date in the dedup key, as in {DEDUP_KEY}")
    rows = with_full_time(raw)
    kept = minutes.keep_one_marked(rows, cfg.duplicates.key, cfg.duplicates.keep)
    # Packed minutes come clustered from the dedup.
    marked = store("hr_1min_deduped", kept if packed.can_pack(rows, cfg.duplicates.key) else clustered(kept))
    deduped = marked.where(~F.col(minutes.UNRECORDED)).drop(minutes.UNRECORDED)
    by_day = store(
        "day_facts", facts.day_facts(deduped, copies=minutes.COPIES, outliers=cfg.outliers)
    )

    daily = store("daily_adherence", days.daily_adherence(facts.timed_days(by_day), cfg.valid_days))
    participants = store("participant_summary", runs.participant_summary(daily, cfg.participants))
    daily_pass = store(
        "daily_adherence_pass_subjects", runs.days_of_passing(daily, participants, cfg.participants)
    )
    keys = valid_day_keys(daily, cfg.heart_rate.filter_valid_days)
    with_hr = store("daily_hr_by_day", readings.stats_on_days(keys, facts.reading_days(by_day)))

    # The job's own statistics hold one row per day, so "first" needs no order there.
    own_hr = with_hr.withColumn(SRC_ORDER, F.lit(0).cast("bigint"))
    inputs = [
        (sources.activity, ACTIVITY_METRICS),
        (sources.resting, RESTING_METRICS),
        (own_hr if sources.daily_hr is None else sources.daily_hr, DAILY_HR_METRICS),
        (sources.sleep, SLEEP_METRICS),
    ]
    collapsed = [metrics.collapse_days(table, names, cfg.missingness.collapse) for table, names in inputs]
    merged = store(
        "merged_with_flags",
        metrics.merge_metrics(metric_keys(daily_pass, cfg.missingness.filter_valid_days), collapsed),
    )
    compliance = store(
        "daily_compliance", days.daily_compliance(facts.timed_days(by_day), cfg.compliance.expected_minutes)
    )
    values = spread.value_counts(compliance)
    collected = facts.recorded_days(by_day)
    return {
        "global_counts": days.collected_totals(collected, cfg.collected.day_start, cfg.collected.day_end),
        "hr_1min_deduped": deduped,
        "step2_summary": minutes.duplicate_counts(facts.kept_days(by_day)),
        "hr_1min_outlier_cleaned": minutes.clean_outliers(
            deduped, cfg.outliers.min_hr, cfg.outliers.max_hr, cfg.outliers.mode
        ).drop(minutes.COPIES),
        "step3_summary": by_day.agg(
            *[
                F.coalesce(F.sum(total), F.lit(0)).alias(name)
                for name, total in (
                    ("input_rows", F.col("rows")),
                    ("outliers_detected", F.col("too_low") + F.col("too_high")),
                    ("outliers_too_low", F.col("too_low")),
                    ("outliers_too_high", F.col("too_high")),
                )
            ]
        ),
        "daily_adherence": daily,
        "step4_summary": days.valid_day_totals(daily, cfg.valid_days),
        "participant_summary": participants,
        "participant_counts": runs.participant_counts(participants),
        "subjects_pass": runs.passing(participants).select("subject_id"),
        "subjects_fail": runs.failing(participants).select("subject_id"),
        "daily_adherence_pass_subjects": daily_pass,
        "daily_hr_stats": with_hr.drop("day_index"),
        "step6_summary": readings.stats_totals(with_hr),
        "merged_metrics": metrics.merged_values(merged),
        "step7_summary": metrics.missing_counts(merged, cfg.missingness.metrics).drop("place"),
        "daily_compliance": compliance,
        "compliance_summary": spread.compliance_totals(values, cfg.compliance.threshold_ratio),
        "compliance_histogram": spread.histogram(values, cfg.compliance.bins),
        "cohort_flow": _flow(marked, by_day, daily, daily_pass, with_hr, merged),
    }


def _flow(
    marked: DataFrame, by_day: DataFrame, daily: DataFrame, daily_pass: DataFrame, with_hr: DataFrame, merged: DataFrame
) -> DataFrame:
    """stage, rows, subjects: what each stage is left with, minutes first, then days.

    The raw minutes are the recorded ones, by day, and those that the markers stand for.
    """
    one = F.lit(1)
    others = marked.where(minutes.UNRECORDED).select("subject_id", F.col(minutes.COPIES).alias("recorded_minutes"))
    stages = [
        ("raw minutes", by_day.select("subject_id", "recorded_minutes").unionByName(others), F.col("recorded_minutes")),
        ("recorded minutes", by_day.where("recorded_minutes > 0"), F.col("recorded_minutes")),
        ("deduplicated minutes", by_day.where("kept_rows > 0"), F.col("kept_rows")),
        ("timed minutes", by_day.where("timed_rows > 0"), F.col("timed_rows")),
        ("worn minutes", by_day.where("worn_minutes > 0"), F.col("worn_minutes")),
        ("patient days", daily, one),
        ("valid days", daily.where("is_valid_day"), one),
        ("days of passing subjects", daily_pass, one),
        ("valid days with readings", with_hr.where("daily_mean is not null"), one),
        ("days with merged metrics", merged.select("subject_day.subject_id"), one),
    ]
    return reduce(DataFrame.unionByName, [stage_counts(stage, table, rows) for stage, table, rows in stages])


def stage_counts(stage: str, table: DataFrame, rows: Column | None = None) -> DataFrame:
    by_subject = table.groupBy("subject_id").agg(F.sum(F.lit(1) if rows is None else rows).alias("n"))
    return by_subject.agg(
        F.lit(stage).alias("stage"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count("subject_id").alias("subjects"),
    )
