"""The eight quality-control steps on DataFrames.

Each step takes raw or typed tables and returns its result tables. They are lazy but for one
thing: a table made from the minutes that more than one result reads is settled first, so that
the minutes are scanned once, however many of the results are used.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation

from pulsegrid.config import (
    ACTIVITY_METRICS,
    DAILY_HR_METRICS,
    MINUTE_COLUMNS,
    RESTING_METRICS,
    SLEEP_METRICS,
    CollectedDays,
    Duplicates,
    HeartRateStats,
    Missingness,
    Outliers,
    ValidDays,
    ValidParticipants,
    WearCompliance,
)
from pulsegrid.operators import days, facts, metrics, minutes, readings, runs, spread
from pulsegrid.sources.keys import metric_keys, valid_day_keys
from pulsegrid.sources.minutes import with_full_time
from pulsegrid.sources.settle import settle
from pulsegrid.sources.tables import SRC_ORDER, require_columns


Store = Callable[[DataFrame], DataFrame]


class Deduplicated(NamedTuple):
    minutes: DataFrame
    summary: DataFrame


class Cleaned(NamedTuple):
    minutes: DataFrame
    summary: DataFrame


class Adherence(NamedTuple):
    daily: DataFrame
    summary: DataFrame


class Participants(NamedTuple):
    summary: DataFrame
    daily: DataFrame
    passing: DataFrame
    failing: DataFrame
    counts: DataFrame


class DailyReadings(NamedTuple):
    daily: DataFrame
    summary: DataFrame


class MetricCoverage(NamedTuple):
    merged: DataFrame
    report: DataFrame


class Compliance(NamedTuple):
    daily: DataFrame
    summary: DataFrame
    histogram: DataFrame


def count_collected_days(raw: DataFrame, cfg: CollectedDays = CollectedDays()) -> DataFrame:
    """Subjects, days, expected and recorded minutes of the raw data."""
    require_columns(raw, MINUTE_COLUMNS, "minute table")
    recorded = facts.recorded_by_day(raw)
    return days.collected_totals(recorded, cfg.day_start, cfg.day_end)


def remove_duplicates(raw: DataFrame, cfg: Duplicates = Duplicates()) -> Deduplicated:
    """One row per minute of the recorded rows. ``raw`` needs ``src_order``.

    The times are always normalised first. The minutes are grouped once and settled.
    """
    require_columns(raw, [*MINUTE_COLUMNS, SRC_ORDER], "minute table")
    kept = settle(minutes.keep_one(with_full_time(minutes.recorded_rows(raw, short=True)), cfg.key, cfg.keep))
    return Deduplicated(kept, minutes.duplicate_counts(minutes.kept_by_day(kept)))


def remove_outliers(deduped: DataFrame, cfg: Outliers = Outliers(), store: Store | None = None) -> Cleaned:
    """Readings outside the range zeroed or dropped.

    ``store`` writes a table and returns it as read back. With it, the counts are taken from the rows
    as they pass by on their way to the store, so the minutes are read once for both results.
    Without it, both are lazy and read the minutes each.
    """
    require_columns(deduped, MINUTE_COLUMNS, "minute table")
    rows = with_full_time(deduped, cfg.normalize_time)
    if store is None:
        cleaned = minutes.clean_outliers(rows, cfg.min_hr, cfg.max_hr, cfg.mode)
        return Cleaned(cleaned, minutes.outlier_counts(rows, cfg.min_hr, cfg.max_hr))
    # A reading is parsed once, for the counts and for the cleaned rows.
    rows, parsed = minutes.with_parsed(rows)
    totals = minutes.outlier_totals(rows, cfg.min_hr, cfg.max_hr, parsed)
    seen, empty = Observation("outliers"), rows.limit(0).agg(*totals)
    stored = store(minutes.clean_outliers(rows.observe(seen, *totals), cfg.min_hr, cfg.max_hr, cfg.mode, parsed).drop(parsed))
    counts = seen.get  # without any total if the plan was found to have no rows
    return Cleaned(stored, deduped.sparkSession.createDataFrame([tuple(counts.get(c, 0) for c in empty.columns)], empty.schema))


def wear_and_readings(cleaned: DataFrame, cfg: ValidDays = ValidDays()) -> DataFrame:
    """The daily facts that find_valid_days and daily_heart_rate make from the minutes, in one pass, settled."""
    require_columns(cleaned, [*MINUTE_COLUMNS, SRC_ORDER], "minute table")
    by_day = facts.day_facts(cleaned, short=cfg.normalize_time)
    wear, heart = ("date", "timed_rows", "worn_minutes"), ("hr_n", "hr_total", "hr_max", "hr_min")
    return settle(by_day.select("subject_id", "day_index", *wear, *heart))


def find_valid_days(cleaned: DataFrame, cfg: ValidDays = ValidDays(), by_day: DataFrame | None = None) -> Adherence:
    """Wear per day over the full grid. ``cleaned`` needs ``src_order``: a day's date is its first label.

    ``by_day`` is the result of wear_and_readings of the same minutes and settings, where it is there
    already; the minutes are not read again then.
    """
    require_columns(cleaned, [*MINUTE_COLUMNS, SRC_ORDER], "minute table")
    if by_day is None:
        observed = settle(facts.observed_days(cleaned, short=cfg.normalize_time))
    else:
        observed = facts.timed_days(by_day)
    daily = days.daily_adherence(observed, cfg)
    return Adherence(daily, days.valid_day_totals(daily, cfg))


def find_valid_participants(daily: DataFrame, cfg: ValidParticipants = ValidParticipants()) -> Participants:
    """Participants with enough valid days in a row, and their days."""
    summary = settle(runs.participant_summary(daily, cfg))
    return Participants(
        summary,
        runs.days_of_passing(daily, summary, cfg),
        runs.passing(summary),
        runs.failing(summary),
        runs.participant_counts(summary),
    )


def daily_heart_rate(
    keys: DataFrame, cleaned: DataFrame, cfg: HeartRateStats = HeartRateStats(), by_day: DataFrame | None = None
) -> DailyReadings:
    """Mean, highest and lowest reading of each day in the key table. ``by_day`` as in find_valid_days."""
    require_columns(cleaned, MINUTE_COLUMNS, "minute table")
    wanted = valid_day_keys(keys, cfg.filter_valid_days)
    by_reading = facts.readings_by_day(cleaned) if by_day is None else facts.reading_days(by_day)
    daily = settle(readings.stats_on_days(wanted, by_reading))
    return DailyReadings(daily.drop("day_index"), readings.stats_totals(daily))


def metric_coverage(
    keys: DataFrame,
    activity: DataFrame,
    resting: DataFrame,
    daily_hr: DataFrame,
    sleep: DataFrame,
    cfg: Missingness = Missingness(),
) -> MetricCoverage:
    """All daily metrics on the key days, and how many of each are missing. The merged table is settled."""
    sources = [
        metrics.collapse_days(table, names, cfg.collapse)
        for table, names in (
            (activity, ACTIVITY_METRICS),
            (resting, RESTING_METRICS),
            (daily_hr, DAILY_HR_METRICS),
            (sleep, SLEEP_METRICS),
        )
    ]
    merged = settle(metrics.merge_metrics(metric_keys(keys, cfg.filter_valid_days), sources))
    return MetricCoverage(merged, metrics.missing_counts(merged, cfg.metrics))


def wear_compliance(cleaned: DataFrame, cfg: WearCompliance = WearCompliance()) -> Compliance:
    """Share of worn minutes of every day, and how it is spread."""
    require_columns(cleaned, MINUTE_COLUMNS, "minute table")
    observed = settle(facts.observed_days(cleaned, None, cfg.normalize_time))
    daily = settle(days.daily_compliance(observed, cfg.expected_minutes))
    counts = spread.value_counts(daily)
    return Compliance(daily, spread.compliance_totals(counts, cfg.threshold_ratio), spread.histogram(counts, cfg.bins))
