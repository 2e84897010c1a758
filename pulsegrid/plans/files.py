"""The steps from files to files. Every table is written once and its summary read from it.

CSV is the study's exchange format, Parquet the one to use at scale. Spark writes a folder
per table. Minute tables carry ``src_order`` along, for rows in a folder have no order.
"""

from __future__ import annotations

from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.config import (
    ACTIVITY_METRICS,
    DAILY_HR_METRICS,
    RESTING_METRICS,
    SLEEP_METRICS,
    Cohort,
    CollectedDays,
    Duplicates,
    HeartRateStats,
    Missingness,
    Outliers,
    ValidDays,
    ValidParticipants,
    WearCompliance,
)
from pulsegrid.operators import days, facts, metrics, minutes, readings, spread
from pulsegrid.plans import cohort, steps
from pulsegrid.sources.keys import metric_keys, valid_day_keys
from pulsegrid.sources.minutes import read_minutes
from pulsegrid.sources.settle import settle
from pulsegrid.sources.tables import read_table, write_table
from pulsegrid.sources.versions import fingerprint, publish, published, write_once

Path = str | PurePath


_SORTED_BY = {
    "daily_adherence": ["subject_id", "day_index"],
    "participant_summary": ["subject_id"],
    "subjects_pass": ["subject_id"],
    "subjects_fail": ["subject_id"],
    "daily_adherence_pass_subjects": ["subject_id", "day_index"],
    "merged_metrics": ["subject_id", "date"],
    "daily_compliance": ["subject_id", "day_index"],
    "compliance_histogram": ["bin"],
}


def _at(outdir: Path, name: str) -> str:
    return f"{str(outdir).rstrip('/')}/{name}"


def _small(df: DataFrame, outdir: Path, name: str, fmt: str) -> DataFrame:
    """A table of one or a few rows, as a single part file."""
    return write_table(df.coalesce(1), _at(outdir, name), fmt)


def collected_days(
    spark: SparkSession, minutes_path: Path, outdir: Path, cfg: CollectedDays = CollectedDays(), fmt: str = "csv"
) -> DataFrame:
    raw = read_minutes(spark, minutes_path, fmt, ordered=False)
    return _small(steps.count_collected_days(raw, cfg), outdir, "global_counts", fmt)


def duplicates(
    spark: SparkSession, minutes_path: Path, outdir: Path, cfg: Duplicates = Duplicates(), fmt: str = "csv"
) -> steps.Deduplicated:
    raw = read_minutes(spark, minutes_path, fmt)
    kept = steps.remove_duplicates(raw, cfg).minutes
    stored = write_table(cohort.clustered(kept), _at(outdir, "hr_1min_deduped"), fmt)
    totals = minutes.duplicate_counts(minutes.kept_by_day(stored))
    return steps.Deduplicated(stored, _small(totals, outdir, "step2_summary", fmt))


def outliers(
    spark: SparkSession, deduped_path: Path, outdir: Path, cfg: Outliers = Outliers(), fmt: str = "csv"
) -> steps.Cleaned:
    path = _at(outdir, "hr_1min_outlier_cleaned")
    result = steps.remove_outliers(read_minutes(spark, deduped_path, fmt), cfg, store=lambda df: write_table(df, path, fmt))
    return steps.Cleaned(result.minutes, _small(result.summary, outdir, "step3_summary", fmt))


def valid_days(
    spark: SparkSession, cleaned_path: Path, outdir: Path, cfg: ValidDays = ValidDays(), fmt: str = "csv"
) -> steps.Adherence:
    result = steps.find_valid_days(read_minutes(spark, cleaned_path, fmt), cfg)
    daily = write_table(result.daily.orderBy("subject_id", "day_index"), _at(outdir, "daily_adherence"), fmt)
    return steps.Adherence(daily, _small(days.valid_day_totals(daily, cfg), outdir, "step4_summary", fmt))


def valid_participants(
    spark: SparkSession, daily_path: Path, outdir: Path, cfg: ValidParticipants = ValidParticipants(), fmt: str = "csv"
) -> steps.Participants:
    result = steps.find_valid_participants(read_table(spark, daily_path, fmt), cfg)
    stored = {
        "subjects_pass": result.passing.select("subject_id").orderBy("subject_id"),
        "subjects_fail": result.failing.select("subject_id").orderBy("subject_id"),
    }
    for name, table in stored.items():
        write_table(table, _at(outdir, name), fmt)
    kept = result.daily.orderBy("subject_id", "day_index")
    return result._replace(daily=write_table(kept, _at(outdir, "daily_adherence_pass_subjects"), fmt))


def heart_rate(
    spark: SparkSession,
    keys_path: Path,
    cleaned_path: Path,
    outdir: Path,
    cfg: HeartRateStats = HeartRateStats(),
    name: str = "daily_hr_stats",
    fmt: str = "csv",
) -> steps.DailyReadings:
    keys = valid_day_keys(read_table(spark, keys_path, fmt), cfg.filter_valid_days)
    cleaned = read_minutes(spark, cleaned_path, fmt, ordered=False)
    stats = settle(readings.stats_on_days(keys, facts.readings_by_day(cleaned)))
    daily = write_table(stats.orderBy("subject_id", "day_index").drop("day_index"), _at(outdir, name), fmt)
    return steps.DailyReadings(daily, _small(readings.stats_totals(stats), outdir, "step6_summary", fmt))


def coverage(
    spark: SparkSession,
    keys_path: Path,
    activity_path: Path,
    resting_path: Path,
    daily_hr_path: Path,
    sleep_path: Path,
    outdir: Path,
    cfg: Missingness = Missingness(),
    fmt: str = "csv",
) -> steps.MetricCoverage:
    ordered = cfg.collapse == "first"
    collapsed = [
        metrics.collapse_days(read_table(spark, path, fmt, ordered=ordered), names, cfg.collapse)
        for path, names in (
            (activity_path, ACTIVITY_METRICS),
            (resting_path, RESTING_METRICS),
            (daily_hr_path, DAILY_HR_METRICS),
            (sleep_path, SLEEP_METRICS),
        )
    ]
    keys = metric_keys(read_table(spark, keys_path, fmt), cfg.filter_valid_days)
    merged = settle(metrics.merge_metrics(keys, collapsed))
    values = metrics.merged_values(merged).orderBy("subject_id", "date")
    report = metrics.missing_counts(merged, cfg.metrics)
    ordered_report = report.orderBy("place").drop("place")
    return steps.MetricCoverage(
        write_table(values, _at(outdir, "merged_metrics"), fmt), _small(ordered_report, outdir, "step7_summary", fmt)
    )


def compliance(
    spark: SparkSession, cleaned_path: Path, outdir: Path, cfg: WearCompliance = WearCompliance(), fmt: str = "csv"
) -> steps.Compliance:
    cleaned = read_minutes(spark, cleaned_path, fmt, ordered=False)
    observed = settle(facts.observed_days(cleaned, None, cfg.normalize_time))
    daily = days.daily_compliance(observed, cfg.expected_minutes).orderBy("subject_id", "day_index")
    stored = write_table(daily, _at(outdir, "daily_compliance"), fmt)
    counts = spread.value_counts(stored)
    return steps.Compliance(
        stored,
        _small(spread.compliance_totals(counts, cfg.threshold_ratio), outdir, "compliance_summary", fmt),
        _small(spread.histogram(counts, cfg.bins).orderBy("bin"), outdir, "compliance_histogram", fmt),
    )


def whole_cohort(
    spark: SparkSession,
    minutes_path: Path,
    activity_path: Path,
    resting_path: Path,
    sleep_path: Path,
    outdir: Path,
    daily_hr_path: Path | None = None,
    cfg: Cohort = Cohort(),
    fmt: str = "csv",
    layout: str = "scan",
    resume: bool = False,
) -> dict[str, DataFrame]:
    """The combined job from files to files, with the same sorted tables in every format.

    What later tables are made from is kept as Parquet under ``tables``. With ``resume``, tables that
    stand finished in outdir are taken as they are: use it where outdir belongs to these inputs and
    settings alone, as in ``published_cohort``. ``layout`` is that of CSV minutes, see ``csv_files``.
    """
    write = write_once if resume else write_table

    def daily_table(path: Path) -> DataFrame:
        return read_table(spark, path, fmt, ordered=cfg.missingness.collapse == "first")

    sources = cohort.Sources(
        read_minutes(spark, minutes_path, fmt, layout=layout),
        daily_table(activity_path),
        daily_table(resting_path),
        daily_table(sleep_path),
        daily_table(daily_hr_path) if daily_hr_path else None,
    )

    kept: dict[str, DataFrame] = {}

    def store(name: str, table: DataFrame) -> DataFrame:
        kept[name] = write(table, _at(outdir, f"tables/{name}"))
        return kept[name]

    def finish(name: str, table: DataFrame) -> DataFrame:
        if name == "daily_hr_stats":  # sorted by a column that it does not have
            table = kept["daily_hr_by_day"].orderBy("subject_id", "day_index").drop("day_index")
        elif name in _SORTED_BY:
            table = table.orderBy(*_SORTED_BY[name])
        return write(table, _at(outdir, name), fmt)

    return {name: finish(name, table) for name, table in cohort.run(sources, cfg, store).items()}


def published_cohort(
    spark: SparkSession,
    minutes_path: Path,
    activity_path: Path,
    resting_path: Path,
    sleep_path: Path,
    outdir: Path,
    daily_hr_path: Path | None = None,
    cfg: Cohort = Cohort(),
    fmt: str = "csv",
    layout: str = "scan",
) -> dict[str, DataFrame]:
    """whole_cohort, published as one set: ``published(spark, outdir)`` names its folder when all of it is there.

    A job that died is started again by the same call: it takes the tables that were finished and
    computes the others. Until it is through, readers go on with the set before.
    """
    paths = (minutes_path, activity_path, resting_path, sleep_path, daily_hr_path)
    version = f"cohort-{fingerprint(spark, paths, cfg, fmt, layout)}"
    tables = whole_cohort(
        spark, minutes_path, activity_path, resting_path, sleep_path, _at(outdir, version), daily_hr_path, cfg, fmt, layout, resume=True
    )
    if published(spark, outdir) != _at(outdir, version):
        publish(spark, outdir, version)
    return tables
