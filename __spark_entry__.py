
from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from functools import partial
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracle
import workload
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.config import (
    ACTIVITY_METRICS,
    MINUTE_COLUMNS,
    Cohort,
    CollectedDays,
    Duplicates,
    HeartRateStats,
    Missingness,
    Outliers,
    ValidDays,
    ValidParticipants,
)
from pulsegrid.functions.ratio import percent
from pulsegrid.operators import days, facts, metrics, minutes, readings
from pulsegrid.plans import cohort, steps
from pulsegrid.sources.keys import metric_keys, valid_day_keys
from pulsegrid.sources.minutes import parse_minutes, read_minutes, worn_readings
from pulsegrid.sources.settle import settle, shared_folder
from pulsegrid.sources.tables import SRC_ORDER, write_table

try:
    import corpus_pipeline
    from pulsegrid.llm import queries as llm_queries
except ModuleNotFoundError as error:
    if error.name not in ("corpus_pipeline", "pulsegrid.llm"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# Events are sparse: two minutes make a day valid there, three valid days a participant.
SPARSE_DAYS = ValidDays(threshold_minutes=2)
SPARSE_RUN = ValidParticipants(min_consecutive_days=3)


def entry(spark: SparkSession) -> DataFrame:
    """Collected days and minutes of the dense cohort."""
    return queries()["global_counts"](spark, "/root/testdata/sf0.001")


def _ready(spark: SparkSession) -> None:
    """Names a folder for settled tables where the session has none, as in local runs."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pulsegrid-"))


class _Inputs:
    """The tables a query may start from. Each is built only when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @property
    def sparse(self) -> DataFrame:
        return workload.sparse(self.spark, self.sf_dir)

    @property
    def odd(self) -> DataFrame:
        return workload.odd(self.spark, self.sf_dir)

    @property
    def odd_clean(self) -> DataFrame:
        return steps.remove_outliers(steps.remove_duplicates(self.odd).minutes.drop(minutes.COPIES)).minutes

    @property
    def odd_days(self) -> DataFrame:
        return settle(steps.find_valid_days(self.odd_clean, SPARSE_DAYS).daily)

    @property
    def dense(self) -> DataFrame:
        return workload.dense(self.spark, self.sf_dir)

    @property
    def sparse_clean(self) -> DataFrame:
        return steps.remove_outliers(steps.remove_duplicates(self.sparse).minutes.drop(minutes.COPIES)).minutes

    @property
    def dense_clean(self) -> DataFrame:
        return steps.remove_outliers(self.dense).minutes

    @property
    def sparse_days(self) -> DataFrame:
        return settle(steps.find_valid_days(self.sparse_clean, SPARSE_DAYS).daily)

    @property
    def dense_days(self) -> DataFrame:
        return settle(steps.find_valid_days(self.dense_clean).daily)

    def daily(self, name: str) -> DataFrame:
        return workload.daily(self.spark, self.sf_dir, name)

    def coverage(self) -> steps.MetricCoverage:
        names = ("keys", "activity", "resting", "daily_hr", "sleep")
        return steps.metric_coverage(*[self.daily(name) for name in names])

    def cohort(self) -> dict[str, DataFrame]:
        sources = cohort.Sources(self.dense, self.daily("activity"), self.daily("resting"), self.daily("sleep"))
        return cohort.run(sources, Cohort())


def _csv_round_trip(i: _Inputs) -> DataFrame:
    path = f"{shared_folder(i.spark)}/csv-{uuid.uuid4().hex}"
    write_table(i.sparse.select(*MINUTE_COLUMNS), path, "csv")
    return read_minutes(i.spark, path, "csv", ordered=False)


def _csv_odd_records(i: _Inputs) -> DataFrame:
    """Rows that run over several lines, written in several files and deduplicated by their place there."""
    path = f"{shared_folder(i.spark)}/csv-{uuid.uuid4().hex}"
    rows = i.sparse.withColumn("subject_id", F.expr(workload.ODD_SUBJECT))
    parts = rows.repartitionByRange(4, "src_order").sortWithinPartitions("src_order")
    write_table(parts.select(*MINUTE_COLUMNS), path, "csv")
    return steps.remove_duplicates(read_minutes(i.spark, path, "csv")).minutes.drop(SRC_ORDER)


def _csv_layouts(i: _Inputs) -> DataFrame:
    """Files of two column orders, the earlier half of the rows in the first one, read as one table and deduplicated."""
    path, rows = f"{shared_folder(i.spark)}/csv-{uuid.uuid4().hex}", i.sparse
    half = rows.agg(F.max("src_order")).first()[0] // 2
    for name, part, columns in (
        ("a", rows.where(F.col("src_order") <= half), MINUTE_COLUMNS),
        ("b", rows.where(F.col("src_order") > half), MINUTE_COLUMNS[::-1]),
    ):
        write_table(part.repartitionByRange(2, "src_order").sortWithinPartitions("src_order").select(*columns), f"{path}/{name}", "csv")
    return steps.remove_duplicates(read_minutes(i.spark, f"{path}/*", "csv")).minutes.drop(SRC_ORDER)


def _dedup_from_files(i: _Inputs) -> DataFrame:
    """The dedup of several written files, whose rows' order is known from their places alone."""
    path = f"{shared_folder(i.spark)}/csv-{uuid.uuid4().hex}"
    parts = i.sparse.repartitionByRange(5, "src_order").sortWithinPartitions("src_order")
    write_table(parts.select(*MINUTE_COLUMNS), path, "csv")
    return steps.remove_duplicates(read_minutes(i.spark, path, "csv")).minutes.drop(SRC_ORDER)


def _readings_on_repeated_days(i: _Inputs) -> DataFrame:
    days = i.odd_days
    return readings.rows_on_days(worn_readings(i.odd), valid_day_keys(days.unionByName(days)))


def _odd_hr(i: _Inputs) -> steps.DailyReadings:
    return steps.daily_heart_rate(i.odd_days, i.odd_clean, HeartRateStats(filter_valid_days=False))


def _observed(i: _Inputs) -> DataFrame:
    return settle(facts.observed_days(i.sparse_clean))


def _hr_keys(daily: DataFrame) -> DataFrame:
    return daily.withColumns({c: F.col(c).cast("string") for c in ("day_index", "is_valid_day")})


def _dense_hr(i: _Inputs) -> steps.DailyReadings:
    """Valid days and heart-rate statistics of the dense minutes, which are read once for both."""
    cleaned = i.dense_clean
    by_day = steps.wear_and_readings(cleaned)
    daily = settle(steps.find_valid_days(cleaned, by_day=by_day).daily)
    return steps.daily_heart_rate(_hr_keys(daily), cleaned, by_day=by_day)


def _outlier_summary(i: _Inputs) -> DataFrame:
    counts = steps.remove_outliers(i.dense, store=settle).summary
    return counts.withColumn("outlier_percent", percent(F.col("outliers_detected"), F.col("input_rows")))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 9) for name in names})


_QUERIES: dict[str, Callable[[_Inputs], DataFrame]] = {
    # Sources and row filters
    "parse_minutes": lambda i: parse_minutes(i.sparse),
    "csv_round_trip": _csv_round_trip,
    "csv_odd_records": _csv_odd_records,
    "csv_two_layouts": _csv_layouts,
    "timed_minutes": lambda i: minutes.timed_rows(i.sparse),
    "recorded_minutes": lambda i: minutes.recorded_rows(i.sparse, short=True),
    "worn_minutes": lambda i: minutes.worn_rows(i.sparse),
    # Collected days
    "recorded_minutes_per_day": lambda i: facts.recorded_by_day(i.sparse),
    "last_recorded_days": lambda i: days.last_days(facts.recorded_by_day(i.sparse)),
    "patient_days": lambda i: days.patient_days(settle(facts.recorded_by_day(i.sparse)), 3),
    "global_counts": lambda i: steps.count_collected_days(i.dense),
    "global_counts_range": lambda i: steps.count_collected_days(i.sparse, CollectedDays(2, 35)),
    "recording_ratio": lambda i: days.with_recording_ratio(steps.count_collected_days(i.sparse)),
    # Duplicates
    "dedup_last": lambda i: steps.remove_duplicates(i.sparse).minutes,
    "dedup_first": lambda i: steps.remove_duplicates(i.sparse, Duplicates(keep="first")).minutes,
    "dedup_by_minute": lambda i: minutes.keep_one(
        parse_minutes(i.sparse).where("ok_datetime").drop("ok_datetime", "ok_hr_validminute"),
        ("subject_id", "day_index", "minute_of_day"),
    ),
    "dedup_last_from_files": _dedup_from_files,
    "dedup_summary": lambda i: steps.remove_duplicates(i.sparse).summary,
    # Outliers
    "outlier_flags": lambda i: minutes.with_outlier_flags(i.sparse),
    "outlier_replace": lambda i: steps.remove_outliers(i.sparse).minutes,
    "outlier_drop": lambda i: steps.remove_outliers(i.sparse, Outliers(60, 150, "drop")).minutes,
    "outlier_summary": _outlier_summary,
    # Valid days
    "observed_days": _observed,
    "day_grid": lambda i: days.day_grid(days.last_days(_observed(i))),
    "day_grid_to_fixed_end": lambda i: days.day_grid(days.last_days(_observed(i)), 5, 40),
    "daily_adherence": lambda i: steps.find_valid_days(i.dense_clean).daily,
    "daily_adherence_sparse": lambda i: steps.find_valid_days(i.sparse_clean, SPARSE_DAYS).daily,
    "daily_adherence_from_first_day": lambda i: steps.find_valid_days(
        i.sparse_clean, ValidDays(threshold_ratio=0.002, start_at_zero=False, normalize_time=False)
    ).daily,
    "valid_day_summary": lambda i: steps.find_valid_days(i.dense_clean).summary,
    # Valid participants
    "participant_runs": lambda i: steps.find_valid_participants(i.dense_days).summary,
    "participant_runs_sparse": lambda i: steps.find_valid_participants(i.sparse_days, SPARSE_RUN).summary,
    "participant_runs_range": lambda i: steps.find_valid_participants(
        i.dense_days, ValidParticipants(4, day_start=2, day_end=9)
    ).summary,
    "subjects_pass": lambda i: steps.find_valid_participants(i.dense_days).passing.select("subject_id"),
    "subjects_fail": lambda i: steps.find_valid_participants(i.dense_days).failing.select("subject_id"),
    "daily_pass": lambda i: steps.find_valid_participants(i.sparse_days, SPARSE_RUN).daily,
    "run_stats": lambda i: _rounded(
        steps.find_valid_participants(i.sparse_days, SPARSE_RUN).counts, "pass_percent", "mean_run_len"
    ),
    # Heart-rate statistics
    "valid_day_keys": lambda i: valid_day_keys(_hr_keys(i.dense_days)),
    "worn_readings": lambda i: worn_readings(i.sparse),
    "readings_on_valid_days": lambda i: readings.rows_on_days(
        worn_readings(i.sparse_clean), valid_day_keys(i.sparse_days)
    ),
    "daily_hr_stats": lambda i: _dense_hr(i).daily,
    "hr_stats_summary": lambda i: _dense_hr(i).summary,
    # Daily metrics
    "metric_keys": lambda i: metric_keys(i.daily("keys")),
    "collapse_mean": lambda i: metrics.daily_metrics(i.daily("activity"), ACTIVITY_METRICS),
    "collapse_first": lambda i: metrics.daily_metrics(i.daily("activity"), ACTIVITY_METRICS, "first"),
    "merged_metrics": lambda i: metrics.merged_values(i.coverage().merged),
    "missingness": lambda i: i.coverage().report.drop("place"),
    "missingness_top": lambda i: metrics.first_rows(i.coverage().report),
    "missingness_unknown_metric": lambda i: steps.metric_coverage(
        *[i.daily(name) for name in ("keys", "activity", "resting", "daily_hr", "sleep")],
        Missingness(("steps", "weight"), filter_valid_days=False),
    ).report.drop("place"),
    # Compliance
    "daily_compliance": lambda i: steps.wear_compliance(i.dense_clean).daily,
    "compliance_stats": lambda i: _rounded(
        steps.wear_compliance(i.dense_clean).summary, "mean_compliance", "median_compliance"
    ),
    "compliance_histogram": lambda i: steps.wear_compliance(i.dense_clean).histogram,
    "compliance_histogram_sparse": lambda i: steps.wear_compliance(i.sparse_clean).histogram,
    # Cells in every spelling, days below 0, days without readings, repeated days, runs of years
    "odd_minutes": lambda i: parse_minutes(i.odd),
    "odd_dedup": lambda i: steps.remove_duplicates(i.odd).minutes,
    "odd_dedup_summary": lambda i: steps.remove_duplicates(i.odd).summary,
    "odd_outliers": lambda i: i.odd_clean,
    "odd_adherence": lambda i: i.odd_days,
    "odd_adherence_from_first_day": lambda i: steps.find_valid_days(
        i.odd_clean, ValidDays(threshold_minutes=2, start_at_zero=False)
    ).daily,
    "odd_hr_stats": lambda i: _odd_hr(i).daily,
    "odd_hr_summary": lambda i: _odd_hr(i).summary,
    "odd_readings_on_repeated_days": _readings_on_repeated_days,
    "runs_over_blocks": lambda i: steps.find_valid_participants(
        workload.long(i.spark, i.sf_dir), ValidParticipants(min_consecutive_days=30)
    ).summary,
    # The combined job
    "cohort_flow": lambda i: i.cohort()["cohort_flow"],
    "cohort_raw_counts": lambda i: cohort.stage_counts("raw", i.sparse),
    "cohort_global_counts": lambda i: i.cohort()["global_counts"],
    "cohort_outlier_counts": lambda i: i.cohort()["step3_summary"],
    "cohort_hr_stats": lambda i: i.cohort()["daily_hr_stats"],
    "cohort_hr_summary": lambda i: i.cohort()["step6_summary"],
    "cohort_participants": lambda i: _rounded(i.cohort()["participant_counts"], "pass_percent", "mean_run_len"),
    "cohort_merged_metrics": lambda i: i.cohort()["merged_metrics"],
    "cohort_compliance": lambda i: i.cohort()["daily_compliance"],
    "cohort_histogram": lambda i: i.cohort()["compliance_histogram"],
    "cohort_dedup_summary": lambda i: i.cohort()["step2_summary"],
    "cohort_daily_pass": lambda i: i.cohort()["daily_adherence_pass_subjects"],
    "cohort_missingness": lambda i: i.cohort()["step7_summary"],
}


def _run(build: Callable[[_Inputs], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return build(_Inputs(spark, sf_dir))


def _run_llm(query: Query, spark: SparkSession, sf_dir: str) -> DataFrame:
    _ready(spark)
    return query(spark, sf_dir)


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {name: partial(_run, build) for name, build in _QUERIES.items()}
    if llm_queries:
        more = {**llm_queries.QUERIES, "pipeline": corpus_pipeline.run}
        found |= {name: partial(_run_llm, query) for name, query in more.items()}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracle.statements()
    if llm_queries:
        found |= llm_queries.ORACLE_SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
