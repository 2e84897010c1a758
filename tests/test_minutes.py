import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.config import Duplicates, Outliers
from pulsegrid.operators import minutes as ops
from pulsegrid.plans import steps
from pulsegrid.sources.minutes import parse_minutes, worn_readings


def test_parse_minutes(minutes):
    df = parse_minutes(minutes(("a", "Day2", "09:30", "0"), ("a", "day2", "9:61:00", "7x"), (None, None, None, None)))
    found = df.orderBy("src_order").select(
        "time", "day_index", "minute_of_day", "ok_datetime", "hr_num", "ok_hr_validminute"
    )
    assert [tuple(r) for r in found.collect()] == [
        ("09:30:00", 2, 570, True, 0.0, False),
        ("9:61:00", 2, None, False, None, False),
        (None, None, None, False, None, False),
    ]


def test_row_filters(minutes):
    df = minutes(
        ("a", "day0", "09:30:00", "72"),
        ("a", "day0", "09:31:00", "0"),
        ("a", "day0", "09:32:00", "-5"),
        ("a", "day0", "09:33:00", None),
        ("a", "day0", "09:34", "70"),
        ("a", "x", "09:35:00", "70"),
    )
    order = lambda found: [r.src_order for r in found.orderBy("src_order").collect()]
    assert order(ops.timed_rows(df)) == [0, 1, 2, 3]
    assert order(ops.recorded_rows(df)) == [0, 2]
    assert order(ops.recorded_rows(df, short=True)) == [0, 2, 4]
    assert order(ops.worn_rows(df)) == [0]
    assert rows(worn_readings(df)) == [("a", 0, 70.0), ("a", 0, 72.0)]


@pytest.mark.parametrize("keep, readings", [("last", ["80", "90"]), ("first", ["70", "90"])])
@pytest.mark.parametrize("partitions", [1, 4, 37])
def test_dedup(minutes, keep, readings, partitions):
    df = minutes(
        ("a", "day1", "09:30", "70"), ("a", "day1", "09:30:00", "80"), ("a", "Day1", "09:30:00", "90"),
        ("a", "day1", "09:30:00", "0"), ("a", "day1", "09:30:00", "NA"),
    ).repartition(partitions)
    kept, summary = steps.remove_duplicates(df, Duplicates(keep=keep))
    assert [r.hr for r in kept.orderBy("hr").collect()] == readings
    assert rows(summary) == [(2, 1, 1)]


def test_dedup_keeps_rows_without_a_subject_but_no_grid_for_them(minutes):
    df = minutes((None, "day1", "09:30", "70"), (None, "day1", "09:30", "71"), ("a", "day2", "09:30", "70"),
                 ("a", "day-1", "09:30", "70"))
    kept, summary = steps.remove_duplicates(df)
    assert kept.count() == 3
    # a: 3 grid days, 2 days with a record; without a subject: 1 day with a record
    assert rows(summary) == [(3, 1, 0)]


def test_dedup_of_one_hot_minute(spark):
    many = spark.range(20_000).select(
        F.col("id").alias("src_order"), F.lit("a").alias("subject_id"), F.lit("day0").alias("date"),
        F.lit("09:30").alias("time"), F.col("id").cast("string").alias("hr"),
    )
    kept, summary = steps.remove_duplicates(many)
    assert rows(kept, "hr", "src_order", "copies") == [("19999", 19999, 19999)]
    assert rows(summary) == [(1, 19998, 0)]


def test_dedup_keeps_the_readings_text(minutes):
    texts = ["72", "72.0", " 7.2e1", "+00072.50", "-5", "1" * 28, "72." + "0" * 30 + "1", "inf", "7", "\t99 "]
    df = minutes(*[("a", "day0", f"09:{at:02d}:00", text) for at, text in enumerate(texts)])
    kept = ops.keep_one(df)
    assert plan(kept).count("hashpartitioning") == 1
    found = [r.hr for r in kept.orderBy("src_order").collect()]
    assert found == texts
    nothing = ops.keep_one(minutes(("a", "day0", "09:30:00", None), ("a", "day0", "09:31:00", "")).drop("copies"))
    assert [r.hr for r in nothing.orderBy("time").collect()] == [None, ""]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_by_another_key(minutes):
    df = minutes(("a", "day1", "09:30", "70"), ("b", "day1", "09:30", "80"))
    kept, _ = steps.remove_duplicates(df, Duplicates(key=("date", "time")))
    assert rows(kept, "subject_id", "hr", "copies") == [("b", "80", 2)]


def test_dedup_of_nothing(minutes):
    _, summary = steps.remove_duplicates(minutes(("a", "x", "09:30", "70")))
    assert rows(summary) == [(0, 0, 0)]


def outlier_rows(minutes):
    return minutes(*[("a", "day0", "09:30", hr) for hr in ("39.9", "40", "163", "163.1", "0", None)])


def test_outliers_replaced(minutes):
    cleaned, summary = steps.remove_outliers(outlier_rows(minutes))
    assert [r.hr for r in cleaned.orderBy("src_order").collect()] == ["0", "40", "163", "0", "0", None]
    assert {r.time for r in cleaned.collect()} == {"09:30:00"}
    assert rows(summary) == [(6, 3, 2, 1)]


def test_outliers_dropped(minutes):
    cleaned, summary = steps.remove_outliers(outlier_rows(minutes), Outliers(mode="drop", normalize_time=False))
    assert [r.hr for r in cleaned.orderBy("src_order").collect()] == ["40", "163"]
    assert {r.time for r in cleaned.collect()} == {"09:30"}
    assert rows(summary) == [(6, 3, 2, 1)]
