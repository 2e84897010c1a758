import pytest
from pyspark.sql import functions as F

from pulsegrid.config import Outliers, ValidDays
from pulsegrid.functions import clock, heart_rate, ratio, text


def evaluate(spark, cells, build, kind="string"):
    df = spark.createDataFrame([(at, cell) for at, cell in enumerate(cells)], f"at int, cell {kind}")
    return [r.v for r in df.select("at", build(F.col("cell")).alias("v")).orderBy("at").collect()]


def test_number(spark):
    cells = ["72.0", " 72 ", "72d", "72f", "0x1p3", "nan", "NA", "0", "-5", "1,000", "", "1e2", ".", "1.", ".5", "1.2.3", None]
    expected = [72, 72, None, None, None, None, None, 0, -5, None, None, 100, None, 1, 0.5, None, None]
    assert evaluate(spark, cells, text.number) == expected
    assert evaluate(spark, ["inf", "-Infinity", "infinit"], text.number) == [float("inf"), float("-inf"), None]


def test_whole_numbers_are_told_by_their_size(spark):
    cells = ["5", "00", "10", "999", "9999", "12345", "+5", "5 ", " 12", "10.", "10\x01", "1 2", "007", "99999999999999999999", "\u0663"]
    expected = [5, 0, 10, 999, 9999, 12345, 5, 5, 12, 10, None, None, 7, 1e20, None]
    assert evaluate(spark, cells, text.number) == expected


def test_usual_times_are_read_without_a_pattern(spark):
    cells = ["00:00:00", "09:05:07", "23:59:59", "24:00:00", "10:60:00", "10:00:60", "1:234:56", "12:34:5.", "12:34:5 ", "0+:34:56",
             "+1:05:07", "12:3.:00", "1.:05:00", "09:5\x01:00", "12:3456:", "1:2:3", "ab:cd:ef", "12:00:00:00", None]
    expected = [0, 545, 1439, None, None, None, None, None, 754, None, None, None, None, None, None, 62, None, None, None]
    assert evaluate(spark, cells, lambda c: clock.minute_of_day(c, short=True)) == expected
    sql = spark.range(1).select(F.lit("x").alias("cell")).select(clock.minute_of_day(F.col("cell")).alias("v"))
    assert sql._jdf.queryExecution().analyzed().toString().count("RLIKE") == 0


def test_full_time_of_odd_cells(spark):
    cells = ["09:05:07", "9:5", " 9:5", "1:2:3", "12:00:00:00", "a:b", "12:00 ", "1:2:3x", "", None]
    expected = ["09:05:07", "9:5:00", "9:5:00", "1:2:3", "12:00:00:00", "a:b:00", "12:00:00", "1:2:3x", "", None]
    assert evaluate(spark, cells, clock.full_time) == expected


def test_null_texts(spark):
    cells = ["NA", "", "null", "#N/A", "x", " NA", None]
    assert evaluate(spark, cells, text.null_texts) == [None, None, None, None, "x", " NA", None]


def test_truth(spark):
    cells = ["True", "1", "true", "yes", "0", " true", None]
    assert evaluate(spark, cells, text.truth) == [True, True, True, False, False, False, False]


def test_minute_of_day(spark):
    cells = ["09:30", " 09:30:00 ", "9:30:00", "24:00:00", "09:30:15", "abc", None, "09:60:00", "1 :30:00", "23:59:59"]
    short = [570, 570, 570, None, 570, None, None, None, None, 1439]
    assert evaluate(spark, cells, lambda c: clock.minute_of_day(c, short=True)) == short
    assert evaluate(spark, cells, clock.minute_of_day) == [None, *short[1:]]
    assert evaluate(spark, cells, lambda c: clock.minute_of_day(clock.full_time(c))) == short
    valid = evaluate(spark, cells, lambda c: F.coalesce(clock.is_time(c, short=True), F.lit(False)))
    assert valid == [v is not None for v in short]


def test_full_time(spark):
    cells = ["09:30", " 9:30 ", "09:30:00", "0930", "1:2:3:4", None]
    assert evaluate(spark, cells, clock.full_time) == ["09:30:00", "9:30:00", "09:30:00", "0930", "1:2:3:4", None]


def test_day_index(spark):
    cells = ["day0", "DAY3", " day7 ", "day-1", "day3.0", "day 3", "day1e2", "day", "3", "day1.5", "dayinf", "dayx", None]
    assert evaluate(spark, cells, clock.day_index) == [0, 3, 7, -1, 3, 3, 100, None, None, None, None, None, None]


def test_reading_flags(spark):
    cells = [72.0, 0.0, -5.0, None]
    assert evaluate(spark, cells, heart_rate.has_reading, "double") == [True, False, True, False]
    assert evaluate(spark, cells, heart_rate.is_worn, "double") == [True, False, False, None]
    bounds = [39.9, 40.0, 163.0, 163.1, 0.0, None]
    outside = evaluate(spark, bounds, lambda c: heart_rate.is_outlier(c, 40, 163), "double")
    assert outside == [True, False, False, True, True, None]


def test_one_decimal_rounds_ties_to_even(spark):
    assert evaluate(spark, [0.25, 0.35, 106.54, None], ratio.one_decimal, "double") == [0.2, 0.4, 106.5, None]


def test_share_of_nothing(spark):
    assert evaluate(spark, [0, 4], lambda c: ratio.share(F.lit(1), c), "int") == [0.0, 0.25]
    assert evaluate(spark, [4], lambda c: ratio.percent(F.lit(1), c), "int") == [25.0]


def test_threshold():
    assert ValidDays(threshold_ratio=0.7).threshold == int(1440 * 0.7) == 1007
    assert ValidDays(threshold_minutes=5).threshold == 5


def test_settings_are_checked():
    with pytest.raises(ValueError, match="mode"):
        Outliers(mode="clip")
