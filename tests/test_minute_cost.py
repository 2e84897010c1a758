"""What a minute costs, and that the cheap ways give the same rows."""

import re

import pytest
import workload
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.functions.clock import SHORT_TIME, day_index, minute_guess, minute_of_day
from pulsegrid.operators.facts import observed_days
from pulsegrid.operators.minutes import clean_outliers

ODD_TIMES = [
    "1:02:00", "01:02", "01:02:0", "01:02:60", "24:00:00", "-1:05:00", "+1:05:00", "0105:00:", "01:05:00 ", " 01:05:00",
    "01:05:\x010", "01:05:0a", "1:005:00", "01:05:+1", "", ":", "010500", "01::0500", "99:99:99", "2147483648", "01:5:009",
]


@pytest.fixture
def suppliers(spark, tmp_path):
    def build(*keys):
        spark.createDataFrame([(k,) for k in keys], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
        return str(tmp_path)

    return build


def test_tasks_of_the_dense_minutes_grow_with_the_subjects(spark, suppliers):
    tasks = workload.dense(spark, suppliers(*range(2000))).select("src_order").rdd.getNumPartitions()
    assert tasks == 16 > 2 * spark.sparkContext.defaultParallelism


def test_dense_minutes_of_negative_repeated_and_null_keys(spark, suppliers):
    found = rows(workload.dense(spark, suppliers(-5, 96, 96, None)), "src_order", "time", "hr")
    expected = []
    for k in (-5, 96, 96, None):
        for d in range(14):
            for m in range(1440):
                for c in range(2 if k is not None and (k + d + m) % 97 == 0 else 1):
                    expected.append((None if k is None else ((k * 14 + d) * 1440 + m) * 2 + c, f"{m // 60:02d}:{m % 60:02d}:00"))
    assert sorted((o is None, o or 0, t) for o, t, _ in found) == sorted((o is None, o or 0, t) for o, t in expected)


@pytest.mark.parametrize("guessed", [False, True])
def test_minute_of_every_second_and_of_odd_texts(spark, guessed):
    times = [f"{h:02d}:{m:02d}:{s:02d}" for h in range(24) for m in range(60) for s in (0, 1, 30, 59)] + ODD_TIMES
    table = spark.createDataFrame([(t,) for t in times], "time string").withColumn("g", minute_guess(F.col("time")))
    found = table.select("time", minute_of_day(F.col("time"), True, F.col("g") if guessed else None)).collect()
    for time, minute in found:
        match = re.match(SHORT_TIME, time.strip(" "), re.ASCII)
        assert minute == (int(match[1]) * 60 + int(match[2]) if match else None), time


def test_a_reading_is_cast_once_for_cleaning_and_once_for_the_facts(minutes):
    df = observed_days(clean_outliers(minutes(("a", "day0", "00:00:00", "70"))))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"try_cast\(hr#\d+ as bigint\)", plan)) == 2


def test_day_labels_in_odd_spellings(spark):
    labels = {"day3": 3, " DAY3 ": 3, "day 3e0": 3, "day3.": 3, "day+3": 3, "day.5": None, "dayinf": None, "day": None, "day3x": None, "day1e30": None}
    table = spark.createDataFrame([(t,) for t in labels], "date string")
    assert dict(table.select("date", day_index(F.col("date"))).collect()) == labels
