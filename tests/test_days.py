import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.config import CollectedDays, Outliers, ValidDays, WearCompliance
from pulsegrid.operators import days, facts, minutes as minute_ops, spread
from pulsegrid.plans import steps


def test_grid(spark):
    ends = spark.createDataFrame([("a", 2), ("b", -1)], "subject_id string, last_day long")
    assert rows(days.day_grid(ends)) == [("a", 0), ("a", 1), ("a", 2)]
    assert rows(days.day_grid(ends, -1)) == [("a", -1), ("a", 0), ("a", 1), ("a", 2), ("b", -1)]
    assert days.day_grid(ends, 0, 4).count() == 10
    assert rows(days.day_grid(ends, 3)) == []


@pytest.mark.parametrize("first, last", [(0, 5000), (-3000, 1023), (1024, 1024), (-1024, -1)])
def test_grid_over_blocks(spark, first, last):
    ends = spark.createDataFrame([("a", last)], "subject_id string, last_day long")
    assert [r.day_index for r in days.day_grid(ends, first).orderBy("day_index").collect()] == list(range(first, last + 1))


def test_collected_days(minutes):
    df = minutes(
        ("a", "day0", "09:30", "70"), ("a", "day0", "09:30", "70"), ("a", "day2", "09:30", "-1"),
        ("a", "day3", "09:30", "0"), ("b", "day-1", "09:30", "70"), (None, "day9", "09:30", "70"),
    )
    assert rows(steps.count_collected_days(df)) == [(1, 3, 4320, 3)]
    assert rows(steps.count_collected_days(df, CollectedDays(-1))) == [(2, 5, 7200, 4)]
    assert rows(steps.count_collected_days(df, CollectedDays(1, 4))) == [(2, 8, 11520, 1)]
    assert rows(days.with_recording_ratio(steps.count_collected_days(df)))[0][-1] == 3 / 4320
    per_day = facts.recorded_by_day(df)
    assert rows(per_day) == [("a", 0, 2), ("a", 2, 1), ("b", -1, 1)]
    assert rows(days.patient_days(per_day)) == [("a", 0, 2), ("a", 1, 0), ("a", 2, 1)]


def test_collected_days_of_nothing(minutes):
    assert rows(steps.count_collected_days(minutes((None, None, None, None)))) == [(0, 0, 0, 0)]


def test_valid_days(minutes):
    df = minutes(
        ("a", "Day0", "09:30:10", "70"), ("a", "day0", "09:30:50", "71"), ("a", "day0", "9:31:00", "72"),
        ("a", "day0", "23:59", "73"), ("a", "day0", "12:00", "0"), ("a", "day2", "09:30", "70"),
        ("a", "day3", "09:30", "0"), ("b", "day4", "bad", "70"), (None, "day0", "09:30", "70"),
    )
    daily, summary = steps.find_valid_days(df, ValidDays(threshold_minutes=3))
    found = rows(daily, "subject_id", "day_index", "date", "worn_minutes", "is_valid_day")
    assert found == [
        ("a", 0, "Day0", 3, True), ("a", 1, None, 0, False), ("a", 2, "day2", 1, False), ("a", 3, "day3", 0, False),
    ]
    assert rows(summary) == [(1, 4, 1, 0.25, 3, 0.8)]
    strict, _ = steps.find_valid_days(df, ValidDays(normalize_time=False))
    assert rows(strict, "day_index", "worn_minutes") == [(0, 2)]


def test_days_may_start_before_zero_or_later(minutes):
    # The first day is the cohort's, also when only a row without a subject has it.
    early = minutes(("a", "day-1", "09:30", "70"), ("a", "day0", "09:30", "70"), (None, "day-2", "09:30", "70"))
    cfg = ValidDays(start_at_zero=False)
    assert rows(steps.find_valid_days(early, cfg).daily, "day_index") == [(-2,), (-1,), (0,)]
    assert rows(steps.find_valid_days(early).daily, "day_index") == [(0,)]
    late = minutes(("a", "day5", "09:30", "70"), ("b", "day3", "09:30", "70"))
    found = rows(steps.find_valid_days(late, cfg).daily, "subject_id", "day_index")
    assert found == [("a", 3), ("a", 4), ("a", 5), ("b", 3)]


def brute_facts(table, low=40, high=163):
    found = {}
    for at, subject, day, minute, hr in table:
        entry = found.setdefault((subject, day), {"first": None, "worn": set(), "hr": [], "recorded": 0})
        clean = 0 if hr < low or hr > high else hr
        entry["recorded"] += hr != 0
        entry["first"] = at if entry["first"] is None else min(at, entry["first"])
        if clean > 0:
            entry["worn"].add(minute)
            entry["hr"].append(clean)
    return found


@pytest.mark.parametrize("partitions", [1, 4, 60])
def test_facts_against_brute_force(minutes, partitions):
    pick = random.Random(5)
    table, cells = [], []
    for at in range(3000):
        subject, day, minute = pick.choice("abc"), pick.randrange(4), pick.randrange(0, 1440, 7)
        hr = pick.choice([0, 20, 60, 75, 120, 200])
        table.append((at, subject, day, minute, hr))
        label = pick.choice(["day", "Day", " day"]) + str(day)
        cells.append((subject, label, f"{minute // 60:02d}:{minute % 60:02d}:{pick.randrange(60):02d}", str(hr)))
    df = minutes(*cells).repartition(partitions)
    found = facts.day_facts(df, outliers=Outliers()).collect()
    expected = brute_facts(table)
    assert len(found) == len(expected)
    for row in found:
        entry = expected[row.subject_id, row.day_index]
        assert row.date == cells[entry["first"]][1]
        assert row.worn_minutes == len(entry["worn"])
        assert row.recorded_minutes == row.kept_rows == entry["recorded"]
        assert (row.hr_n, row.hr_total) == (len(entry["hr"]), sum(entry["hr"]))
        assert (row.hr_max, row.hr_min) == (max(entry["hr"]), min(entry["hr"]))
    cleaned = minute_ops.clean_outliers(df)
    by_day = {(r.subject_id, r.day_index): r for r in facts.readings_by_day(cleaned).collect()}
    for row in facts.reading_days(facts.day_facts(df, outliers=Outliers())).collect():
        assert by_day[row.subject_id, row.day_index] == row


def test_dropped_outliers_leave_no_timed_row(minutes):
    df = minutes(("a", "day0", "09:30", "70"), ("a", "day1", "09:30", "200"))
    found = {r.day_index: r for r in facts.day_facts(df, outliers=Outliers(mode="drop")).collect()}
    assert (found[1].timed_rows, found[1].date, found[1].too_high) == (0, None, 1)
    zeroed = {r.day_index: r for r in facts.day_facts(df, outliers=Outliers()).collect()}
    assert (zeroed[1].timed_rows, zeroed[1].date, zeroed[1].worn_minutes) == (1, "day1", 0)


def test_compliance(minutes):
    df = minutes(("a", "Day0", "09:30", "70"), ("a", "day2", "09:30", "70"), ("a", "day2", "09:31", "70"))
    daily, summary, histogram = steps.wear_compliance(df, WearCompliance(expected_minutes=4))
    assert rows(daily) == [("a", 0, "day0", 1, 0.25), ("a", 1, "day1", 0, 0.0), ("a", 2, "day2", 2, 0.5)]
    assert rows(summary) == [(3, 0.25, 0.25, 1, 0.8)]
    assert histogram.agg(F.sum("n")).first()[0] == 3


@pytest.mark.parametrize("seed", range(4))
def test_histogram_against_numpy(spark, seed):
    import numpy as np

    pick = np.random.default_rng(seed)
    values = pick.integers(0, [1441, 25, 3, 1000][seed], 400) / [1440, 24, 7, 3][seed]
    counts = spread.value_counts(spark.createDataFrame([(float(v),) for v in values], "compliance double"))
    found = spread.histogram(counts).orderBy("bin").collect()
    expected, edges = np.histogram(values, bins=25)
    assert [r.n for r in found] == expected.tolist()
    assert [r.lo for r in found] == edges[:-1].tolist() and found[-1].hi == edges[-1]


def test_histogram_of_equal_values_and_of_none(spark):
    table = lambda *v: spread.value_counts(spark.createDataFrame([(x,) for x in v], "compliance double"))
    found = spread.histogram(table(0.5, 0.5)).orderBy("bin").collect()
    assert (found[0].lo, found[-1].hi) == (0.0, 1.0)
    assert [r.n for r in found if r.n] == [2]
    assert spread.histogram(table()).count() == 0
    assert rows(spread.compliance_totals(table(1.0, 2.0, 4.0, 9.0), 0.8)) == [(4, 4.0, 3.0, 0, 0.8)]
