import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

import workload
from pulsegrid.config import ALL_METRICS, Cohort, Missingness, Outliers, ValidDays, ValidParticipants
from pulsegrid.operators import facts, minutes as minute_ops
from pulsegrid.plans import cohort, files, steps
from pulsegrid.sources.settle import settle

SF = "/root/testdata/sf0.001"
SMALL = Cohort(
    valid_days=ValidDays(threshold_minutes=2),
    participants=ValidParticipants(2),
    missingness=Missingness(("steps", "resting_hr", "daily_mean", "cnt_wake")),
)


@pytest.fixture(scope="module")
def events(spark):
    return settle(workload.sparse(spark, SF))


def daily_inputs(spark):
    return [workload.daily(spark, SF, name) for name in ("activity", "resting", "sleep")]


def step_by_step(spark, raw, cfg):
    """The eight steps one after another, each from the tables of the ones before."""
    deduped = steps.remove_duplicates(raw, cfg.duplicates)
    cleaned = steps.remove_outliers(deduped.minutes.drop("copies"), cfg.outliers)
    adherence = steps.find_valid_days(cleaned.minutes, cfg.valid_days)
    people = steps.find_valid_participants(adherence.daily, cfg.participants)
    stats = steps.daily_heart_rate(adherence.daily, cleaned.minutes, cfg.heart_rate)
    activity, resting, sleep = daily_inputs(spark)
    coverage = steps.metric_coverage(people.daily, activity, resting, stats.daily, sleep, cfg.missingness)
    compliance = steps.wear_compliance(cleaned.minutes, cfg.compliance)
    return {
        "global_counts": steps.count_collected_days(raw, cfg.collected),
        "hr_1min_deduped": deduped.minutes,
        "step2_summary": deduped.summary,
        "hr_1min_outlier_cleaned": cleaned.minutes,
        "step3_summary": cleaned.summary,
        "daily_adherence": adherence.daily,
        "step4_summary": adherence.summary,
        "participant_summary": people.summary,
        "participant_counts": people.counts,
        "daily_adherence_pass_subjects": people.daily,
        "daily_hr_stats": stats.daily,
        "step6_summary": stats.summary,
        "step7_summary": coverage.report.drop("place"),
        "daily_compliance": compliance.daily,
        "compliance_summary": compliance.summary,
        "compliance_histogram": compliance.histogram,
    }


@pytest.mark.parametrize("mode", ["replace_zero", "drop"])
def test_combined_job_equals_the_steps(spark, events, mode):
    cfg = Cohort(
        outliers=Outliers(mode=mode),
        valid_days=SMALL.valid_days,
        participants=SMALL.participants,
        missingness=SMALL.missingness,
    )
    together = cohort.run(cohort.Sources(events, *daily_inputs(spark)), cfg)
    apart = step_by_step(spark, events, cfg)
    for name, table in apart.items():
        assert rows(together[name], *sorted(table.columns)) == rows(table, *sorted(table.columns)), name
    # invariants
    daily = together["daily_adherence"]
    people = together["participant_summary"]
    passed, failed = together["subjects_pass"].count(), together["subjects_fail"].count()
    assert passed + failed == people.count() == daily.select("subject_id").distinct().count()
    assert 0 < passed
    assert together["compliance_histogram"].agg(F.sum("n")).first()[0] == together["daily_compliance"].count()
    summary = together["step2_summary"].first()
    recorded = minute_ops.recorded_rows(events, short=True).count()
    assert summary.filtered_rows + summary.removed_duplicates_rows == recorded
    assert all(r.missing_count <= r.total_keys for r in together["step7_summary"].collect())
    flow = [r.rows for r in together["cohort_flow"].collect()]
    assert flow[:2] == [events.count(), recorded]


def test_results_do_not_depend_on_partitions(spark, events):
    found = []
    for partitions in (1, 4, 200):
        shuffled = events.repartition(partitions)
        deduped = steps.remove_duplicates(shuffled).minutes
        daily = steps.find_valid_days(deduped, SMALL.valid_days).daily
        found.append((rows(deduped), rows(daily)))
    assert found[0] == found[1] == found[2]


def test_one_subject_with_most_rows(spark):
    """One subject has nearly all rows, one of its minutes a third of them."""
    pick = random.Random(3)
    cells = []
    for at in range(6000):
        subject = "hot" if at % 20 else f"s{at % 7}"
        day, minute = (0, 5) if at % 3 == 0 else (pick.randrange(30), pick.randrange(1440))
        cells.append((at, subject, f"day{day}", f"{minute // 60:02d}:{minute % 60:02d}", str(60 + at % 50)))
    raw = spark.createDataFrame(cells, "src_order long, subject_id string, date string, time string, hr string")
    last = {(s, d, t): (at, hr) for at, s, d, t, hr in cells}
    kept = steps.remove_duplicates(raw).minutes
    assert {(r.subject_id, r.date, r.time[:5]): (r.src_order, r.hr) for r in kept.collect()} == last
    days = {(s, int(d[3:])) for s, d, _ in last}
    worn = {day: sum((s, int(d[3:])) == day for s, d, _ in last) for day in days}
    assert {(r.subject_id, r.day_index): r.worn_minutes for r in facts.observed_days(kept).collect()} == worn


def read_in_order(spark, path, fmt, *columns):
    """The rows as they stand in the part files, one file after another."""
    out = []
    for part in sorted(path.glob("part-*")):
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        out += [tuple(r) for r in reader.format(fmt).load(str(part)).select(*columns).collect()]
    return out


@pytest.mark.parametrize("parts", [1, 6])
@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_files_to_files(spark, events, tmp_path, fmt, parts, monkeypatch):
    """The steps over files give what the same steps give over frames, row order included.

    With several files no rank table may be broadcast, as when there are very many.
    """
    if parts > 1:
        monkeypatch.setattr("pulsegrid.sources.tables._MOST_RANK_CHARS", 0)

    def put(name, table):
        table.coalesce(1).write.format(fmt).option("header", True).save(str(tmp_path / name))
        return tmp_path / name

    raw = tmp_path / "raw"
    ordered = events.repartitionByRange(parts, "src_order").sortWithinPartitions("src_order").drop("src_order")
    ordered.write.format(fmt).option("header", True).save(str(raw))
    assert len(list(raw.glob("part-*"))) == parts
    activity, resting, sleep = [
        put(name, table) for name, table in zip(("activity", "resting", "sleep"), daily_inputs(spark), strict=True)
    ]
    out = tmp_path / "out"
    assert rows(files.collected_days(spark, raw, out, fmt=fmt)) == rows(steps.count_collected_days(events))
    deduped = files.duplicates(spark, raw, out, fmt=fmt)
    assert rows(deduped.summary) == rows(steps.remove_duplicates(events).summary)
    files.outliers(spark, out / "hr_1min_deduped", out, fmt=fmt)
    cleaned = out / "hr_1min_outlier_cleaned"
    adherence = files.valid_days(spark, cleaned, out, SMALL.valid_days, fmt=fmt)
    apart = step_by_step(spark, events, SMALL)
    names = ("subject_id", "day_index", "date", "worn_minutes", "is_valid_day")
    assert rows(adherence.daily, *names) == rows(apart["daily_adherence"], *names)
    people = files.valid_participants(spark, out / "daily_adherence", out, SMALL.participants, fmt=fmt)
    assert rows(people.summary) == rows(apart["participant_summary"])
    stats = files.heart_rate(spark, out / "daily_adherence", cleaned, out, fmt=fmt)
    assert rows(stats.summary) == rows(apart["step6_summary"])
    report = files.coverage(
        spark, out / "daily_adherence_pass_subjects", activity, resting, out / "daily_hr_stats", sleep,
        out, SMALL.missingness, fmt,
    ).report
    assert rows(report) == rows(apart["step7_summary"])
    compliance = files.compliance(spark, cleaned, out, fmt=fmt)
    assert rows(compliance.histogram) == rows(apart["compliance_histogram"])

    tables = files.whole_cohort(spark, raw, activity, resting, sleep, tmp_path / "all", cfg=SMALL, fmt=fmt)
    for name in ("global_counts", "step2_summary", "step3_summary", "step4_summary", "step6_summary", "step7_summary"):
        assert rows(tables[name], *apart[name].columns) == rows(apart[name]), name
    for name, columns in (
        ("daily_adherence", ("subject_id", "day_index")),
        ("daily_adherence_pass_subjects", ("subject_id", "day_index")),
        ("daily_compliance", ("subject_id", "day_index")),
        ("daily_hr_stats", ("subject_id", "date")),
        ("subjects_pass", ("subject_id",)),
        ("subjects_fail", ("subject_id",)),
        ("merged_metrics", ("subject_id", "date")),
    ):
        found = read_in_order(spark, tmp_path / "all" / name, fmt, *columns)
        number = lambda r: (r[0], *[int(str(c).lower().removeprefix("day")) for c in r[1:]])
        key = (lambda r: tuple(c or "" for c in r)) if name == "merged_metrics" else number
        assert found == sorted(found, key=key), name
    assert tables["daily_hr_stats"].columns == ["subject_id", "date", "daily_mean", "daily_max", "daily_min"]
    assert (tmp_path / "all" / "merged_metrics").is_dir()
    assert len(tables["merged_metrics"].columns) == 2 + len(ALL_METRICS)


def test_the_label_is_parsed_after_the_first_aggregate(events, capsys):
    """The scan side must not parse day labels per row, and folds rows before any shuffle."""
    facts.observed_days(events).explain()
    plan = capsys.readouterr().out
    first = plan[plan.rindex("Exchange"):]
    assert "partial_bit_or" in first and "HashAggregate" in first
    assert "startswith" not in first.lower()
    assert "SortAggregate" not in first


class Scans:
    """Counts how often a frame's rows are made, through an accumulator in a Python function."""

    def __init__(self, spark, df):
        seen = spark.sparkContext.accumulator(0)

        def count(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        self.seen, self.df = seen, df.mapInArrow(count, df.schema)


def test_minutes_are_read_once_for_both_results(spark, events):
    n = events.count()
    scans = Scans(spark, events)
    result = steps.remove_duplicates(scans.df)
    result.minutes.collect(), result.summary.collect()
    assert scans.seen.value == n
    cleaned = settle(steps.remove_outliers(result.minutes.drop("copies")).minutes)
    daily = settle(steps.find_valid_days(cleaned, SMALL.valid_days).daily)
    scans = Scans(spark, cleaned)
    result = steps.daily_heart_rate(daily, scans.df)
    result.daily.collect(), result.summary.collect()
    assert scans.seen.value == cleaned.count()


def test_what_a_job_settled_is_removed_at_its_end(spark, events, tmp_path):
    from pathlib import Path

    from pulsegrid.sources.settle import settled_for, shared_folder

    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    with settled_for(spark):
        table = settle(events)
        assert table.count() == events.count()
        inside = set(folder.iterdir()) - before
        assert len(inside) == 1
        with settled_for(spark):
            settle(events)
        assert set(folder.iterdir()) - before == inside
    assert set(folder.iterdir()) == before


def test_outliers_are_counted_as_the_cleaned_table_is_stored(spark, events):
    n = events.count()
    for mode in ("replace_zero", "drop"):
        scans, cfg = Scans(spark, events), Outliers(60, 150, mode)
        result = steps.remove_outliers(scans.df, cfg, store=settle)
        assert rows(result.summary) == rows(steps.remove_outliers(events, cfg).summary)
        assert rows(result.minutes) == rows(steps.remove_outliers(events, cfg).minutes)
        assert scans.seen.value == n
    nothing = steps.remove_outliers(events.limit(0), store=settle)
    assert rows(nothing.summary) == [(0, 0, 0, 0)] and rows(nothing.minutes) == []
    assert nothing.summary.schema == steps.remove_outliers(events).summary.schema


def test_the_whole_job_reads_the_minutes_once(spark, events):
    scans = Scans(spark, events)
    tables = cohort.run(cohort.Sources(scans.df, *daily_inputs(spark)), SMALL)
    for table in tables.values():
        table.collect()
    assert scans.seen.value == events.count()
    flow = {r.stage: (r.rows, r.subjects) for r in tables["cohort_flow"].collect()}
    assert flow["raw minutes"] == tuple(cohort.stage_counts("raw", events).first())[1:]
    assert "unrecorded" not in tables["hr_1min_deduped"].columns


def test_subjects_without_a_recorded_minute_leave_one_marker(minutes):
    from pulsegrid.operators import minutes as ops

    raw = minutes(("a", "day0", "09:30:00", "60"), ("a", "day0", "09:30:00", "70"), ("a", "day0", "09:31:00", "0"), ("a", None, "x", None),
                  ("b", "day0", "09:30:00", None), ("b", "day1", "bad", "60"), (None, "day0", "09:30:00", "0"), (None, "day0", "09:30:00", "5"))
    found = ops.keep_one_marked(raw).select("subject_id", "date", "time", "hr", "src_order", "copies", "unrecorded")
    assert rows(found) == rows(raw.sparkSession.createDataFrame(
        [("a", "day0", "09:30:00", "70", 1, 2, False), ("a", None, None, None, None, 2, True), ("b", None, None, None, None, 2, True),
         (None, "day0", "09:30:00", "5", 7, 1, False), (None, None, None, None, None, 1, True)], found.schema))


def test_jobs_of_two_threads_keep_their_own_folders(spark):
    from threading import Barrier, Thread

    from pulsegrid.sources.settle import settled_for

    both, found = Barrier(2), {}

    def job(name):
        with settled_for(spark):
            both.wait(60)
            table = settle(spark.range(3))
            found[name] = {file.split("/settled-")[0] for file in table.inputFiles()}
            both.wait(60)

    threads = [Thread(target=job, args=(k,)) for k in range(2)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert len(found[0]) == len(found[1]) == 1 and found[0] != found[1]


def test_one_pass_gives_valid_days_and_readings(spark, events):
    cleaned = steps.remove_outliers(events).minutes
    by_day = steps.wear_and_readings(cleaned, ValidDays(threshold_minutes=2))
    alone = steps.find_valid_days(cleaned, ValidDays(threshold_minutes=2))
    shared = steps.find_valid_days(cleaned, ValidDays(threshold_minutes=2), by_day=by_day)
    assert rows(shared.daily) == rows(alone.daily) and rows(shared.summary) == rows(alone.summary)
    both = steps.daily_heart_rate(shared.daily, cleaned, by_day=by_day)
    apart = steps.daily_heart_rate(alone.daily, cleaned)
    assert rows(both.daily) == rows(apart.daily) and rows(both.summary) == rows(apart.summary)


def test_a_reading_is_parsed_once_where_outliers_are_stored(events):
    plans = []

    def store(df):
        plans.append(df._jdf.queryExecution().analyzed().toString())
        return settle(df)

    stored = steps.remove_outliers(events, store=store).minutes
    assert stored.columns == events.columns
    assert plans[0].count("translate(") == 1


def test_texts_of_a_day_are_made_once(spark, capsys):
    workload.dense(spark, SF).explain(True)
    optimized = capsys.readouterr().out.split("Optimized Logical Plan")[1].split("Physical Plan")[0]
    minute = optimized.index("posexplode(")
    assert "lpad(" not in optimized[:minute] and "lpad(" in optimized[minute:]
