import pytest
from conftest import rows
from pyspark.sql import functions as F

from pulsegrid.config import HeartRateStats, Missingness
from pulsegrid.operators import metrics, readings
from pulsegrid.plans import steps
from pulsegrid.sources.keys import metric_keys, valid_day_keys
from pulsegrid.sources.minutes import worn_readings


def source(spark, *cells, columns="steps"):
    names = ["src_order long", "subject_id string", "date string", *[f"{c} string" for c in columns.split()]]
    return spark.createDataFrame([(at, *row) for at, row in enumerate(cells)], ", ".join(names))


def flags(df, *names):
    return rows(df, "subject_day.subject_id", "subject_day.date", *names)


def test_collapse_mean(spark):
    table = source(spark, ("a", "day0", "5"), ("a", "day0", "x"), ("a", "day1", "x"), ("b", "day0", None),
                   ("c", "day0", "x"), ("c", "day0", "y"))
    found = metrics.collapse_days(table, ["steps"])
    assert flags(found, "steps", "steps__missing") == [
        ("a", "day0", 5.0, False), ("a", "day1", None, False), ("b", "day0", None, True), ("c", "day0", None, True),
    ]


def test_collapse_first(spark):
    table = source(spark, ("a", "day0", None), ("a", "day0", "x"), ("a", "day0", "7"), ("a", "day0", "9"))
    for partitions in (1, 9):
        found = metrics.daily_metrics(table.repartition(partitions), ["steps", "weight"], "first")
        assert rows(found) == [("a", "day0", 7.0, None)]


def test_repeated_days_without_a_key_are_dropped(spark):
    table = source(spark, (None, "day0", "1"), (None, "day0", "2"), ("a", None, "3"), (None, None, "4"))
    assert rows(metrics.daily_metrics(table, ["steps"])) == [("a", None, 3.0), (None, None, 4.0)]


def test_a_source_without_any_metric_is_empty(spark):
    found = metrics.daily_metrics(source(spark, ("a", "day0", "1"), columns="other"), ["steps"])
    assert (found.columns, found.count()) == (["subject_id", "date", "steps"], 0)


def coverage(spark, cfg):
    keys = spark.createDataFrame(
        [("a", "day0", "True"), ("a", "day0", "true"), ("a", None, "1"), ("b", "day0", "1"), ("b", "day1", "False")],
        "subject_id string, date string, is_valid_day string",
    )
    activity = source(spark, ("a", "day0", "0", "x"), ("a", None, "8", "1"), ("b", "Day0", "9", "1"),
                      columns="steps distance")
    resting = source(spark, ("b", "day0", "61"), columns="resting_hr")
    none = source(spark, columns="other")
    return steps.metric_coverage(keys, activity, resting, none, none, cfg)


def test_coverage(spark):
    merged, report = coverage(spark, Missingness(("steps", "distance", "resting_hr", "weight", "cnt_deep")))
    values = metrics.merged_values(merged)
    assert len(values.columns) == 25
    assert rows(values, "subject_id", "date", "steps", "distance", "resting_hr") == [
        ("a", "day0", 0.0, None, None), ("a", None, 8.0, 1.0, None), ("b", "day0", None, None, 61.0),
    ]
    # zero is a value; so is text on a day that occurs once; an unknown metric is missing everywhere
    assert [tuple(r)[1:] for r in report.orderBy("place").collect()] == [
        ("steps", 1, 1 / 3, 3), ("distance", 1, 1 / 3, 3), ("resting_hr", 2, 2 / 3, 3), ("weight", 3, 1.0, 3),
        ("cnt_deep", 3, 1.0, 3),
    ]
    everything = coverage(spark, Missingness(("steps",), filter_valid_days=False)).report
    assert rows(everything) == [(0, "steps", 2, 0.5, 4)]


def test_missingness_without_keys(spark):
    merged = coverage(spark, Missingness(("steps",))).merged.limit(0)
    found = metrics.missing_counts(merged, ["steps", "weight"])
    assert rows(found) == [(0, "steps", 0, 0.0, 0), (1, "weight", 0, 1.0, 0)]
    assert rows(metrics.first_rows(found, 1), "metric") == [("steps",)]


def test_merge_shuffles_each_input_once(spark, capsys, monkeypatch):
    monkeypatch.setattr(steps, "settle", lambda df: df)  # the plan that is stored, not the stored table
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        coverage(spark, Missingness(("steps",))).merged.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert capsys.readouterr().out.count("Exchange hashpartitioning") == 3  # activity, resting, keys


def test_keys(spark):
    table = spark.createDataFrame(
        [("a", "0", "day0", "True"), ("a", "0", "day0", "1"), ("a", "x", None, "true"), ("b", "1", "day1", None)],
        "subject_id string, day_index string, date string, is_valid_day string",
    )
    assert rows(valid_day_keys(table)) == [("a", 0, "day0"), ("a", 0, "day0"), ("a", None, None)]
    assert valid_day_keys(table, False).count() == 4
    assert rows(metric_keys(table)) == [("a", "day0"), ("a", None)]
    assert metric_keys(table.drop("is_valid_day")).count() == 3
    with pytest.raises(ValueError, match="is_valid_day"):
        valid_day_keys(table.drop("is_valid_day"))


def test_daily_heart_rate(spark, minutes):
    rows_in = minutes(
        ("a", "day0", "09:30", "60"), ("a", "Day0", "bad", "70"), ("a", "day0", "09:30", "0"), ("a", "day1", "09:30", "0"),
        ("b", "day0", "09:30", "90"), (None, "day0", "09:30", "50"),
    )
    keys = spark.createDataFrame(
        [("a", 0, "day0", True), ("a", 0, "day0", True), ("a", 1, "day1", True), ("b", 0, "day0", False),
         (None, 0, "day0", True)],
        "subject_id string, day_index long, date string, is_valid_day boolean",
    )
    daily, summary = steps.daily_heart_rate(keys, rows_in)
    assert rows(daily) == [
        ("a", "day0", 65.0, 70.0, 60.0), ("a", "day0", 65.0, 70.0, 60.0), ("a", "day1", None, None, None),
        (None, "day0", None, None, None),
    ]
    assert rows(summary) == [(1, 4, 2, 2, 65.0, 0.0, 70.0, 0.0, 60.0, 0.0)]
    everything = steps.daily_heart_rate(keys, rows_in, HeartRateStats(False)).summary
    assert rows(everything, "n_subjects", "n_valid_days", "n_days_with_hr_data") == [(2, 5, 3)]
    kept = readings.rows_on_days(worn_readings(rows_in), valid_day_keys(keys))
    assert rows(kept) == [("a", 0, 60.0), ("a", 0, 70.0)]


def test_daily_heart_rate_of_nothing(spark, minutes):
    keys = spark.createDataFrame([], "subject_id string, day_index long, date string, is_valid_day boolean")
    summary = steps.daily_heart_rate(keys, minutes(("a", "day0", "09:30", "60"))).summary
    assert rows(summary) == [(0, 0, 0, 0, *[None] * 6)]


def test_minutes_test_their_day_where_they_are(spark, monkeypatch):
    """Days below 0, on the borders of words, null and repeated; a column that clashes; both ways alike."""
    days = [-65, -64, -1, 0, 1, 63, 64, 127, 128, 1000, None]
    many = spark.createDataFrame([(s, d, i) for i, (s, d) in enumerate((s, d) for s in ("a", "b", None) for d in days * 3)],
                                 "subject_id string, day_index long, bits int").withColumn("word", F.lit("mine"))
    listed = [("a", d, "x") for d in (-64, -1, 0, 63, 128, 128, None)] + [("b", 64, "x"), (None, 0, "x"), ("c", 1, "x")]
    keys = spark.createDataFrame(listed, "subject_id string, day_index long, date string")
    kept = readings.rows_on_days(many, keys)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(readings, "MOST_WORD_BYTES", 0)
    assert rows(kept) == rows(readings.rows_on_days(many, keys).select(kept.columns))
    assert sorted({(r.subject_id, r.day_index) for r in kept.collect()}) == [("a", -64), ("a", -1), ("a", 0), ("a", 63), ("a", 128), ("b", 64)]


def test_a_hot_day_is_split_in_the_semi_join(spark, monkeypatch):
    """Nine of ten rows belong to one subject-day; the adaptive plan splits it, repeated keys or not."""
    monkeypatch.setattr(readings, "MOST_WORD_BYTES", 0)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40))
        many = spark.range(0, 200_000, 1, 8).select(
            hot.alias("subject_id"), F.lit(3).cast("bigint").alias("day_index"), F.rand(1).alias("hr_num")
        )
        keys = spark.createDataFrame([("hot", 3, "day3"), ("hot", 3, "day3"), ("s0", 3, "day3")], "subject_id string, day_index long, date string")
        kept = readings.rows_on_days(many, keys)
        assert kept.count() == 180_000 + many.where("subject_id = 's0'").count()
        kept.write.format("noop").mode("overwrite").save()
        found = kept.select("subject_id", "hr_num")
        found.collect()
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
