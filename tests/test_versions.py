import pytest

from conftest import rows
from pulsegrid.plans import files
from pulsegrid.sources import tables, versions
from test_plans import SMALL, daily_inputs, events  # noqa: F401


@pytest.fixture
def inputs(spark, events, tmp_path):  # noqa: F811
    activity, resting, sleep = daily_inputs(spark)
    found = {"minutes": events, "activity": activity, "resting": resting, "sleep": sleep}
    for name, table in found.items():
        tables.write_table(table, tmp_path / name, "parquet")
    return [tmp_path / name for name in found]


def results(spark, folder, names):
    return {name: rows(spark.read.parquet(f"{folder}/{name}")) for name in names}


def test_a_job_that_died_goes_on_and_readers_keep_the_old_set(spark, inputs, tmp_path, monkeypatch):
    out = tmp_path / "out"
    assert versions.published(spark, out) is None
    first = files.published_cohort(spark, *inputs, out, cfg=SMALL, fmt="parquet")
    old = versions.published(spark, out)
    before = results(spark, old, first)

    tables.write_table(spark.read.parquet(str(inputs[0])).where("subject_id <> 'a'"), f"{inputs[0]}-more", "parquet")
    changed = [f"{inputs[0]}-more", *inputs[1:]]
    written, real = [], tables.write_table

    def failing(df, path, fmt="parquet"):
        if len(written) == 12:
            raise RuntimeError("the job dies")
        written.append(path)
        return real(df, path, fmt)

    monkeypatch.setattr(versions, "write_table", failing)
    with pytest.raises(RuntimeError, match="dies"):
        files.published_cohort(spark, *changed, out, cfg=SMALL, fmt="parquet")
    assert versions.published(spark, out) == old and results(spark, old, first) == before

    again = []
    monkeypatch.setattr(versions, "write_table", lambda df, path, fmt="parquet": (again.append(path), real(df, path, fmt))[1])
    found = files.published_cohort(spark, *changed, out, cfg=SMALL, fmt="parquet")
    assert not set(map(str, again)) & set(map(str, written)) and len(again) > 5
    new = versions.published(spark, out)
    assert new != old and results(spark, old, first) == before
    whole = files.whole_cohort(spark, *changed, tmp_path / "whole", cfg=SMALL, fmt="parquet")
    for name, table in whole.items():
        assert rows(found[name]) == rows(table), name

    again.clear()
    files.published_cohort(spark, *changed, out, cfg=SMALL, fmt="parquet")
    assert not again and versions.published(spark, out) == new


def test_a_fingerprint_tells_settings_and_files_apart(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a"))
    name = lambda *settings: versions.fingerprint(spark, [tmp_path / "a", None], *settings)
    assert name(SMALL, "csv") == name(SMALL, "csv") != name(SMALL, "parquet")
    before = name(1)
    spark.range(6).write.mode("append").parquet(str(tmp_path / "a"))
    assert name(1) != before
    assert versions.fingerprint(spark, [None, tmp_path / "a"], 1) != name(1)


def test_sets_are_numbered_and_never_overwritten(spark, tmp_path):
    for k in range(12):
        assert versions.publish(spark, tmp_path, f"set-{k}") == k + 1
    assert versions.published(spark, tmp_path) == f"{tmp_path}/set-11"
    store = versions._Store(spark, f"{tmp_path}/published")
    assert not store.create("000000003", "another") and store.read("000000003") == "set-2"


def test_a_half_written_table_is_written_again(spark, tmp_path):
    path = tmp_path / "t"
    spark.range(3).write.parquet(str(path))
    (path / "_SUCCESS").unlink()
    assert versions.write_once(spark.range(7), path).count() == 7
    assert versions.write_once(spark.range(99), path).count() == 7
