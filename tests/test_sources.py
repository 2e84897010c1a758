import pytest

from conftest import rows
from pulsegrid.sources.minutes import read_minutes
from pulsegrid.sources.tables import read_table, require_columns, write_table

HEADER = "﻿Subject_ID, Date ,time,hr\n"


def test_csv_is_text_with_clean_names_and_nulls(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(HEADER + 's1,day0,09:30,74.0\nNA,day1,,n/a\n"a ""b""",day2,1,NaN\n', encoding="utf-8")
    df = read_minutes(spark, path, ordered=False)
    assert df.columns == ["subject_id", "date", "time", "hr"]
    assert set(dict(df.dtypes).values()) == {"string"}
    assert rows(df) == [('a "b"', "day2", "1", None), ("s1", "day0", "09:30", "74.0"), (None, "day1", None, None)]


def test_missing_file_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, tmp_path / "none.csv")
    with pytest.raises(ValueError, match="hr"):
        require_columns(spark.createDataFrame([("a",)], "subject_id string"), ["subject_id", "hr"])


@pytest.mark.parametrize("split", [200, 10_000_000])
def test_csv_row_order_in_one_file(spark, tmp_path, split):
    path = tmp_path / "in.csv"
    path.write_text("subject_id,date,time,hr\n" + "".join(f"s,day0,09:30,{n}\n" for n in range(500)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = read_minutes(spark, path)
        assert (df.rdd.getNumPartitions() > 5) == (split == 200)
        assert [int(r.hr) for r in df.orderBy("src_order").collect()] == list(range(500))
        assert dict(df.dtypes)["src_order"] == "bigint"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_row_order_over_files(spark, tmp_path):
    folder = tmp_path / "in put"
    folder.mkdir()
    sizes = [3, 300, 40, 120]
    start = 0
    for at, size in enumerate(sizes):
        lines = "".join(f"s,day0,09:30,{n}\n" for n in range(start, start + size))
        (folder / f"part {at}.csv").write_text("subject_id,date,time,hr\n" + lines)
        start += size
    spark.conf.set("spark.sql.files.maxPartitionBytes", 500)
    try:
        df = read_minutes(spark, folder)
        assert [int(r.hr) for r in df.orderBy("src_order").collect()] == list(range(start))
        assert dict(df.dtypes)["src_order"] == "bigint"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("most", [0, 64_000_000])
def test_row_order_is_one_number_however_many_files(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr("pulsegrid.sources.tables._MOST_RANK_CHARS", most)
    for at in range(5):
        (tmp_path / f"{at}.csv").write_text("subject_id,date,time,hr\n" + f"s,day0,09:30,{at}0\ns,day0,09:30,{at}1\n")
    df = read_minutes(spark, tmp_path)
    assert dict(df.dtypes)["src_order"] == "bigint"
    assert [r.hr for r in df.orderBy("src_order").collect()] == [f"{a}{b}" for a in range(5) for b in range(2)]


def test_an_offset_that_does_not_fit_raises(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pulsegrid.sources.tables._ORDER_BITS", 3)
    for at in range(4):
        (tmp_path / f"{at}.csv").write_text("subject_id,date,time,hr\n" + "s,day0,09:30,1\n" * 5)
    with pytest.raises(Exception, match="too long for 4 files"):
        read_minutes(spark, tmp_path).collect()


HEADERS = ("subject_id,date,time,hr", "date,Subject_ID, time,hr", "hr,time,date,subject_id")


def _layouts(tmp_path):
    cells = {"subject_id": "s", "date": "day1", "time": "09:30"}
    for at, header in enumerate(HEADERS):
        names = [c.strip().lower() for c in header.split(",")]
        lines = [",".join({**cells, "hr": f"{at}{k}"}[c] for c in names) for k in range(9)]
        (tmp_path / f"{at} of {len(HEADERS)} [x].csv").write_text(header + "\n" + "\n".join(lines) + "\n")


def test_csv_files_of_another_column_order_are_read_by_name(spark, tmp_path):
    _layouts(tmp_path)
    df = read_minutes(spark, tmp_path)
    assert [(r.subject_id, r.date, r.time, r.hr) for r in df.orderBy("src_order").collect()] == [
        ("s", "day1", "09:30", f"{a}{k}") for a in range(len(HEADERS)) for k in range(9)
    ]
    assert rows(read_minutes(spark, tmp_path, ordered=False), "hr", "date")[0] == ("00", "day1")


@pytest.mark.parametrize("layout", ["lines", "records"])
def test_another_column_order_is_an_error_where_one_header_was_promised(spark, tmp_path, layout):
    _layouts(tmp_path)
    with pytest.raises(Exception, match="header"):
        read_minutes(spark, tmp_path, ordered=False, layout=layout).collect()
    with pytest.raises(Exception, match="header"):
        read_minutes(spark, tmp_path, ordered=False, layout=layout).select("subject_id", "hr").collect()


def test_files_with_other_columns_are_an_error(spark, tmp_path):
    (tmp_path / "0.csv").write_text("subject_id,date,time,hr\ns,day1,09:30,1\n")
    (tmp_path / "1.csv").write_text("subject_id,date,time\ns,day1,09:30\n")
    with pytest.raises(ValueError, match="other columns"):
        read_minutes(spark, tmp_path)


ODD = [
    ("s\n2", "day0", "09:30", "1"), ('a,"b"', "day0", "09:31", "2"), ("s", "day0", "09:32", "3\n4,5,6\n"), ("s", "day0", "09:33", '"'),
    ("s", "day1", "09:34", None), ("\n\n", "day1,x", None, "5"), ("last", "day1", "09:36", "6"),
]


def _text(cells):
    quoted = ['"' + c.replace('"', '""') + '"' if c and any(x in c for x in '\n,"') else c or "" for c in cells]
    return ",".join(quoted) + "\n"


@pytest.mark.parametrize("layout", ["scan", "records"])
def test_rows_over_several_lines_are_whole_and_in_order(spark, tmp_path, layout):
    plain = [("p", "day0", "09:30", str(k)) for k in range(300)]
    header = "subject_id,date,time,hr\n"
    (tmp_path / "a.csv").write_text(header + "".join(map(_text, plain)))
    (tmp_path / "b.csv").write_text(header + "".join(map(_text, ODD * 20)))
    (tmp_path / "c.csv").write_text(header + "".join(map(_text, plain[:7])))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 300)
    try:
        df = read_minutes(spark, tmp_path, layout=layout)
        found = [tuple(r)[:4] for r in df.select("subject_id", "date", "time", "hr", "src_order").orderBy("src_order").collect()]
        tasks = df.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == plain + ODD * 20 + plain[:7]
    assert (tasks > 10) == (layout == "scan")  # files without such rows stay split


@pytest.mark.parametrize("layout", ["scan", "lines", "records"])
def test_a_row_with_too_many_cells_is_an_error(spark, tmp_path, layout):
    (tmp_path / "good.csv").write_text("subject_id,date,time,hr\ns,day0,09:30,1\nshort,day0\n\n")
    assert rows(read_minutes(spark, tmp_path, layout=layout), "subject_id", "hr") == [("s", "1"), ("short", None)]
    (tmp_path / "long.csv").write_text('subject_id,date,time,hr\n"a,b",day0,09:30,1\ns,day0,09:30,1,EXTRA\n')
    for columns in (["subject_id"], ["subject_id", "date", "time", "hr"]):
        with pytest.raises(Exception, match="more cells than the header in .*long.csv.*EXTRA"):
            read_minutes(spark, tmp_path, layout=layout).select(*columns).collect()
    with pytest.raises(Exception, match="more cells than the header in .*long.csv"):
        read_minutes(spark, tmp_path, layout=layout).count()


def test_an_unknown_layout_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("subject_id,date,time,hr\n")
    with pytest.raises(ValueError, match="layout"):
        read_minutes(spark, tmp_path, layout="rows")


def test_written_cells_may_hold_line_ends(spark, tmp_path):
    df = spark.createDataFrame(ODD, "subject_id string, date string, time string, hr string")
    assert rows(write_table(df, tmp_path / "t", "csv")) == rows(df) == rows(read_minutes(spark, tmp_path / "t", ordered=False))


def test_parquet_row_order(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    spark.range(100).selectExpr(
        "'s' as subject_id", "'day0' as date", "'09:30' as time", "cast(id as string) as hr"
    ).coalesce(1).write.parquet(path)
    df = read_minutes(spark, path, "parquet")
    assert [int(r.hr) for r in df.orderBy("src_order").collect()] == list(range(100))


def test_a_carried_order_survives_csv(spark, tmp_path):
    df = spark.createDataFrame([(30, "s", "day0", "09:30", "1"), (4, "s", "day0", "09:30", "2")],
                               "src_order long, subject_id string, date string, time string, hr string")
    write_table(df, tmp_path / "t", "csv")
    back = read_minutes(spark, tmp_path / "t")
    assert dict(back.dtypes)["src_order"] == "bigint"
    assert [r.hr for r in back.orderBy("src_order").collect()] == ["2", "1"]


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_written_tables_are_read_back_typed(spark, tmp_path, fmt):
    df = spark.createDataFrame([("a", 1, 0.5, True), (None, None, None, None)], "s string, n long, x double, b boolean")
    for _ in range(2):
        back = write_table(df, tmp_path / "t", fmt)
    assert back.schema == df.schema
    assert rows(back) == rows(df)
