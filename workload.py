"""Wearable tables derived from the driver's tables, for the queries, the tests and the bench.

Five inputs are made, each from whole tables:
sparse  dirty minute rows from events
odd     minute rows from events in every spelling that the parsers take or refuse, first day above 0, days below 0
dense   full days of minutes from supplier: every supplier, 14 days, every minute, one in 97 of them twice
long    years of days from lineitem, with runs over the borders of day blocks, and days listed twice
daily   four metric tables and a key table from orders, lineitem and events

Each is stated twice, for Spark and as the text that the check engine runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.functions.text import null_texts
from pulsegrid.sources.tables import SRC_ORDER

DAYS = 14


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _without_null_texts(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c) if c == SRC_ORDER else null_texts(F.col(c)).alias(c) for c in df.columns])


# One text for both engines; {text} is the string type, {days} the days since 2024.
_SPARSE = """
select event_id as src_order,
       case when user_id = 7 then 'NA'
            else concat('subject.', lpad(cast(user_id as {text}), 4, '0')) end as subject_id,
       concat(case when event_type = 'view' then 'Day' else 'day' end, cast({days} as {text})) as date,
       case when event_type = 'error'
              then concat(lpad(cast(hour(ts) as {text}), 2, '0'), ':',
                          lpad(cast(minute(ts) - minute(ts) % 30 as {text}), 2, '0'))
            when event_id % 97 = 0 then '25:61:00'
            else concat(lpad(cast(hour(ts) as {text}), 2, '0'), ':',
                        lpad(cast(minute(ts) - minute(ts) % 30 as {text}), 2, '0'), ':00') end as time,
       case when event_id % 53 = 0 then 'NA'
            when event_id % 59 = 0 then '0'
            when event_id % 61 = 0 then '-5'
            when event_id % 67 = 0 then '72d'
            else cast(cast(floor(value) as bigint) as {text}) end as hr
from {events}"""


def sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = _SPARSE.replace("{text}", "string").replace("{days}", "datediff(cast(ts as date), date'2024-01-01')")
    return _without_null_texts(spark.sql(query, events=table(spark, sf_dir, "events")))


# The same for both engines: subjects with line ends, quotes and commas in them.
ODD_SUBJECT = """case when src_order % 11 = 0 then subject_id || chr(10) || '"a", ' || time || chr(10) || chr(10)
when src_order % 13 = 0 then subject_id || ',' when src_order % 17 = 0 then '"' || subject_id else subject_id end"""


# {tab} is a tab; every twelfth label, seventh time and thirteenth reading is spelled in one odd way.
_ODD = """
select event_id as src_order, concat('s', cast(user_id % 20 as {text})) as subject_id,
       case event_id % 12 when 0 then concat('  Day', cast({days} + 3 as {text}), '{tab}')
                          when 1 then concat('DAY', cast({days} + 3 as {text}))
                          when 2 then concat('day', cast({days} + 3 as {text}), '.0')
                          when 3 then concat('day-', cast(1 + {days} % 3 as {text}))
                          when 4 then concat('day', cast({days} + 3 as {text}), '.5')
                          when 5 then concat('day ', cast({days} + 3 as {text}), 'e0')
                          when 6 then concat('da', cast({days} as {text}))
                          else concat('day', cast({days} + 3 as {text})) end as date,
       case event_id % 7 when 0 then concat(' ', lpad(cast(hour(ts) as {text}), 2, '0'), ':30 ')
                         when 1 then concat(cast(hour(ts) as {text}), ':5:7')
                         when 2 then '24:00:00'
                         else concat(lpad(cast(hour(ts) as {text}), 2, '0'), ':30:00') end as time,
       case event_id % 13 when 0 then '1e2' when 1 then 'inf' when 2 then ' 80 ' when 3 then '+90' when 4 then '.5e2'
                          when 5 then '72d' when 6 then '-Infinity' when 7 then '0x1p3' when 8 then '-0'
                          else cast(cast(floor(value) as bigint) as {text}) end as hr
from {events}"""

_LONG = """
select subject_id, day_index, concat('day', cast(day_index as {text})) as date, is_valid_day
from (select concat('s', cast(l_suppkey % 8 as {text})) as subject_id, {days} as day_index,
             max(l_quantity) > 1 as is_valid_day
      from {lineitem} group by 1, 2) as days
where day_index % 611 <> 7
union all
select concat('s', cast(l_suppkey % 8 as {text})), {days}, 'again', true
from {lineitem} where {days} % 389 = 5 group by 1, 2"""


def odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = "datediff(cast(ts as date), date'2024-01-01')"
    query = _ODD.replace("{text}", "string").replace("{days}", days).replace("{tab}", "\t")
    return _without_null_texts(spark.sql(query, events=table(spark, sf_dir, "events")))


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = "cast(datediff(cast(l_shipdate as date), date'1992-01-01') as bigint)"
    query = _LONG.replace("{text}", "string").replace("{days}", days)
    return spark.sql(query, lineitem=table(spark, sf_dir, "lineitem"))


def dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, d, m, c = F.col("s_suppkey"), F.col("d"), F.col("m"), F.col("c")
    subjects = table(spark, sf_dir, "supplier").select("s_suppkey")
    # Tasks of some 2.5 million minutes, as a folder's splits would be: their hours fit the first level of a hash aggregate.
    tasks = max(spark.sparkContext.defaultParallelism * 2, subjects.count() // 125)
    on = F.when((k * 5 + d * 3) % 13 < 2, (m * 7 + d) % 100 < 60).otherwise((m * 7 + d) % 100 < 95)
    # What holds for a whole subject or day is made once there, and the texts of a day's minutes once for all.
    times = F.split(F.lit(",".join(f"{minute // 60:02d}:{minute % 60:02d}:00" for minute in range(1440))), ",")
    # Every minute once, then one in 97 again: the place tells which.
    again = F.sequence(F.pmod(-(k + d), F.lit(97)).cast("int"), F.lit(1439), F.lit(97))
    minutes = F.concat(F.sequence(F.lit(0), F.lit(1439)), F.coalesce(again, F.array().cast("array<int>")))
    rows = (
        subjects.repartition(tasks, "s_suppkey")
        .withColumn("subject_id", F.concat(F.lit("subject."), F.lpad(k.cast("string"), 4, "0")))
        .withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(DAYS - 1))))
        .withColumn("date", F.when(~((k % 4 == 1) & d.isin(5, 6)), F.concat(F.lit("day"), d.cast("string"))))
        .select("*", F.posexplode(minutes).alias("place", "m"))
        .withColumn("c", (F.col("place") >= 1440).cast("int"))
    )
    return rows.select(
        (((k * DAYS + d) * 1440 + m) * 2 + c).alias("src_order"),
        "subject_id",
        "date",
        F.get(times, m).alias("time"),
        F.when(on, (50 + (k * 31 + d * 17 + m * 7 + c * 5) % 130).cast("string")).otherwise(F.lit("0")).alias("hr"),
    )


_DENSE = """
select ((k * 14 + d) * 1440 + m) * 2 + c as src_order,
       'subject.' || lpad(cast(k as varchar), 4, '0') as subject_id,
       case when not (k % 4 = 1 and d in (5, 6)) then 'day' || cast(d as varchar) end as date,
       lpad(cast(m // 60 as varchar), 2, '0') || ':' || lpad(cast(m % 60 as varchar), 2, '0') || ':00' as time,
       case when case when (k * 5 + d * 3) % 13 < 2 then (m * 7 + d) % 100 < 60 else (m * 7 + d) % 100 < 95 end
            then cast(50 + (k * 31 + d * 17 + m * 7 + c * 5) % 130 as varchar) else '0' end as hr
from (select s_suppkey as k, d, m, c
      from supplier, unnest(range(0, 14)) as days(d), unnest(range(0, 1440)) as minutes(m), unnest(range(0, 2)) as copies(c)
      where c = 0 or (s_suppkey + d + m) % 97 = 0)"""


# {subject} pads a number, {quarter} numbers a date's 90-day period since 1995.
_DAILY = {
    "keys": """
select {subject o_custkey} as subject_id,
       case when o_orderpriority <> '5-LOW' then concat('day', cast({quarter o_orderdate} as {text})) end as date,
       case o_orderstatus when 'O' then 'True' when 'P' then '1' else 'False' end as is_valid_day
from {orders}""",
    "activity": """
select o_orderkey as src_order, {subject o_custkey} as subject_id,
       concat('day', cast({quarter o_orderdate} as {text})) as date,
       case when o_orderpriority = '1-URGENT' then 'NA' when o_orderpriority = '2-HIGH' then 'x'
            else cast(cast(floor(o_totalprice / 20) as bigint) as {text}) end as steps,
       case when o_orderstatus = 'P' then 'NA'
            else cast(cast(floor(o_totalprice / 7) as bigint) as {text}) end as distance
from {orders}""",
    "resting": """
select {subject l_suppkey} as subject_id,
       case when l_returnflag = 'A' and l_linenumber > 5 then 'NA'
            else concat('day', cast({quarter l_shipdate} as {text})) end as date,
       case when l_returnflag = 'R' then 'NA' else cast(40 + cast(l_quantity as bigint) as {text}) end as resting_hr
from {lineitem}""",
    "daily_hr": """
select {subject o_custkey} as subject_id, concat('day', cast({quarter o_orderdate} as {text})) as date,
       cast(60 + o_orderkey % 40 as {text}) as daily_mean,
       case when o_orderpriority = '3-MEDIUM' then 'null' else cast(100 + o_orderkey % 60 as {text}) end as daily_max,
       cast(40 + o_orderkey % 20 as {text}) as daily_min
from {orders}""",
    "sleep": """
select {subject user_id} as subject_id, concat('day', cast({days} as {text})) as date,
       cast(cast(floor(value) as bigint) as {text}) as total_minutes_asleep,
       case when event_type = 'click' then '' else cast(300 + event_id % 200 as {text}) end as total_time_in_bed,
       case when event_type = 'view' then 'none' else cast(event_id % 9 as {text}) end as cnt_wake
from {events}""",
}


def _daily_text(name: str, spark_side: bool) -> str:
    text = _DAILY[name]
    for column in ("o_custkey", "l_suppkey", "user_id"):
        text = text.replace(f"{{subject {column}}}", f"concat('subject.', lpad(cast({column} as {{text}}), 5, '0'))")
    for column in ("o_orderdate", "l_shipdate"):
        days = (
            f"datediff(cast({column} as date), date'1995-01-01') div 90"
            if spark_side
            else f"date_diff('day', date '1995-01-01', cast({column} as date)) // 90"
        )
        text = text.replace(f"{{quarter {column}}}", days)
    days = (
        "datediff(cast(ts as date), date'2024-01-01')"
        if spark_side
        else "date_diff('day', date '2024-01-01', cast(ts as date))"
    )
    return text.replace("{days}", days).replace("{text}", "string" if spark_side else "varchar")


def daily(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source = next(t for t in ("orders", "lineitem", "events") if f"{{{t}}}" in _DAILY[name])
    query = _daily_text(name, spark_side=True)
    return _without_null_texts(spark.sql(query, **{source: table(spark, sf_dir, source)}))


def _null(column: str) -> str:
    return f"case when {column} not in ('', 'NA', 'null') then {column} end as {column}"


def sparse_sql() -> str:
    raw = _SPARSE.replace("{text}", "varchar").replace("{events}", "events")
    raw = raw.replace("{days}", "date_diff('day', date '2024-01-01', cast(ts as date))")
    return f"select src_order, {', '.join(map(_null, ('subject_id', 'date', 'time', 'hr')))} from ({raw})"


def odd_sql() -> str:
    raw = _ODD.replace("{text}", "varchar").replace("{events}", "events").replace("{tab}", "\t")
    raw = raw.replace("{days}", "date_diff('day', date '2024-01-01', cast(ts as date))")
    return f"select src_order, {', '.join(map(_null, ('subject_id', 'date', 'time', 'hr')))} from ({raw})"


def long_sql() -> str:
    days = "date_diff('day', date '1992-01-01', cast(l_shipdate as date))"
    return _LONG.replace("{text}", "varchar").replace("{days}", days).replace("{lineitem}", "lineitem")


def dense_sql() -> str:
    return _DENSE


def daily_sql(name: str) -> str:
    raw = _daily_text(name, spark_side=False)
    for source in ("orders", "lineitem", "events"):
        raw = raw.replace(f"{{{source}}}", source)
    columns = {
        "keys": ("subject_id", "date", "is_valid_day"),
        "activity": ("subject_id", "date", "steps", "distance"),
        "resting": ("subject_id", "date", "resting_hr"),
        "daily_hr": ("subject_id", "date", "daily_mean", "daily_max", "daily_min"),
        "sleep": ("subject_id", "date", "total_minutes_asleep", "total_time_in_bed", "cnt_wake"),
    }[name]
    order = "src_order, " if name == "activity" else ""
    return f"select {order}{', '.join(map(_null, columns))} from ({raw})"
