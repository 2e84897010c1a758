"""One pass over the minutes that yields every daily fact the later steps need.

The rows are first folded per raw day label and hour. The label is read as a number only
after that, once per group instead of once per minute. Worn minutes are bits of a 60-bit
mask, so a repeated minute sets the same bit: an hour of minutes becomes one row before the
shuffle, where a distinct count would send every minute. All buffers of the first level have
a fixed width, which keeps it a hash aggregate, and no group is ever gathered in one place:
every level combines on the map side, so a subject or a day with a third of all rows
arrives as a handful of partial rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import Outliers
from pulsegrid.functions.clock import day_index, is_time, minute_guess, minute_of_day
from pulsegrid.functions.heart_rate import has_reading, is_worn, too_high, too_low
from pulsegrid.sources.tables import SRC_ORDER, as_digits, as_number


def _no_rows_no_day(rows: Column) -> Column:
    """The day of the label, for groups with rows that count.

    Mentioning the row count keeps the optimiser from moving the test for a valid day, and
    with it the parsing of the label, below the first aggregate.
    """
    return F.when(rows > 0, day_index(F.col("date")))


def recorded_by_day(minutes: DataFrame, short: bool = True, copies: str | None = None) -> DataFrame:
    """subject_id, day_index, recorded_minutes: rows with a reading other than 0, copies included.

    Rows without a subject are left out. ``copies`` names a column that holds how many raw
    rows a row stands for. With ``short``, times may lack seconds.
    """
    counts = F.when(
        is_time(F.col("time"), short) & has_reading(as_number(minutes, "hr")),
        F.col(copies) if copies else F.lit(1),
    ).cast("bigint")
    by_label = (
        minutes.select("subject_id", "date", counts.alias("n"))
        .groupBy("subject_id", "date")
        .agg(F.sum("n").alias("n"))
    )
    return (
        by_label.withColumn("day_index", _no_rows_no_day(F.col("n")))
        .where(F.col("day_index").isNotNull() & F.col("subject_id").isNotNull())
        .groupBy("subject_id", "day_index")
        .agg(F.sum("n").alias("recorded_minutes"))
    )


def readings_by_day(minutes: DataFrame) -> DataFrame:
    """subject_id, day_index, daily_mean, daily_max, daily_min of the readings above 0.

    The time of day is not looked at, and repeated minutes count as often as they occur.
    """
    hr = F.col("x")
    parsed = minutes.select("subject_id", "date", as_number(minutes, "hr").alias("hr_num"))
    by_label = (
        parsed.select("subject_id", "date", F.when(is_worn(F.col("hr_num")), F.col("hr_num")).alias("x"))
        .groupBy("subject_id", "date")
        .agg(F.sum(hr).alias("total"), F.count(hr).alias("n"), F.max(hr).alias("high"), F.min(hr).alias("low"))
    )
    return (
        by_label.withColumn("day_index", _no_rows_no_day(F.col("n")))
        .where(F.col("day_index").isNotNull() & F.col("subject_id").isNotNull())
        .groupBy("subject_id", "day_index")
        .agg(
            (F.sum("total") / F.sum("n")).alias("daily_mean"),
            F.max("high").alias("daily_max"),
            F.min("low").alias("daily_min"),
        )
    )


def day_facts(
    minutes: DataFrame,
    order: str | None = SRC_ORDER,
    short: bool = True,
    copies: str | None = None,
    outliers: Outliers | None = None,
) -> DataFrame:
    """All facts of each subject-day; the optimiser drops those nobody asks for.

    The first group describes the rows as given, the second what is left of them once
    ``outliers`` are zeroed or dropped. A row is timed when its day and time are valid; with
    ``short``, times may lack seconds.

    rows, too_low, too_high   all rows of the day, and those with a reading out of range
    kept_rows                 timed rows with a reading other than 0
    recorded_minutes          the same, each row counted ``copies`` times

    timed_rows                timed rows
    date                      the first label among them (only with ``order``)
    worn_minutes              distinct minutes with a reading above 0 among them
    hr_n, hr_total, hr_max, hr_min
                              readings above 0, whether or not their time is valid
    """
    # What is read more than once is made in a select before, so that it is computed once.
    cells = minutes.select(
        "subject_id",
        "date",
        "time",
        "hr",
        minute_guess(F.col("time")).alias("guess"),
        as_digits(minutes, "hr").alias("digits"),
        (F.col(order) if order else F.lit(None).cast("bigint")).alias("row_order"),
        (F.col(copies) if copies else F.lit(1)).cast("bigint").alias("copies"),
    )
    parsed = cells.select(
        "subject_id",
        "date",
        minute_of_day(F.col("time"), short, F.col("guess")).alias("minute"),
        as_number(cells, "hr", "digits").alias("hr_num"),
        "row_order",
        "copies",
    )
    minute, hr = F.col("minute"), F.col("hr_num")
    timed = minute.isNotNull()
    low = high = F.lit(False)
    left, clean = timed, hr
    if outliers:
        low, high = too_low(hr, outliers.min_hr), too_high(hr, outliers.max_hr)
        clean = F.when(~(low | high), hr)
        if outliers.mode == "drop":
            left = timed & clean.isNotNull()
    worn_bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), minute % 60)
    rows = parsed.select(
        "subject_id",
        "date",
        F.expr("minute div 60").cast("int").alias("hour"),
        F.when(low, 1).alias("low"),
        F.when(high, 1).alias("high"),
        F.when(timed & has_reading(hr), F.col("copies")).alias("recorded"),
        F.when(left, 1).alias("timed"),
        F.when(left, F.col("row_order")).alias("seen_at"),
        F.when(timed & is_worn(clean), worn_bit).alias("bit"),
        F.when(is_worn(clean), hr).alias("x"),
    )
    by_label_hour = rows.groupBy("subject_id", "date", "hour").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("low").alias("too_low"),
        F.count("high").alias("too_high"),
        F.count("recorded").alias("kept_rows"),
        F.sum("recorded").alias("recorded_minutes"),
        F.count("timed").alias("timed_rows"),
        F.min("seen_at").alias("seen_at"),
        F.bit_or("bit").alias("bits"),
        F.count("x").alias("hr_n"),
        F.sum("x").alias("hr_total"),
        F.max("x").alias("hr_max"),
        F.min("x").alias("hr_min"),
    )
    # From here on a subject-day is at most 25 rows per spelling of its label, so both
    # remaining levels can share one partitioning.
    sums = ["rows", "too_low", "too_high", "kept_rows", "recorded_minutes", "timed_rows", "hr_n", "hr_total"]
    by_hour = (
        by_label_hour.withColumn("day_index", _no_rows_no_day(F.col("rows")))
        .where(F.col("day_index").isNotNull())
        .repartition("subject_id", "day_index")
        .groupBy("subject_id", "day_index", "hour")
        .agg(
            *[F.sum(name).alias(name) for name in sums],
            F.min(F.when(F.col("seen_at").isNotNull(), F.struct("seen_at", "date"))).alias("first"),
            F.bit_or("bits").alias("bits"),
            F.max("hr_max").alias("hr_max"),
            F.min("hr_min").alias("hr_min"),
        )
    )
    zero = F.lit(0).cast("bigint")
    return by_hour.groupBy("subject_id", "day_index").agg(
        F.min("first").getField("date").alias("date"),
        F.coalesce(F.sum(F.bit_count("bits")), zero).alias("worn_minutes"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums],
        F.max("hr_max").alias("hr_max"),
        F.min("hr_min").alias("hr_min"),
    )


def observed_days(minutes: DataFrame, order: str | None = SRC_ORDER, short: bool = True) -> DataFrame:
    """subject_id, day_index, date, worn_minutes of the days with at least one timed row."""
    return timed_days(day_facts(minutes, order, short))


def timed_days(facts: DataFrame) -> DataFrame:
    return facts.where(F.col("timed_rows") > 0).select("subject_id", "day_index", "date", "worn_minutes")


def recorded_days(facts: DataFrame) -> DataFrame:
    """The result of recorded_by_day, from facts that are already there."""
    return facts.where((F.col("recorded_minutes") > 0) & F.col("subject_id").isNotNull()).select(
        "subject_id", "day_index", "recorded_minutes"
    )


def kept_days(facts: DataFrame) -> DataFrame:
    """subject_id, day_index with the rows kept and removed by the dedup before the facts."""
    return facts.where(F.col("kept_rows") > 0).select(
        "subject_id",
        "day_index",
        F.col("kept_rows").alias("kept"),
        (F.col("recorded_minutes") - F.col("kept_rows")).alias("removed"),
    )


def reading_days(facts: DataFrame) -> DataFrame:
    """The result of readings_by_day, from facts that are already there."""
    return facts.where((F.col("hr_n") > 0) & F.col("subject_id").isNotNull()).select(
        "subject_id",
        "day_index",
        (F.col("hr_total") / F.col("hr_n")).alias("daily_mean"),
        F.col("hr_max").alias("daily_max"),
        F.col("hr_min").alias("daily_min"),
    )
