"""How daily compliance is spread: statistics and a histogram."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import HISTOGRAM_BINS


def value_counts(daily: DataFrame, value: str = "compliance") -> DataFrame:
    """value, n. A day has at most 1,440 distinct minutes, so this holds at most 1,441 rows."""
    return daily.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def compliance_totals(counts: DataFrame, threshold_ratio: float) -> DataFrame:
    """One row with the days, mean, median, days without wear, and the reference ratio."""
    value, n = F.col("value"), F.col("n")
    zero = F.lit(0).cast("bigint")
    return counts.agg(
        F.coalesce(F.sum("n"), zero).alias("n_days"),
        F.try_divide(F.sum(value * n), F.sum("n")).alias("mean_compliance"),
        F.percentile(value, 0.5, n).alias("median_compliance"),
        F.coalesce(F.sum(F.when(value == 0, n)), zero).alias("zero_days"),
        F.lit(float(threshold_ratio)).alias("threshold_ratio"),
    )


def _edge(place: Column, low: Column, high: Column, bins: int) -> Column:
    step = (high - low) / F.lit(float(bins))
    return F.when(place == bins, high).otherwise(low + place.cast("double") * step)


def histogram(counts: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """bin, lo, hi, n of equal-width bins between the smallest and largest value.

    The last bin is closed. A value that rounding puts on the wrong side of an edge is moved to
    the bin whose edges hold it. When all values are equal the range is widened by a half on
    both sides. Without values there are no rows.
    """
    ends = counts.agg(F.struct(F.min("value").alias("low"), F.max("value").alias("high")).alias("ends")).scalar()
    flat = F.col("ends.low") == F.col("ends.high")
    low = F.when(flat, F.col("ends.low") - 0.5).otherwise(F.col("ends.low"))
    high = F.when(flat, F.col("ends.high") + 0.5).otherwise(F.col("ends.high"))
    value, place = F.col("value"), F.col("bin")
    guess = F.least(F.floor((value - F.col("low")) / (F.col("high") - F.col("low")) * bins), F.lit(bins - 1))
    at = _edge(place, F.col("low"), F.col("high"), bins)
    after = _edge(place + 1, F.col("low"), F.col("high"), bins)
    shift = F.when(value < at, -1).when((place < bins - 1) & (value >= after), 1).otherwise(0)
    placed = (
        counts.withColumn("ends", ends)
        .select("value", "n", low.alias("low"), high.alias("high"))
        .withColumn("bin", guess.cast("bigint"))
        .select((place + shift).alias("bin"), "n")
    )
    spark = counts.sparkSession
    empty = spark.range(bins).select(F.col("id").alias("bin"), F.lit(0).cast("bigint").alias("n"))
    return (
        placed.unionByName(empty)
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
        .withColumn("ends", ends)
        .where(F.col("ends.low").isNotNull())
        .select(place, low.alias("low"), high.alias("high"), "n")
        .select(place, at.alias("lo"), after.alias("hi"), "n")
    )
