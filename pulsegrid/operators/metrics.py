"""Daily metric tables: collapsing repeated days, merging sources, counting what is missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.ratio import share
from pulsegrid.sources.tables import SRC_ORDER, as_number, require_columns

# Subject and label as one struct. Unlike two columns under "=", equal nulls in it match, and
# grouping and joining by it share one partitioning.
_DAY = "subject_day"


def _missing(metric: str) -> str:
    return f"{metric}__missing"


def _with_day(df: DataFrame) -> Column:
    return F.struct("subject_id", "date").alias(_DAY)


def collapse_days(
    source: DataFrame, metrics: Sequence[str], collapse: str = "mean", order: str = SRC_ORDER
) -> DataFrame:
    """One row per subject-day: each metric as a DOUBLE, and a flag ``<metric>__missing``.

    Repeated days take the mean or the first value that is a number. A day that occurs once
    is not judged by its value: any text counts as present there, also one that is no number.
    Days that repeat without a subject or a date are dropped. Metrics the source lacks are null.
    """
    require_columns(source, ["subject_id", "date"], "metric table")
    present = [m for m in metrics if m in source.columns]
    absent = [m for m in metrics if m not in source.columns]
    if collapse == "first" and present:
        require_columns(source, [order], "metric table")
    cells = source.select(
        _with_day(source),
        *([order] if collapse == "first" and present else []),
        *[as_number(source, m).alias(m) for m in present],
        *[F.col(m).isNotNull().cast("int").alias(f"{m}__filled") for m in present],
    )
    aggregates = [F.count(F.lit(1)).alias("n")]
    for m in present:
        value = F.avg(m) if collapse == "mean" else F.min_by(m, F.when(F.col(m).isNotNull(), F.col(order)))
        aggregates += [value.alias(m), F.sum(f"{m}__filled").alias(f"{m}__filled")]
    days = cells.groupBy(_DAY).agg(*aggregates)
    if not present:
        days = days.where(F.lit(False))
    known = F.col(f"{_DAY}.subject_id").isNotNull() & F.col(f"{_DAY}.date").isNotNull()
    once = F.col("n") == 1
    by_name = {m: F.col(m) for m in present} | {m: F.lit(None).cast("double").alias(m) for m in absent}
    flags = {
        m: F.when(once, F.col(f"{m}__filled") == 0).otherwise(F.col(m).isNull()).alias(_missing(m)) for m in present
    } | {m: F.lit(True).alias(_missing(m)) for m in absent}
    return days.where(once | known).select(_DAY, *[by_name[m] for m in metrics], *[flags[m] for m in metrics])


def daily_metrics(
    source: DataFrame, metrics: Sequence[str], collapse: str = "mean", order: str = SRC_ORDER
) -> DataFrame:
    """subject_id, date and the metrics of one source, repeated days collapsed."""
    days = collapse_days(source, metrics, collapse, order)
    return days.select(f"{_DAY}.subject_id", f"{_DAY}.date", *metrics)


def merge_metrics(keys: DataFrame, sources: Sequence[DataFrame]) -> DataFrame:
    """The distinct keys with the metrics of each source from collapse_days.

    Labels are compared as text. All inputs are unique per subject-day and partitioned by the
    same struct, so each is shuffled once and no key is hot.
    """
    days = keys.select(_with_day(keys)).distinct()
    return reduce(lambda left, right: left.join(right, _DAY, "left"), sources, days)


def merged_values(merged: DataFrame) -> DataFrame:
    """subject_id, date and the metrics of the merged table, without the flags."""
    metrics = [c for c in merged.columns if c != _DAY and not c.endswith("__missing")]
    return merged.select(f"{_DAY}.subject_id", f"{_DAY}.date", *metrics)


def missing_counts(merged: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """metric, missing_count, missing_rate, total_keys, in the order of ``metrics``.

    One aggregate covers all metrics. A metric that no source has is missing everywhere, at
    a rate of 1 even without any key.
    """
    known = [m for m in dict.fromkeys(metrics) if _missing(m) in merged.columns]
    counts = merged.agg(
        F.count(F.lit(1)).alias("total_keys"),
        *[F.count_if(F.coalesce(_missing(m), F.lit(True))).alias(m) for m in known],
    )
    total = F.col("total_keys")
    rows = [
        F.struct(
            F.lit(place).alias("place"),
            F.lit(m).alias("metric"),
            (F.col(m) if m in known else total).alias("missing_count"),
            (share(F.col(m), total) if m in known else F.lit(1.0)).alias("missing_rate"),
            total.alias("total_keys"),
        )
        for place, m in enumerate(metrics)
    ]
    return counts.select(F.inline(F.array(*rows)))


def first_rows(report: DataFrame, n: int = 10) -> DataFrame:
    return report.orderBy("place").limit(n)
