"""Session settings that hold for a part of a job only."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS, BATCH_BYTES = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """The settings for all queries that start inside; afterwards what was set before."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def shuffles_removed(spark: SparkSession):
    """Queries that run inside remove their shuffle files at their end, not when the driver collects its garbage.

    For jobs in passes, each of which shuffles about as much as its input and stores its result.
    """
    return held(spark, {CLEANUP: "true"})


def small_batches(spark: SparkSession, rows: int = 1_000, size: str = "8m"):
    """Rows that hold kilobytes each go to Python in batches of a few megabytes: two sides hold each batch."""
    return held(spark, {BATCH_ROWS: str(rows), BATCH_BYTES: size})
