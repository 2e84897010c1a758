"""Small helpers for frames that the operators share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources.settle import settle
from pulsegrid.sources.tables import require_columns


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, columns: Iterable[str], name: str) -> DataFrame:
    """The named columns alone. Others are left out, so that none of them can clash with a result."""
    columns = list(columns)
    return require_columns(df, columns, name).select(*columns)


def text_fold(column: Column, folds: int) -> Column:
    """crc32 of the value's text, modulo the number of folds; null for null."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds))


def spread(df: DataFrame, rows_per_task: int) -> DataFrame:
    """Deals the rows of a stored frame evenly to as many tasks as their number asks for."""
    return df.repartition(max(1, -(-df.count() // rows_per_task)))


def settle_few(df: DataFrame, tasks: int) -> DataFrame:
    """Settles a table that is small beside the shuffle partitions it comes from, in so many files."""
    return settle(df.coalesce(tasks))


def tasks_for(rows: int, rows_per_task: int, least: int = 8) -> int:
    return max(least, -(-rows // rows_per_task))
