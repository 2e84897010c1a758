"""Computing a frame once when several later plans read it."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# The folder of the job that runs just now in this thread of the driver, the innermost one.
_JOB: ContextVar[str | None] = ContextVar("job", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor reaches, as the session names it."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return folder


def settle(df: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """Writes the frame to the shared folder, at once, and returns it as read back. ``options`` are the Parquet writer's.

    Losing executors later costs nothing: the table is on shared storage. Being columnar,
    it is pruned on every read, and its size is known when a join picks its strategy.
    """
    return settle_all([df], options)


def settle_all(frames: Iterable[DataFrame], options: Mapping[str, str] | None = None) -> DataFrame:
    """Settles frames of one schema, at least one, in one table.

    A frame is asked for when the one before it is stored. So a job in passes, which yields them, holds
    one pass at a time, and its plan does not grow with the passes.
    """
    path = schema = None
    for df in frames:
        if path is None:
            spark, schema = df.sparkSession, df.schema
            path = f"{_JOB.get() or shared_folder(spark)}/settled-{uuid.uuid4().hex}"
        df.write.mode("append").options(**(options or {})).parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def settled_for(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, what was settled inside: use it around a job that has stored its results.

    Frames made inside cannot be read any more afterwards.
    """
    folder = f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"
    before = _JOB.set(folder)
    try:
        yield
    finally:
        _JOB.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
