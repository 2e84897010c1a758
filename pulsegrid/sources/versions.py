"""Result folders that are complete or not there: jobs that go on where they died, and sets published at once.

A job's tables lie in a folder of their own, named by what they are made from: its inputs (paths,
sizes and times of their files) and its settings. The same job started again finds the tables that it had
finished; other inputs or settings go to another folder. When all tables are written, one small
file names the folder as the published set. Readers look that file up, so they see the old set or
the new one, and never parts of both.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from pathlib import PurePath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources.tables import write_table

Path = str | PurePath
_PUBLISHED = "published"


class _Store:
    """The few calls to the file system that Spark's readers and writers do not offer."""

    def __init__(self, spark: SparkSession, folder: Path):
        self._jvm, self._at = spark._jvm, str(folder).rstrip("/")
        self._fs = self._path(self._at).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self._at}/{name}"))

    def names(self) -> list[str]:
        here = self._path(self._at)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(here)) if self._fs.exists(here) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self._at}/{name}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Writes a new file, visible at once and whole; false if there is one of that name."""
        draft = self._path(f"{self._at}/.{name}-{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        done = not self.exists(name) and self._fs.rename(draft, self._path(f"{self._at}/{name}"))
        if not done:
            self._fs.delete(draft, False)
        return done


def fingerprint(spark: SparkSession, paths: Iterable[Path | None], *settings: object) -> str:
    """A name for a job: equal as long as its settings and its input files are the same.

    The files are listed by Spark and folded there; their contents are not read.
    """
    seen = hashlib.sha256(repr(settings).encode())
    for path in paths:
        seen.update(f"\n{path}".encode())
        if path is not None:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(path))
            one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
            seen.update(repr(tuple(files.agg(F.count("*"), F.sum(one), F.sum("length")).first())).encode())
    return seen.hexdigest()[:32]


def finished(spark: SparkSession, path: Path) -> bool:
    """Whether a table was written there to its end."""
    return _Store(spark, path).exists("_SUCCESS")


def write_once(df: DataFrame, path: Path, fmt: str = "parquet") -> DataFrame:
    """write_table, unless the table is there already: then it is read, and nothing of df is computed."""
    if not finished(df.sparkSession, path):
        return write_table(df, path, fmt)
    reader = df.sparkSession.read.schema(df.schema)
    return (reader.options(header=True, escape='"', multiLine=True) if fmt == "csv" else reader).format(fmt).load(str(path))


def publish(spark: SparkSession, outdir: Path, version: str) -> int:
    """Makes the folder ``version`` of outdir the set that ``published`` gives. Returns the set's number."""
    store = _Store(spark, f"{str(outdir).rstrip('/')}/{_PUBLISHED}")
    while True:
        number = 1 + max((int(name) for name in store.names() if name.isdigit()), default=0)
        if store.create(f"{number:09d}", version):
            return number


def published(spark: SparkSession, outdir: Path) -> str | None:
    """The folder of the set that was published last, or None."""
    at = str(outdir).rstrip("/")
    store = _Store(spark, f"{at}/{_PUBLISHED}")
    numbers = [name for name in store.names() if name.isdigit()]
    return f"{at}/{store.read(max(numbers))}" if numbers else None
