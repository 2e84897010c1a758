"""Token sequences in training order: fixed-stride binary shards under a keyed permutation.

1. Every task joins its documents' ids, each closed by the closing id, and cuts the stream into
   sequences of ``size`` ids; the last one of a task is padded. They are compressed one by one and stored
   beside the shards, so that what follows reads the same rows however often a task is repeated.
2. A sequence's index is its row in its file plus the rows of all files before: dense from 0.
3. ``Permutation`` sends the index to its slot: a Feistel network over the next power of four,
   walked on until it falls below the number of sequences. It is a bijection, needs no state,
   and can be run backwards.
4. Slot s goes to shard s // per_shard. A task takes a range of slots, ``SHARDS_PER_TASK`` shards, sorts its
   rows by slot and writes one shard after another. The shards are written in ``PASSES`` passes, each
   of which shuffles its part of the compressed sequences, so that the disk never holds all twice.

A record has one fixed length: ``size`` ids as little-endian unsigned 16-bit numbers and a
newline, so record r of a shard starts at byte r * stride. Spark's text sink writes the bytes as
they are, commits whole files only, and knows every store that Spark knows. With ``resume``, a job
goes on where another one died: finished sequences are read again, and shards that have their full
length are left alone. Tasks open and check sequences some hundred at a time.

Null and empty texts give the closing id alone. Rows with the same doc_id are written each;
other columns are left out. An empty table gives no shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.byte_tokens import ByteEncoder
from pulsegrid.llm.frames import only
from pulsegrid.llm.settings import held, shuffles_removed, small_batches
from pulsegrid.llm.words import mix
from pulsegrid.sources.settle import settle

SIZE = 2048
PER_SHARD = 2048
CLOSING_ID = 0
KEY = 20_240_607
#: Rows of the table of files that may be broadcast; it has about 100 bytes a row.
MOST_FILES = 100_000
#: Shards that one task writes, passes in which all are written, sequences that a task opens at once.
SHARDS_PER_TASK, PASSES, AT_ONCE = 8, 4, 256
OPEN_SHARDS = "spark.sql.maxConcurrentOutputFileWriters"
SEQUENCES = "packed binary, n_ids int, parts array<struct<doc_id: long, start: long, offset: int, length: int>>"


class Permutation:
    """A keyed bijection of 0..n-1 onto itself."""

    ROUNDS = 4

    def __init__(self, n: int, key: int):
        self.n, self.key = n, key
        self.half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)

    def _round(self, value: np.ndarray, number: int) -> np.ndarray:
        salt = ((self.key << 8) + number) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
        return mix(value ^ np.uint64(salt)) & self.mask

    def _once(self, x: np.ndarray, back: bool) -> np.ndarray:
        shift = np.uint64(self.half)
        left, right = x >> shift, x & self.mask
        for number in range(self.ROUNDS):
            if back:
                left, right = right ^ self._round(left, self.ROUNDS - 1 - number), left
            else:
                left, right = right, left ^ self._round(right, number)
        return left << shift | right

    def _walk(self, values: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(values).astype(np.uint64), back)
        while len(out := np.flatnonzero(x >= np.uint64(self.n))):
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slots(self, indexes: np.ndarray) -> np.ndarray:
        return self._walk(indexes, back=False)

    def indexes(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, back=True)


def sequences(docs: DataFrame, ranks_path: str, size: int = SIZE, closing_id: int = CLOSING_ID) -> DataFrame:
    """The sequences as ``SEQUENCES``: compressed 16-bit ids, how many are no padding, and the documents' parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        encoder, closing = ByteEncoder(ranks_path, 2), closing_id.to_bytes(2, "little")
        made, parts, held, held_ids = [], [], bytearray(), 0

        def flush():
            nonlocal made
            columns = list(zip(*made, strict=True)) or [(), (), ()]
            parts_type = pa.list_(
                pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("offset", pa.int32()), ("length", pa.int32())])
            )
            arrays = [pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int32(), parts_type), strict=True)]
            made = []
            return pa.RecordBatch.from_arrays(arrays, ["packed", "n_ids", "parts"])

        for batch in batches:
            for at in range(batch.num_rows):
                doc = batch.column("doc_id")[at].as_py()
                data, start = encoder.encode(batch.column("text")[at].as_py()) + closing, 0
                n = len(data) // 2
                while start < n:
                    length = min(n - start, size - held_ids)
                    held += data[2 * start : 2 * (start + length)]
                    parts.append({"doc_id": doc, "start": start, "offset": held_ids, "length": length})
                    held_ids, start = held_ids + length, start + length
                    if held_ids == size:
                        made.append((packer.compress(bytes(held)), size, parts))
                        parts, held, held_ids = [], bytearray(), 0
                        if len(made) == AT_ONCE:
                            yield flush()
        if held_ids:
            made.append((packer.compress(bytes(held) + closing * (size - held_ids)), held_ids, parts))
        yield flush()

    return only(docs, ("doc_id", "text"), "documents").mapInArrow(run, SEQUENCES)


def stored(df: DataFrame, path: str, resume: bool = False) -> DataFrame:
    """The frame as a table at the path; with ``resume``, one that was finished there before is taken."""
    spark = df.sparkSession
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not (resume and done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)):
        with small_batches(spark):
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def indexed(table: DataFrame) -> tuple[DataFrame, int]:
    """A stored table with the column ``index``, dense from 0 in the order of its files, and its rows' number."""
    rows = table.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    files = settle(
        rows.groupBy("file").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    total, n_files = files.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    small = F.broadcast(files.drop("n")) if n_files <= MOST_FILES else files.drop("n")
    return rows.join(small, "file").withColumn("index", F.col("before") + F.col("at")).drop("file", "at", "before"), total


def with_slots(rows: DataFrame, total: int, key: int = KEY, per_shard: int = PER_SHARD) -> DataFrame:
    """Adds slot, shard and position (the record's number in its shard)."""

    @F.pandas_udf("long")
    def slot(index):
        import pandas as pd

        return pd.Series(Permutation(max(1, total), key).slots(index.to_numpy()))

    rows = rows.withColumn("slot", slot("index"))
    shard = F.floor(F.col("slot") / per_shard)
    return rows.withColumns({"shard": shard.cast("int"), "position": F.pmod("slot", F.lit(per_shard)).cast("int")})


def stride(size: int = SIZE) -> int:
    return 2 * size + 1


def shard_files(spark: SparkSession, path: str) -> DataFrame:
    """shard, n_bytes and content of every shard that is there; read only the columns you need."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").load(path)
    shard = F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("int")
    return files.select(shard.alias("shard"), F.col("length").alias("n_bytes"), "content")


def write_shards(
    rows: DataFrame, total: int, path: str, size: int = SIZE, per_shard: int = PER_SHARD, resume: bool = False, passes: int = PASSES
) -> None:
    """Writes the shards of rows with packed, slot and shard. With ``resume``, only those that lack."""
    spark = rows.sparkSession
    n_shards = max(1, -(-total // per_shard))
    rows = rows.select("packed", "slot", "shard")
    if resume:
        expected = F.when(F.col("shard") == n_shards - 1, total - (n_shards - 1) * per_shard).otherwise(per_shard)
        done = shard_files(spark, path).where(F.col("n_bytes") == expected * stride(size)).select("shard")
        rows = rows.join(done, "shard", "left_anti").select("packed", "slot", "shard")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(at, AT_ONCE)
                ids = pa.array([opener.decompress(x.as_buffer()) for x in part.column("packed")], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, part.column("shard")], ["record", "shard"])

    tasks = -(-n_shards // SHARDS_PER_TASK)
    step = -(-tasks // passes) * SHARDS_PER_TASK
    # A task's shards come one after another, so it may hold all of them open instead of sorting them once more.
    with shuffles_removed(spark), small_batches(spark), held(spark, {OPEN_SHARDS: str(SHARDS_PER_TASK + 1)}):
        for first in range(0, n_shards, step):
            part = rows.where(F.col("shard").between(first, first + step - 1))
            task = F.floor((F.col("shard") - first) / SHARDS_PER_TASK).cast("int")
            dealt = part.repartitionById(min(tasks, step // SHARDS_PER_TASK), task).sortWithinPartitions("slot")
            out = dealt.mapInArrow(records, "record binary, shard int").select(F.col("record").cast("string"), "shard")
            out.write.mode("append").partitionBy("shard").option("lineSep", "\n").text(path)


def _whole_records(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[tuple[int, memoryview, int]]:
    """(shard, content, its records' number) of all shards, one at a time."""
    for batch in batches:
        for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
            data = memoryview(content.as_buffer())
            if len(data) % step:
                raise ValueError(f"shard {shard} holds {len(data)} bytes, no multiple of {step}")
            yield shard, data, len(data) // step


def read_records(spark: SparkSession, path: str, size: int = SIZE, per_shard: int = PER_SHARD, first_slot: int = 0) -> DataFrame:
    """slot and ids of all records from a slot on, as a resumed reader meets them."""
    step = stride(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, data, n in _whole_records(batches, step):
            for at in range(max(0, first_slot - shard * per_shard), n, AT_ONCE):
                numbers = range(at, min(at + AT_ONCE, n))
                ids = pa.array([bytes(data[k * step : (k + 1) * step - 1]) for k in numbers], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([shard * per_shard + k for k in numbers], pa.int64()), ids], ["slot", "ids"])

    files = shard_files(spark, path).where(F.col("shard") >= first_slot // per_shard).select("shard", "content")
    return files.mapInArrow(run, "slot long, ids binary")


def record_checksums(spark: SparkSession, path: str, size: int = SIZE, per_shard: int = PER_SHARD) -> DataFrame:
    """slot and ids_crc32 of all records, as read back from their shards."""
    step = stride(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, data, n in _whole_records(batches, step):
            sums = np.array([zlib.crc32(data[k * step : (k + 1) * step - 1]) for k in range(n)], np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(shard * per_shard + np.arange(n)), pa.array(sums)], ["slot", "ids_crc32"])

    files = shard_files(spark, path).select("shard", "content")
    return files.mapInArrow(run, "slot long, ids_crc32 long")


def materialise(
    docs: DataFrame, ranks_path: str, path: str, size: int = SIZE, per_shard: int = PER_SHARD, key: int = KEY, resume: bool = False
) -> DataFrame:
    """Writes the shards and returns a row for each document's part: where it is found.

    doc_id, start (in the document's ids), length, offset (in the sequence), slot, shard, position.
    The sequences stay at the path with ``-sequences`` after it; a job that died goes on with ``resume``.
    """
    rows, total = indexed(stored(sequences(docs, ranks_path, size), f"{path}-sequences", resume))
    placed = with_slots(rows, total, key, per_shard)
    write_shards(placed, total, path, size, per_shard, resume)
    part = placed.select(F.explode("parts").alias("p"), "slot", "shard", "position")
    return part.select("p.doc_id", "p.start", F.col("p.length").cast("long").alias("length"), "p.offset", "slot", "shard", "position")
