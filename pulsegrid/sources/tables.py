"""Reading raw tables as text, and writing result tables."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce
from pathlib import PurePath
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulsegrid.functions.text import null_texts, number, truth, whole

SRC_ORDER = "src_order"

_ROW_MASK = (1 << 33) - 1
_ORDER_BITS = 63
# The table of file ranks is broadcast while its paths come to at most so many characters.
_MOST_RANK_CHARS = 64_000_000


def require_columns(df: DataFrame, required: Iterable[str], name: str = "Input") -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}; it has {df.columns}")
    return df


def read_table(
    spark: SparkSession,
    path: str | PurePath,
    fmt: str = "csv",
    required: Iterable[str] = (),
    ordered: bool = False,
    layout: str = "scan",
) -> DataFrame:
    """A raw table with lower-case column names and nulls for the "no value" texts.

    CSV cells stay text. ``layout`` says how CSV files are laid out: see ``csv_files``. ``ordered`` adds ``src_order``, which sorts
    rows as they stand in the file, files by path; a table that has the column keeps its own. It is
    what "first" and "last" mean in the operators.
    """
    path = str(path)
    try:
        raws = csv_files(spark, path, layout) if fmt == "csv" else [spark.read.format(fmt).load(path)]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Input not found: {path}") from error
        raise
    files = sorted(file for raw in raws for file in raw.inputFiles()) if ordered else []
    parts = [_with_order(raw, fmt, files if ordered else None) for raw in raws]
    for part in parts[1:]:
        if sorted(part.columns) != sorted(parts[0].columns):
            raise ValueError(f"{path} holds files with other columns: {parts[0].columns} and {part.columns}")
    return require_columns(reduce(DataFrame.unionByName, parts), required, path)


def csv_files(spark: SparkSession, path: str, layout: str = "scan") -> list[DataFrame]:
    """The CSV files as text tables, one for each layout that occurs.

    A cell in quotes may hold line ends, and files of one folder may name their columns in other orders.
    ``lines``    every row is one line, and all files have one header. Files are split between tasks.
    ``records``  rows may run over lines, and all files have one header. A file is read by one task.
    ``scan``     reads the files as plain lines first, which tells each file's header, and whether one of its
                 lines has an odd number of quotes: only those files are read as records. Exact for every file, at
                 the price of one more pass over the bytes; say ``lines`` where that is known to hold.
    Rows with fewer cells than the header are filled up with nulls; one with more is an error that
    names the file, as is, in the first two, a file with another header.
    """
    if layout != "scan":
        if layout not in ("lines", "records"):
            raise ValueError(f"layout {layout!r} is none of scan, lines, records")
        return [_csv(spark, [path], layout == "records")]
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    place = F.when(F.col("_metadata.file_block_start") == 0, F.monotonically_increasing_id())
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), "value", place.alias("place"), (quotes % 2).alias("odd"))
    looks = lines.groupBy("file").agg(F.min_by("value", "place").alias("header"), F.max("odd").alias("odd"))
    layouts: dict[tuple[str, int], list[str]] = {}
    for file, header, odd in looks.orderBy("file").collect():  # a row for each file, as Spark's own list of them
        layouts.setdefault((header, odd), []).append(file)
    if len(layouts) <= 1:
        return [_csv(spark, [path], any(odd for _, odd in layouts))]
    return [_csv(spark, [_plain(file) for file in names], bool(odd)) for (_, odd), names in layouts.items()]


def _plain(file: str) -> str:
    """A path as the reader takes it, from one that is encoded as a URI; signs of patterns stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file))


def _csv(spark: SparkSession, paths: list[str], records: bool) -> DataFrame:
    options = {"header": True, "escape": '"', "enforceSchema": False}
    names = spark.read.options(**options).csv(paths).schema
    whole = next(n for n in ("_record", "_whole_record", "_the_whole_record") if n not in names.fieldNames())
    # Spark hands over the text of every row that has not as many cells as the header.
    options |= {"multiLine": records, "columnNameOfCorruptRecord": whole, "columnPruning": False}
    raw = spark.read.options(**options).schema(StructType([*names, StructField(whole, StringType())])).csv(paths)
    cells = 1 + F.regexp_count(F.regexp_replace(whole, '"[^"]*"', ""), F.lit(","))
    place = (F.lit("more cells than the header in "), F.input_file_name(), F.lit(", part from byte "), F.col("_metadata.file_block_start"))
    first = F.coalesce(F.col(f"`{names.fieldNames()[0]}`"), F.lit(""))  # Spark wants a column beside the whole text
    wrong = F.raise_error(F.concat(*place, F.lit(", row that starts with "), first, F.lit(": "), F.substring(whole, 1, 200)))
    fits = F.when(F.col(whole).isNotNull() & (cells > len(names)), wrong.cast("boolean")).otherwise(F.lit(True))
    return raw.where(fits).drop(whole)


def _with_order(raw: DataFrame, fmt: str, files: list[str] | None) -> DataFrame:
    """The table with its cells read; with the sorted files of the whole table, in their order."""
    cells = [_cell(raw, name) for name in raw.columns]
    if SRC_ORDER in raw.columns:
        return raw.select(*cells).withColumn(SRC_ORDER, F.col(SRC_ORDER).cast("bigint"))
    return raw.select(*cells) if files is None else _with_src_order(raw, cells, fmt, files)


def _cell(raw: DataFrame, name: str) -> Column:
    cell = F.col(f"`{name}`")
    if isinstance(raw.schema[name].dataType, StringType):
        cell = null_texts(cell)
    return cell.alias(name.lower().strip())


def _with_src_order(raw: DataFrame, cells: list[Column], fmt: str, files: list[str]) -> DataFrame:
    """Adds the row order as one BIGINT, whatever the number of files.

    Aggregates can so keep it in a fixed-width buffer, and every sink takes it. Within a file,
    Parquet gives the row number. For CSV it is the byte offset of the split plus the row's
    number in the task: a row takes a byte at least, so the next split starts higher. The file's
    rank by path stands in the bits above: as many as the number of files needs, and the rest is
    left to the offset. An offset that does not fit raises.
    """
    if fmt == "parquet":
        offset = F.col("_metadata.row_index")
    else:
        row_in_task = F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_MASK))
        offset = F.col("_metadata.file_block_start") + row_in_task
    if len(files) <= 1:
        return raw.select(*cells, offset.alias(SRC_ORDER))
    bits = _ORDER_BITS - (len(files) - 1).bit_length()
    ranks = raw.sparkSession.createDataFrame(list(zip(files, range(len(files)), strict=True)), "_path string, _rank long")
    if sum(map(len, files)) <= _MOST_RANK_CHARS:
        ranks = F.broadcast(ranks)
    placed = raw.select(*cells, offset.alias("_offset"), F.input_file_name().alias("_path")).join(ranks, "_path", "left")
    problem = F.when(F.col("_rank").isNull(), F.concat(F.lit("file without a rank: "), "_path")).when(
        F.shiftright("_offset", bits) > 0, F.concat(F.lit(f"too long for {len(files)} files: "), "_path")
    )
    order = F.shiftleft("_rank", bits).bitwiseOR(F.col("_offset"))
    order = F.when(problem.isNull(), order).otherwise(F.raise_error(problem).cast("bigint"))
    return placed.withColumn(SRC_ORDER, order).drop("_offset", "_path", "_rank")


def as_digits(df: DataFrame, name: str) -> Column:
    """What as_number takes as ``digits``, to be made in a select of its own before."""
    return (F.col(name) if isinstance(df.schema[name].dataType, StringType) else F.lit(None)).try_cast("bigint")


def as_number(df: DataFrame, name: str, digits: str | None = None) -> Column:
    """The column as a DOUBLE without NaN, parsed when it is text. ``digits`` names a column of as_digits."""
    cell = F.col(name)
    if isinstance(df.schema[name].dataType, StringType):
        return number(cell, None if digits is None else F.col(digits))
    value = cell.cast("double")
    return F.when(~F.isnan(value), value)


def as_day(df: DataFrame, name: str = "day_index") -> Column:
    """The day number as a BIGINT, parsed when it is text."""
    if isinstance(df.schema[name].dataType, StringType):
        return whole(number(F.col(name)))
    return F.col(name).cast("bigint")


def as_flag(df: DataFrame, name: str = "is_valid_day") -> Column:
    return truth(F.col(name))


def write_table(df: DataFrame, path: str | PurePath, fmt: str = "parquet") -> DataFrame:
    """Writes the table and returns it as read back, so that what follows starts from the files."""
    path = str(path)
    writer = df.write.mode("overwrite")
    reader = df.sparkSession.read.schema(df.schema)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    writer.format(fmt).save(path)
    return reader.format(fmt).load(path)
