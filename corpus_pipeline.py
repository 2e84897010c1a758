"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame; docs has the columns of ``documents``,
and all stages but the last return them. A stage works on all that the one before it kept. Whole documents
go through it, so its Python code gets batches of a few megabytes; where that code makes the result, it is stored.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm import decontamination, near_duplicates, packing, quality, toxicity
from pulsegrid.llm.frames import table
from pulsegrid.llm.settings import held, small_batches
from pulsegrid.sources.settle import settle

#: Of the pipeline alone; the query of the same operator has its own.
NEAR_PERCENT = 80

CODEC = "spark.sql.parquet.compression.codec"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def stored(stage: Stage) -> Stage:
    """The stage with its result stored, so that its last pass over the documents has small batches too.

    The copies lie beside those that the caller makes, so they are packed more tightly than usual.
    """

    @wraps(stage)
    def run_stored(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark), held(spark, {CODEC: "zstd"}):
            return settle(stage(spark, docs, sf_dir))

    return run_stored


@stored
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents whose score reaches their language's threshold."""
    return toxicity.accept(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@stored
def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that fail the base rules or lie far from their group."""
    return quality.accept(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each component of texts with a Jaccard index of 0.8 or more, the one with the least doc_id."""
    return near_duplicates.keep_one(docs, NEAR_PERCENT)


@stored
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in token sequences. ``pack`` stores them."""
    with small_batches(spark):
        return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack_sequences),
]

#: SQL cannot express the classifier, the estimates and the tokenizer; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another, each on the stored result of the one before it."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if stage is drop_near_duplicates:
            docs = settle(docs)
    return docs
