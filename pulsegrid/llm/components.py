"""Connected components of a graph given by its edges, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import settle_few, tasks_for
from pulsegrid.sources.settle import settle

#: Edges that one task writes.
EDGES_PER_TASK = 100_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first())


def _star(edges: DataFrame) -> DataFrame:
    """u > v. Each node sends its larger neighbours, then itself and its smaller ones, to the least of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node of its component) for every node of the edges (a, b).

    A step only needs a minimum for each node, which is folded before it is shuffled; the joins
    that send it back are plain equality joins, whose hot keys the adaptive plan splits. Every
    step is stored, so lineage stays short. Loops and repeated edges are harmless.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = settle(edges)
    mark = _mark(edges)
    while mark[0]:
        edges = settle_few(_star(edges), tasks_for(mark[0], EDGES_PER_TASK))
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots).distinct()
