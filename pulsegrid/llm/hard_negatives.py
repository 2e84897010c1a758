"""Hard negatives out of labelled vectors, found exactly in a multiway hyperplane tree.

A row's score is its integer inner product with the anchor; higher scores come first, ties by
smaller vec_id. An anchor's positives are its first ``positives`` other rows of the same label. For
each positive, its negatives are the first ``negatives`` rows of other labels whose score lies
between ``percent`` percent of the positive's and the positive's own.

1. **Rows.** Components become floor(scale * x), once, and are stored with their leaf of the tree
   (``hyperplane_tree``: how it is fitted, and why its searches are exact).
2. **Seed.** An anchor is compared with its own leaf. The last of the positives found there bounds
   how far the others can be.
3. **Positives.** The anchor goes to every leaf that may hold a row within that bound.
4. **Negatives.** The windows of its positives are annuli around the anchor; it goes to every leaf that
   the annulus around all of them meets.

Comparing works on blocks: a leaf's rows are cut into blocks of about ``ROWS``, the anchors that
come to it into blocks of about ``QUERIES``; each pair of blocks is one matrix product in a task
that holds this pair alone. So a leaf with a third of all rows is many blocks. Tasks pass on the
best few of each anchor; nothing is left out before that.

Rows with a null vec_id, label or vector, or with a null or non-finite component, take no part. A
shorter vector counts as filled up with zeros. Of rows with one vec_id, the one with the least
label (then the least vector) counts. Anchors without positives, and positives without negatives,
give no row. Other columns are left out; an empty table gives an empty result. Inner products
must fit 62 bits: larger vectors raise an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pulsegrid.llm.frames import only
from pulsegrid.llm.hyperplane_tree import Tree, fitted, index, matrix, with_leaf
from pulsegrid.sources.settle import settle

POSITIVES = NEGATIVES = 5
PERCENT = 80
SCALE = 256
ROWS, QUERIES = 4_096, 512
EXACT = 2.0**53  # integers up to here are doubles
HARDEST = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
FOUND = "anchor_id long, other_id long, score long, positive_id long, positive_score long"


def vectors(embeddings: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """vec_id, label and v (whole numbers as doubles) of the rows that take part, each vec_id once."""
    rows = only(embeddings, ("vec_id", "embedding", "label"), "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    rows = settle(rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), whole.alias("v")))
    if rows.groupBy("vec_id").count().where("count > 1").isEmpty():
        return rows
    least = rows.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("least"))
    return settle(least.select("vec_id", "least.label", "least.v"))


def _scores(rows: np.ndarray, queries: np.ndarray, most: float) -> np.ndarray:
    """Exact inner products [row, query]: by Cauchy's inequality, no sum exceeds ``most``."""
    if most < EXACT:
        return (rows @ queries.T).astype(np.int64)
    return rows.astype(np.int64) @ queries.astype(np.int64).T


def _first(order_by: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The places of the first k by score, highest first, then id."""
    at = np.arange(len(ids))
    if len(ids) > k:
        at = np.flatnonzero(order_by >= np.partition(order_by, -k)[-k])
    return at[np.lexsort((ids[at], -order_by[at]))][:k]


def best_positives(k: int) -> Callable:
    """Of a block, each anchor's first k rows of its label, at or above the bound that it brings."""

    def compare(scores, rows, queries):
        for j, (anchor, label, given) in enumerate(zip(queries["id"], queries["label"], queries["windows"], strict=True)):
            bound = given[0]["score"] if given else None
            at = np.flatnonzero((rows["label"] == label) & (rows["id"] != anchor) & (True if bound is None else scores[:, j] >= bound))
            for i in at[_first(scores[at, j], rows["id"][at], k)]:
                yield anchor, rows["id"][i], scores[i, j], None, None

    return compare


def best_negatives(k: int, percent: int) -> Callable:
    """Of a block, each window's first k rows of other labels."""

    def compare(scores, rows, queries):
        for j, (anchor, label, windows) in enumerate(zip(queries["id"], queries["label"], queries["windows"], strict=True)):
            high = max(w["score"] for w in windows)
            low = [-(-percent * w["score"] // 100) for w in windows]
            at = np.flatnonzero((rows["label"] != label) & (scores[:, j] <= high) & (scores[:, j] >= min(low)))
            if not len(at):
                continue
            at = at[np.lexsort((rows["id"][at], -scores[at, j]))]
            down = -scores[at, j]
            for w, least in zip(windows, low, strict=True):
                start = int(np.searchsorted(down, -w["score"]))
                for i in at[start : start + k]:
                    if scores[i, j] < least:
                        break
                    yield anchor, rows["id"][i], scores[i, j], w["id"], w["score"]

    return compare


def compared(queries: DataFrame, rows: DataFrame, compare: Callable, width: int, most: float) -> DataFrame:
    """``FOUND``: what compare finds in the blocks. queries has vec_id, label, v, windows and leaf; rows is stored."""
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("n_r"))
    visits = queries.groupBy("leaf").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("n_q"))
    blocks = F.broadcast(settle(sizes.join(visits, "leaf")))  # a row for each leaf, of which there are 8**4 at most
    mine = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    windows = "array<struct<id: bigint, score: bigint>>"
    given = rows.join(blocks, "leaf").withColumns({"r": mine("n_r"), "windows": F.lit(None).cast(windows), "asks": F.lit(False)})
    asked = queries.join(blocks, "leaf").withColumns({"q": mine("n_q"), "asks": F.lit(True)})
    names = ["leaf", "r", "q", "asks", "vec_id", "label", "v", "windows"]
    both = given.withColumn("q", every("n_q")).select(names).unionByName(asked.withColumn("r", every("n_r")).select(names))
    dealt = both.repartition("leaf", "r", "q").sortWithinPartitions("leaf", "r", "q", "asks")

    def done(parts: list[pa.RecordBatch]) -> Iterator[tuple]:
        block = pa.Table.from_batches(parts).combine_chunks()
        asks = block.column("asks").to_numpy()
        n = int((~asks).sum())
        if 0 < n < len(asks):
            x = matrix(block.column("v").chunk(0), width)
            ids, labels = block.column("vec_id").to_numpy(), block.column("label").to_numpy()
            queries = {"id": ids[n:], "label": labels[n:], "windows": block.column("windows")[n:].to_pylist()}
            yield from compare(_scores(x[:n], x[n:], most), {"id": ids[:n], "label": labels[:n]}, queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        current = None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in ("leaf", "r", "q")], 1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if parts and tuple(key[a]) != current:
                    yield _found(done(parts))
                    parts = []
                current = tuple(key[a])
                parts.append(batch.slice(a, b - a))
        yield _found(done(parts) if parts else ())

    return dealt.mapInArrow(run, FOUND)


def _found(rows) -> pa.RecordBatch:
    names = [c.split()[0] for c in FOUND.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def visited(anchors: DataFrame, tree: Tree, percent: int | None = None) -> DataFrame:
    """The anchors, once for each leaf that may hold what they look for.

    With a percentage, rows from that part of the least window's score to the greatest one; without it,
    all from the score of the first window on, or all where there is none.
    """
    width, most, names = tree.width, tree.most, anchors.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                q = matrix(part.column("v"), width)
                scores = [[w["score"] for w in ws or ()] for ws in part.column("windows").to_pylist()]
                reach = (q * q).sum(1) + most
                away = lambda s: np.sqrt(np.maximum(reach - 2 * np.array(s, float), 0))
                if percent is None:
                    nearest, farthest = np.zeros(len(q)), away([s[0] if s else -np.inf for s in scores])
                else:
                    nearest, farthest = away([max(s) for s in scores]), away([percent * min(s) / 100 for s in scores])
                which, leaf = tree.reach(q, nearest, farthest)
                taken = part.take(pa.array(which))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(leaf.astype(np.int32))], [*names, "leaf"])

    return anchors.mapInArrow(run, with_leaf(anchors.schema))


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, percent: int = PERCENT
) -> DataFrame:
    """``HARDEST``, for ``vectors``. Anchors are a stated part of the rows and are searched among all of them."""
    facts = rows.agg(
        F.count("*").alias("n"),
        F.max(F.size("v")).alias("width"),
        F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("most"),
    ).first()
    if not facts.n:
        return rows.sparkSession.createDataFrame([], HARDEST)
    if facts.most >= 2.0**62:
        raise ValueError("the vectors are too long: an inner product would not fit a long")
    width, most = facts.width, facts.most
    tree = fitted(rows, width, most, facts.n, "vec_id")
    leafed = settle(index(rows, tree))
    anchors = leafed.where(is_anchor)
    window = "array(struct(bigint({}) as id, bigint({}) as score))"

    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    seeds = compared(anchors.withColumn("windows", none), leafed, best_positives(positives), width, most)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "other_id")
    bound = seeds.withColumn("k", F.row_number().over(order)).where(F.col("k") == positives)
    bound = bound.select(F.col("anchor_id").alias("vec_id"), F.expr(window.format("other_id", "score")).alias("windows"))
    bounded = settle(anchors.drop("leaf").join(bound, "vec_id", "left"))

    found = compared(settle(visited(bounded, tree)), leafed, best_positives(positives), width, most)
    first = found.withColumn("k", F.row_number().over(order)).where(F.col("k") <= positives)
    windows = first.where("score >= 0").groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("other_id").alias("id"), "score")).alias("windows")
    )
    asking = settle(anchors.drop("leaf").join(windows, "vec_id"))

    found = compared(settle(visited(asking, tree, percent)), leafed, best_negatives(negatives, percent), width, most)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "other_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
