"""A multiway hyperplane tree over vectors, for exact searches in windows of the inner product.

**Space.** A vector x gets one more component, sqrt(M - |x|^2), M being the largest squared norm of
all rows; a query q gets a zero. Then d(q, x)^2 = |q|^2 + M - 2 <q, x>: a window of scores around q
is an annulus of Euclidean distances, and the best scores are the nearest rows.

**Tree.** A node has up to ``FANOUT`` split points, taken far apart from each other out of a bounded
sample; a row goes to the child whose split point is nearest (ties: the first). For each split
point i and each sibling subtree j the tree keeps the range of the distances from i to the rows
below j. The sample only chooses split points: the ranges are folded over all rows, and every row is
in a leaf. The tree's size is bounded by its depth, not by the rows.

**Search.** By the triangle inequality, all rows below j lie at least max_i(d(q, i) - high_ij,
low_ij - d(q, i)) and at most min_i(d(q, i) + high_ij) from q. A subtree whose range misses the
annulus is left out; what remains of the leaves is compared exactly, in integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

FANOUT = 8
#: Rows of a leaf that the depth aims at, and the depth at most (8**4 leaves).
LEAF_ROWS, MOST_DEPTH = 800, 4
#: Rows of the sample at most, and their numbers at most.
SAMPLE, SAMPLE_NUMBERS = 8_192, 1 << 22
#: Candidates for each split point.
CANDIDATES = 6
RANGES = "node int, split int, child int, low double, high double"


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of doubles, filled up with zeros."""
    out = np.zeros((len(column), width))
    lengths = np.diff(column.offsets.to_numpy())
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def lifted(x: np.ndarray, most: float) -> np.ndarray:
    """The rows with the component that gives all of them the squared norm ``most``."""
    rest = np.sqrt(np.maximum(most - (x * x).sum(1), 0))
    return np.concatenate([x, rest[:, None]], 1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)
    return np.sqrt(np.maximum(square, 0))


@dataclass
class Tree:
    """``points[node]`` are the split points; child k of a node is the node ``children[node][k]`` or a leaf."""

    width: int
    most: float  # the largest squared norm
    points: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)  # nodes, or -1 - leaf
    low: list[np.ndarray] = field(default_factory=list)  # [split, child]
    high: list[np.ndarray] = field(default_factory=list)
    leaves: int = 0

    @property
    def slack(self) -> float:
        """More than rounding can move a distance: it is the root of a difference of squares."""
        return 1e-6 * (1 + self.most**0.5)

    def place(self, x: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Each lifted row's leaf; and for each node (node, its rows' children, their distances to its split points)."""
        leaf, steps, todo = np.zeros(len(x), np.int64), [], [(0, np.arange(len(x)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            d = distances(x[at], self.points[node])
            child = d.argmin(1)
            steps.append((node, child, d))
            for k, below in enumerate(self.children[node]):
                if below < 0:
                    leaf[at[child == k]] = -1 - below
                else:
                    todo.append((below, at[child == k]))
        return leaf, steps

    def reach(self, q: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, leaf) for all leaves that may hold a row between the two distances of the query.

        q are vectors without the last component.
        """
        q = np.concatenate([q, np.zeros((len(q), 1))], 1)
        queries, leaves, todo = [], [], [(0, np.arange(len(q)))]
        while todo:
            node, at = todo.pop()
            if not len(at):
                continue
            d = distances(q[at], self.points[node])[:, :, None]
            least = np.maximum(d - self.high[node], self.low[node] - d).max(1)
            most = (d + self.high[node]).min(1)
            good = (least <= farthest[at, None] + self.slack) & (most >= nearest[at, None] - self.slack)
            good &= np.isfinite(self.low[node]).any(0)  # a child without rows
            for k, below in enumerate(self.children[node]):
                mine = at[good[:, k]]
                if below < 0:
                    queries.append(mine)
                    leaves.append(np.full(len(mine), -1 - below))
                else:
                    todo.append((below, mine))
        return np.concatenate(queries or [np.zeros(0, np.int64)]), np.concatenate(leaves or [np.zeros(0, np.int64)])


def _far_apart(x: np.ndarray, k: int) -> np.ndarray:
    """Up to k of the rows, each as far as can be from those before it; equal rows once."""
    x = x[np.linspace(0, len(x) - 1, min(len(x), k * CANDIDATES)).astype(int)]
    picked = [int(((x - x.mean(0)) ** 2).sum(1).argmax())]
    near = distances(x, x[picked]).min(1)
    while len(picked) < k and near.max() > 1e-3:
        picked.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[picked[-1:]])[:, 0])
    return x[picked]


def grow(sample: np.ndarray, most: float, rows: int, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Tree:
    """The tree of a sample (at least one row), as deep as the number of all rows asks for."""
    depth = 1
    while fanout**depth * leaf_rows < rows and depth < MOST_DEPTH:
        depth += 1
    tree = Tree(sample.shape[1], most)
    todo = [(lifted(sample, most), 1, None, 0)]
    while todo:
        x, level, parent, k = todo.pop()
        node = len(tree.points)
        points = _far_apart(x, fanout)
        tree.points.append(points)
        tree.children.append([0] * len(points))
        tree.low.append(np.full((len(points),) * 2, np.inf))
        tree.high.append(np.full((len(points),) * 2, -np.inf))
        if parent is not None:
            tree.children[parent][k] = node
        child = distances(x, points).argmin(1)
        for c in range(len(points)):
            mine = x[child == c]
            if level < depth and len(points) > 1 and len(mine) >= 2 * fanout:
                todo.append((mine, level + 1, node, c))
            else:
                tree.children[node][c] = -1 - tree.leaves
                tree.leaves += 1
    return tree


def with_leaf(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("leaf", IntegerType())])


def index(rows: DataFrame, tree: Tree) -> DataFrame:
    """The rows (with a column ``v``, doubles) and the column ``leaf``."""
    width, most = tree.width, tree.most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, _ = tree.place(lifted(matrix(batch.column("v"), width), most))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    return rows.mapInArrow(run, with_leaf(rows.schema))


def ranges(rows: DataFrame, tree: Tree) -> DataFrame:
    """``RANGES``: a row for each split point and sibling subtree with rows. Tasks fold theirs first."""
    width, most = tree.width, tree.most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = [np.full_like(x, np.inf) for x in tree.low]
        high = [np.full_like(x, -np.inf) for x in tree.high]
        for batch in batches:
            _, steps = tree.place(lifted(matrix(batch.column("v"), width), most))
            for node, child, d in steps:
                for c in np.unique(child):
                    mine = d[child == c]
                    low[node][:, c] = np.minimum(low[node][:, c], mine.min(0))
                    high[node][:, c] = np.maximum(high[node][:, c], mine.max(0))
        out = [(n, i, c, low[n][i, c], high[n][i, c]) for n in range(len(low)) for i, c in np.argwhere(np.isfinite(low[n])).tolist()]
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in RANGES.split(", ")])

    found = rows.select("v").mapInArrow(run, RANGES)
    return found.groupBy("node", "split", "child").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def fitted(rows: DataFrame, width: int, most: float, total: int, key: str, fanout: int = FANOUT, leaf_rows: int = LEAF_ROWS) -> Tree:
    """The tree over a stored frame with a column ``v`` and the column ``key`` that draws the sample by its hash."""
    n = min(SAMPLE, max(1, SAMPLE_NUMBERS // max(1, width)))
    drawn = rows.select("v", F.xxhash64(key).alias("draw")).where(F.pmod("draw", F.lit(max(1, total // (2 * n)))) == 0)
    drawn = drawn.orderBy("draw").limit(n).toArrow()
    if not drawn.num_rows:
        drawn = rows.select("v").limit(n).toArrow()
    tree = grow(matrix(drawn.column("v").combine_chunks(), width), most, total, fanout, leaf_rows)
    for r in ranges(rows, tree).collect():  # bounded: fanout squared for each node
        tree.low[r.node][r.split, r.child] = r.low
        tree.high[r.node][r.split, r.child] = r.high
    return tree
