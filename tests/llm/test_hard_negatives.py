import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import hard_negatives as h
from pulsegrid.llm import hyperplane_tree as t
from pulsegrid.sources.settle import settle

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, most=5):
    usable = {}
    for vec, embedding, label in rows:
        if vec is None or label is None or embedding is None or any(x is None or not math.isfinite(x) for x in embedding):
            continue
        label = (label + 1) % 10 if vec % 7 == 0 else label
        v = tuple(math.floor(256 * float(np.float32(x))) for x in embedding)
        usable[vec] = min(usable.get(vec, (label, v)), (label, v))
    out = []
    for a, (label, v) in usable.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), b, other) for b, (other, w) in usable.items() if b != a)
        for s, p, _ in [x for x in scored if x[2] == label][:most]:
            inside = [(m, b) for m, b, other in scored if other != label and 80 * -s <= 100 * -m <= 100 * -s]
            out += [(a, p, k, b, -s, -m) for k, (m, b) in enumerate(inside[:most], 1)]
    return sorted(out)


def label():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def found(spark, rows, every=100):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as leaf", "'x' as v", "2 as windows")
    return sorted(tuple(r) for r in h.hard_negatives(h.vectors(table, label()), F.col("vec_id") % every == 0).collect())


def clustered(rng, n, width=8, hot=0):
    centres = [[rng.gauss(0, 0.3) for _ in range(width)] for _ in range(12)]
    rows = []
    for k in range(n):
        c = rng.choice(centres)
        rows.append((k, [x + rng.gauss(0, 0.08) for x in c], rng.randrange(10)))
    for k in rng.sample(range(n), hot):
        rows[k] = (k, rows[0][1], rows[k][2])
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 0), (2, 500)])
def test_negatives_match_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(t, "LEAF_ROWS", 40)
    monkeypatch.setattr(h, "ROWS", 60)
    monkeypatch.setattr(h, "QUERIES", 5)
    rows = clustered(random.Random(seed), 1500, hot=hot)
    want = brute(rows, every=25)
    assert found(spark, rows, every=25) == want and len(want) > 200


def test_odd_rows_have_defined_results(spark):
    rng = random.Random(3)
    rows = clustered(rng, 300, width=4)
    nan, inf = float("nan"), float("inf")
    rows += [(None, [1.0] * 4, 1), (400, None, 1), (500, [1.0] * 4, None), (600, [1.0, None, 0.0, 0.0], 2), (700, [nan] * 4, 2)]
    rows += [(800, [inf, 0.0, 0.0, 0.0], 2), (900, [], 3), (1000, [0.5, 0.5], 3), (1100, [0.0] * 4, 3), (1100, [0.5] * 4, 2)]
    rows += [rows[100], rows[7], (1200, [-0.4] * 4, 5), (1300, [0.9] * 4, 5)]
    assert found(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_id(spark):
    rows = [(k, [0.5, 0.25], k % 2) for k in range(1, 30)] + [(100, [0.5, 0.25], 0)]
    got = found(spark, rows)
    assert got == brute(rows) and {r[1] for r in got if r[0] == 100} == set(sorted({r[1] for r in got if r[0] == 100})[:5])


def test_an_empty_table_and_a_single_row(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0], 1)]) == []


def test_long_vectors_are_exact_and_too_long_ones_an_error(spark):
    rows = [(k, [float(2**21 + 3 * k), 1.0 / (k + 1)], k % 3) for k in range(1, 120)]
    assert found(spark, rows, every=20) == brute(rows, every=20)
    with pytest.raises(ValueError, match="too long"):
        found(spark, [(k, [1e20], k % 3) for k in range(1, 5)])


def test_the_tree_leaves_out_far_leaves_and_no_near_row():
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 60, (40, 6))
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 4, (4000, 6)))
    most = float((x * x).sum(1).max())
    tree = t.grow(x[:1000], most, len(x), fanout=6, leaf_rows=30)
    leaf, steps = tree.place(t.lifted(x, most))
    for node, child, d in steps:
        for c in np.unique(child):
            tree.low[node][:, c] = np.minimum(tree.low[node][:, c], d[child == c].min(0))
            tree.high[node][:, c] = np.maximum(tree.high[node][:, c], d[child == c].max(0))
    q = x[:50]
    away = np.sqrt(np.maximum((q * q).sum(1)[:, None] + most - 2 * (q @ x.T), 0))
    near, far = np.quantile(away, 0.02, axis=1), np.quantile(away, 0.05, axis=1)
    reached = set(zip(*(v.tolist() for v in tree.reach(q, near, far)), strict=True))
    for k in range(len(q)):
        wanted = set(leaf[(away[k] >= near[k]) & (away[k] <= far[k])].tolist())
        assert all((k, w) in reached for w in wanted)
    assert len(reached) < 0.7 * len(q) * tree.leaves


def test_every_row_is_in_a_leaf_and_in_its_ranges(spark):
    rows = settle(h.vectors(spark.createDataFrame(clustered(random.Random(8), 900), SCHEMA), label()))
    tree = t.fitted(rows, 8, 1e6, 900, "vec_id", fanout=4, leaf_rows=50)
    counts = t.index(rows, tree).groupBy("leaf").count().collect()
    assert sum(r["count"] for r in counts) == 900 and len(counts) > 10
