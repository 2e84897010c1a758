import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pulsegrid.llm import conversation_trie as c
from pulsegrid.llm.queries import trie_of

SCHEMA = "conv_id long, turn long, role string, text string"


def in_order(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    return {conv: [t[1:] for t in sorted(found)] for conv, found in turns.items()}


def brute(rows):
    """Every node by walking all prefixes."""
    given, sequences = in_order(rows), {}
    for conv, own in given.items():
        h = zlib.crc32(str(conv).encode()) % 9
        sequences[conv] = tuple(given.get(conv - int(np.fmod(conv, 5)), [])[:h] + own[h:])
    members = defaultdict(set)
    for conv, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].add(conv)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    out = []
    for p, who in members.items():
        below = [q for q in members if q[: len(p)] == p]
        ends = sorted(conv for conv in who if len(sequences[conv]) == len(p))
        out.append(
            (
                min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(children[p]), sum(not children[q] for q in below),
                sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def found(spark, rows, **settings):
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as id", "'x' as ids", "2 as level", "3 as depth")
    return sorted((tuple(r) for r in trie_of(table, **settings).collect()), key=str)


def corpus(seed, n=120, longest=14, words=3):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        if rng.random() < 0.1:
            continue
        for turn in range(rng.randint(1, longest)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), "é" * rng.randrange(words)))
    hot = [(turn, "user", f"hot {turn}") for turn in range(12)]
    rows += [(conv, *t) for conv in range(200, 320) for t in hot[: rng.choice([12, 12, 12, 3])]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_nodes_match_brute_force_over_many_shards(spark, monkeypatch, seed):
    monkeypatch.setattr(c, "SHARD_BLOCKS", 25)
    rows = corpus(seed)
    assert found(spark, rows) == brute(rows)


def test_levels_change_nothing(spark, monkeypatch):
    rows = corpus(3)
    want = brute(rows)
    assert found(spark, rows, first=2, most=8) == want
    monkeypatch.setattr(c, "SHARD_BLOCKS", 10)
    assert found(spark, rows, first=2, most=2) == want


def test_a_long_conversation_beside_short_ones(spark):
    rows = [(10, t, "user", str(t)) for t in range(700)] + [(11, t, "user", str(t)) for t in range(650)] + [(12, 0, "user", "0")]
    assert found(spark, rows) == brute(rows)


def test_odd_rows_have_defined_results(spark):
    rows = [(None, 0, "user", "x"), (0, None, None, None), (0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "assistant", "a"), (3, 5, None, "")]
    rows += [(-7, 0, "user", "n"), (-5, 0, "user", "n"), (-5, 1, "user", "m"), (-2, 0, "u", "v"), (2, 0, "user", "alone"), (7, 0, "user", "")]
    rows += [(conv, 0, "user", "one") for conv in range(20, 60)]
    assert found(spark, rows) == brute(rows)
    assert any(r[1] == 0 and r[3] > 5 for r in found(spark, rows))


def test_an_empty_table(spark):
    assert found(spark, []) == []


def test_a_shard_marks_nodes_and_keeps_edges_apart():
    ids = [[1, 2], [1, 2, 3], [1, 4], [5], [6], [6, 7]]
    key = c.ROOT.view(np.int64).tolist()
    rows = [(0, *key, x, [10] * len(x), k, None, None) for k, x in enumerate(ids)]
    table = pa.Table.from_batches([c._table(rows, c.BLOCKS)])
    zero = pa.array([0] * len(ids), pa.int64())
    for name in ("below_children", "below_leaves", "below_saved"):
        table = table.append_column(name, zero)
    out = list(c.Shard(table, 0, 64, True).rows())
    kinds = defaultdict(set)
    for r in out:
        kinds[r[0]].add((r[1], r[6]))
    assert kinds["part"] == {(0, 0), (1, 0), (2, 0), (1, 4), (2, 5)}  # those with the first row 0 or the last row 5
    assert kinds["node"] == {(3, 1), (2, 2), (1, 3)}
