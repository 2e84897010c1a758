import random
import re

import numpy as np
import pytest

from pulsegrid.llm import near_duplicates as n
from pulsegrid.llm.components import components

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return set(zip(*[words[k:] for k in range(5)], strict=False))


def brute(rows):
    """doc_id -> (size, least linked id), by all pairs."""
    sets = [(doc, shingles(text)) for doc, text in rows]
    root = {doc: doc for doc, _ in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                one, two = top(a), top(b)
                root[max(one, two)] = min(one, two)
    return {doc: (len(s), top(doc)) for doc, s in sets}


def words(rng, k):
    return ["".join(rng.choices("abcdefghij", k=4)) for _ in range(k)]


def edited(rng, given, k):
    out = list(given)
    for _ in range(k):
        out[rng.randrange(len(out))] = "".join(rng.choices("xyz", k=6))
    return out


def hashes_of(texts):
    found = n.shingle_sets(n.WordReader(lower=True).read([" ".join(t).encode() for t in texts.values()]))
    return dict(zip(texts, found, strict=True))


def corpus(seed):
    rng = random.Random(seed)
    rows = [words(rng, rng.randint(1, 300)) for _ in range(60)]
    for size in (8, 40, 150, 600, 2500):
        base = words(rng, size)
        rows += [base, base, [w.upper() for w in base]]
        rows += [edited(rng, base, rng.randint(1, max(1, size // 60))) for _ in range(6)]
        step = base
        for _ in range(5):  # a chain whose ends are not linked
            step = edited(rng, step, max(1, size // 80))
            rows.append(step)
    hub = words(rng, 150)
    rows += [hub] + [edited(rng, hub, rng.randint(1, 6)) for _ in range(120)]
    rows += [["one"], ["one"], ["one", "two", "three", "four"], ["one", "two", "three", "four"]]
    rng.shuffle(rows)
    texts = [" ".join(r) for r in rows] + ["", " \n", None]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_shingles", "'x' as kept", "2 as cls")
    found = {r.doc_id: r for r in n.near_duplicates(docs).collect()}
    want = brute(rows)
    assert {d: (r.n_shingles, r.component_id) for d, r in found.items()} == want
    assert all(r.kept == (r.component_id == d) for d, r in found.items())


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(n, "STRAYS", 7)
    monkeypatch.setattr(n, "OTHERS", 11)
    monkeypatch.setattr(n, "AT_ONCE", 4)
    rows = corpus(3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in n.near_duplicates(docs).collect()} == brute(rows)


def test_strays_are_found_beside_the_stars(spark):
    """A chain in one bucket: the centre links to the middle only."""
    rng = random.Random(9)
    base = words(rng, 400)
    chain = [base]
    for k in range(6):
        changed = list(chain[-1])
        for j in range(12):
            changed[k * 60 + 4 * j] = f"new{k}x{j}"
        chain.append(changed)
    rows = list(enumerate(" ".join(c) for c in chain))
    want = brute(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = n.full_sets(docs, docs.selectExpr("doc_id as cls"))
    bucket = [(r.cls, n.band_keys(n._sketch(r.rounds, r.registers, r.rounds[0]), r.rounds[0])) for r in sets.collect()]
    assert len(bucket) == len(rows)
    assert {d: (r.n_shingles, r.component_id) for d, r in ((r.doc_id, r) for r in n.near_duplicates(docs).collect())} == want


@pytest.mark.parametrize("foreign", [0, 1, 2, 3])
def test_strays_are_found_beside_a_second_text_of_their_doc_id(spark, foreign):
    rng = random.Random(21)
    base = words(rng, 400)
    texts = {7: base, 3: base + words(rng, 6), 5: base + words(rng, 9)}
    keys = {d: set(n.band_keys(n.registers(h, 3), 3).tolist()) for d, h in hashes_of(texts).items()}
    rows = [(d, " ".join(t)) for d, t in texts.items()]
    second = {0: [], 1: [3], 2: [5, 7], 3: [3, 5, 7]}[foreign]
    rows = [(d, " ".join(words(rng, 30))) for d in second] + rows
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = n.full_sets(docs, docs.selectExpr("doc_id as cls"))
    labelled = spark.createDataFrame([(key, d, d, 99) for d in texts for key in keys[d]], "key long, cls long, label long, centre long")
    links = {frozenset((r.a, r.b)) for r in n.stray_links(labelled, sets).collect()}
    root = {d: d for d in texts}
    for a, b in map(tuple, links):
        root = {d: min(root[a], root[b]) if r in (root[a], root[b]) else r for d, r in root.items()}
    assert set(root.values()) == {3}


def test_sketches_of_two_powers_with_one_key_lose_no_link():
    """The key adds the power to the first register, so one power more and one value less give the same key."""
    rng = np.random.default_rng(3)
    hashes = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
    sketch, bare = n.registers(hashes, 3), np.zeros(n.BUCKETS, "<u2")
    bare[: n.ROWS] = sketch[: n.ROWS]
    bare[0] -= 1
    key = n.band_keys(sketch, 3)[0]
    assert n.band_keys(bare, 4)[0] == key
    parts = {"high": (hashes >> np.uint64(32)).astype("<u4").tobytes(), "low": (hashes >> np.uint64(24)).astype("u1").tobytes()}
    row = lambda cls, stray, power, data: {
        "key": key, "cls": cls, "label": cls, "stray": stray, "n": len(hashes), "rounds": [power], "registers": data.tobytes(), **parts,
    }
    rows = [row(1, False, 4, bare), row(2, False, 3, sketch), row(1, True, 4, bare), row(3, True, 3, sketch)]
    assert [tuple(sorted(p)) for p in n._block_links(rows, 85)] == [(2, 3)]


def test_repeated_rows_nulls_and_empty_tables(spark):
    text = "a b c d e f g h"
    rows = [(5, text), (5, text), (3, text), (None, text), (None, "else"), (8, None), (9, ""), (9, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted(((r.doc_id or 0), r.n_shingles, r.component_id or 0, r.kept) for r in n.near_duplicates(docs).collect())
    assert found == [
        (0, 1, 0, False), (0, 4, 3, False), (3, 4, 3, True), (5, 4, 3, False), (5, 4, 3, False), (8, 0, 8, True), (9, 0, 9, True), (9, 0, 9, True),
    ]
    assert n.near_duplicates(docs.limit(0)).collect() == []
    more = docs.selectExpr("*", "length(text) as n_chars")
    stays = n.keep_one(more)
    assert stays.columns == more.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in stays.collect()) == [(0, "else"), (3, text), (8, ""), (9, "")]


def test_only_copies_go_where_an_id_has_several_texts(spark):
    """Both ways: the unlike text is the first or the second row of its id; copies lie before and after it."""
    rng = random.Random(17)
    one, two, three, four = (" ".join(words(rng, 60)) for _ in range(4))
    near = one + " more"
    rows = [(1, one, 5), (3, three, 6), (3, near, 7), (2, two, 8), (2, four, 9), (6, four, 10), (4, two + " end", 11)]
    rows += [(None, one, 12), (None, "null alone " + three[:90], 13), (None, "null alone " + three[:90], 14), (7, "", 15), (7, None, 16), (8, one, 17), (8, one, 18)]
    want = {(1, one), (2, two), (2, four), (3, three), (None, "null alone " + three[:90]), (7, ""), (7, None)}
    table = "doc_id long, text string, __bit long"
    for order in (rows, rows[::-1], sorted(rows, key=lambda r: r[2] * 7 % 11)):
        docs = spark.createDataFrame(order, table).selectExpr("*", "__bit as __bits", "__bit as __word", "__bit as bit", "'x' as row", "__bit as marked")
        found = [(tuple(r)[:2], tuple(r)[2:]) for r in n.keep_one(docs, 80).collect()]
        assert sorted(map(str, (key for key, _ in found))) == sorted(map(str, want))
        numbers = {(d, x): k for d, x, k in rows[::-1]}
        assert all(rest == (k := numbers[key], k, k, k, "x", k) for key, rest in found)


def test_a_clashing_column_is_left_alone_where_ids_are_distinct(spark):
    rows = [(k, f"the same words {k % 3} for all of these rows", 5) for k in range(9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __bit long").selectExpr("*", "__bit as bits", "__bit as word", "__bit as listed")
    assert sorted(tuple(r) for r in n.keep_one(docs).collect()) == [(*r, 5, 5, 5) for r in rows[:3]]


def test_an_empty_table_keeps_nothing(spark):
    assert n.keep_one(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("size", [7, 30, 300, 1100, 5000])
def test_the_estimate_is_near_the_truth(size):
    rng = np.random.default_rng(size)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 2**63, size * 2).astype(np.uint64)
        a, b = np.unique(pool[:size]), np.unique(np.concatenate([pool[: size - size // 8], pool[size : size + size // 8]]))
        power = min(set(n.rounds_for(len(a))) & set(n.rounds_for(len(b))))
        x, y = n.registers(a, power), n.registers(b, power)
        truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        errors.append(n.estimate(((x == y) & (x > 0)).sum(), ((x > 0) | (y > 0)).sum(), len(a), len(b), power) - truth)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.04


def test_sets_that_may_be_linked_share_a_number_of_rounds():
    for size in range(1, 6000, 7):
        smaller = -(-size * 85 // 100)
        assert set(n.rounds_for(size)) & set(n.rounds_for(smaller))


@pytest.mark.parametrize("percent", [100, 85, 80, 60, 45, 30])
def test_bands_and_rounds_follow_the_threshold(percent):
    bands, width = n.bands_for(percent)
    assert bands * width <= n.BUCKETS and (1 - (percent / 100) ** width) ** bands <= 1.2e-5
    assert n.bands_for() == (24, 6)
    for size in range(1, 6000, 7):
        for smaller in range(-(-size * percent // 100), size + 1, max(1, size // 5)):
            assert set(n.rounds_for(size, percent)) & set(n.rounds_for(smaller, percent))


def test_a_pair_across_a_border_of_rounds_is_linked_at_its_threshold(spark):
    """1250 and 1010 shingles, Jaccard index 0.808: at 85 such sets would share no number of rounds."""
    rng = random.Random(4)
    base = words(rng, 1254)
    other = words(rng, 1204)
    rows = [(1, " ".join(base)), (2, " ".join(base[:1014])), (3, " ".join(other)), (4, " ".join(other[:950]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in n.near_duplicates(docs, 80).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}
    assert {r.component_id for r in n.near_duplicates(docs).collect()} == {1, 2, 3, 4}


def test_linked_is_exact_at_the_threshold():
    a = np.arange(100, dtype=np.uint64)
    assert n.linked(a, a[:85]) and not n.linked(a, a[:84])
    assert n.linked(a, a) and not n.linked(a, a + np.uint64(50))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(159, 200), (5, 5), (101, 100)]
    found = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 160)}, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
