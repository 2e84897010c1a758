import random
import re

import numpy as np
import xxhash

from pulsegrid.llm import simhash as s

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, most=4):
    """(doc_id, fingerprint, component) of each row, by all pairs."""
    prints = [(doc, brute_fingerprint(text)) for doc, text in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(prints):
        for j, (b, y) in enumerate(prints[:i]):
            if (x ^ y).bit_count() <= most or (a is not None and a == b):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, f"{x:016x}", least.get(top(i))) for i, (doc, x) in enumerate(prints)), key=str)


def found(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as fp", "'x' as component_id", "2 as label")
    return sorted((tuple(r) for r in s.near_duplicates(docs, **settings).collect()), key=str)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    texts = [words(rng.randint(1, 40)) for _ in range(40)]
    for size in (3, 4, 30, 200, 900):
        base = words(size)
        texts += [base, base, [w.upper() for w in base]]
        for k in range(12):  # a chain of small edits
            base = list(base)
            base[rng.randrange(size)] = f"n{k}"
            texts.append(base)
    rng.shuffle(texts)
    rows = list(enumerate("\t ".join(t) for t in texts))
    return [*rows, (900, ""), (901, None), (902, " \n\x0b"), (903, "a b c"), (None, rows[3][1]), (None, "alone in the null"), (5, rows[9][1])]


def test_components_match_all_pairs(spark):
    rows = corpus(4)
    want = brute(rows)
    assert found(spark, rows) == want
    assert len({c for _, _, c in want}) < len({f for _, f, _ in want})  # some links join unlike fingerprints


def test_passes_and_small_chunks_change_nothing(spark, monkeypatch):
    rows = corpus(5)
    for name, value in (("CHUNK", 5000), ("HELD", 9000), ("LINKS", 10), ("BUCKET", 500)):
        monkeypatch.setattr(s, name, value)
    assert found(spark, rows, passes=3) == brute(rows)


def test_links_end_at_the_radius(spark):
    rng = random.Random(6)
    base = [rng.getrandbits(64) for _ in range(30)]
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    values = base + [flip(x, k) for x, k in zip(base, [0, 1, 2, 3, 4, 5] * 5, strict=True)]
    signed = np.unique(np.array(values, np.uint64)).view(np.int64).tolist()
    classes = s.settle(spark.createDataFrame([(v,) for v in signed], "fp long"))
    labels = {r.node: r.label for r in s.linked_classes(classes).collect()}
    near = lambda x, y: (x ^ y).bit_count() <= 4
    for x, k in zip(base, [0, 1, 2, 3, 4, 5] * 5, strict=True):
        x = int(np.array(x, np.uint64).view(np.int64))
        alone = not any(near(x & (1 << 64) - 1, v) for v in values if v != x & (1 << 64) - 1)
        assert (x in labels) == (not alone), k


def test_half_radius_of_one(spark):
    rows = corpus(7)
    assert found(spark, rows, half=1, passes=2) == brute(rows, 2)


def test_a_star_links_all_of_a_variant():
    masks = s.flip_masks()
    assert len(masks) == 1 + 64 + 64 * 63 // 2 and len(set(masks.tolist())) == len(masks)
    v = np.uint64(77)
    near = masks[[5, 9, 100, 2000]]
    links = s.ball_links(v ^ near, near)
    assert len(links) == 3 and set(links[:, 0].tolist()) == {int((v ^ near).min())}


def test_long_texts_are_read_in_pieces(monkeypatch):
    rng = random.Random(8)
    text = " ".join("".join(rng.choices("abcD", k=rng.randint(1, 9))) for _ in range(3000))
    monkeypatch.setattr(s, "PIECE", 50)
    assert s.fingerprint(text.encode()) == brute_fingerprint(text)
    for short in ("", "a", "a b c", "a b c d", "x" * 300, " " * 300, "a b c " + " " * 100):
        assert s.fingerprint(short.encode()) == brute_fingerprint(short)


def test_a_hash_equals_the_engines_own(spark):
    text = "One twö three four"
    row = spark.createDataFrame([(text.lower(),)], "t string").selectExpr("xxhash64(t) as h").first()
    assert next(s.shingle_hashes(text.lower().encode()))[0] == np.array(row.h).view(np.uint64)


def test_many_copies_are_one_class(spark):
    rows = [(k, "the same few words again and again") for k in range(500)] + [(1000, "other words that stand here alone")]
    assert {c for _, _, c in found(spark, rows)} == {0, 1000}


def test_an_empty_table(spark):
    assert found(spark, []) == []


def test_a_dense_cluster_makes_few_links(spark, monkeypatch):
    rng, made, links = random.Random(9), [], s.links

    def counted(*args):
        out = s.settle(links(*args))
        made.append(out.count())
        return out

    monkeypatch.setattr(s, "links", counted)
    flip = lambda x, k: x ^ sum(1 << b for b in rng.sample(range(64), k))
    centre = rng.getrandbits(64)
    values = {flip(centre, rng.randint(0, 3)) for _ in range(1200)}
    signed = np.array(sorted(values), np.uint64).view(np.int64).tolist()
    labels = s.linked_classes(s.settle(spark.createDataFrame([(v,) for v in signed], "fp long")))
    assert {tuple(r) for r in labels.collect()} == {(v, min(signed)) for v in signed}
    assert sum(made) < 15 * len(values), made
