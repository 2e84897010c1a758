import random

import pytest

from pulsegrid.llm import decontamination as d


def least_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        above, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != t), above[j] + 1, row[j - 1] + 1))
    return min(row)


def test_myers_gives_the_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        pattern = "".join(rng.choices("abc", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc", k=rng.randint(0, 120)))
        if rng.random() < 0.5:
            text = text[:20] + pattern[: len(pattern) // 2] + "x" + pattern[len(pattern) // 2 :] + text[20:]
        assert d.Pattern(pattern).best(text)[0] == least_distance(pattern, text)


def test_pieces_cover_the_item():
    for length in (1, 19, 20, 21, 100, 399):
        item = "".join(random.Random(length).choices("abcdef", k=length))
        parts = d.pieces(item)
        assert "".join(p for _, p in parts) == item and len(parts) == d.budget_of(length) + 1
        assert all(item[at : at + len(p)] == p for at, p in parts)


def sentence(rng, k):
    return " ".join("".join(rng.choices("abcdefghijklm", k=rng.randint(2, 8))) for _ in range(k))


def edit(rng, text, k):
    out = list(text)
    for _ in range(k):
        at, kind = rng.randrange(len(out)), rng.randrange(3)
        if kind == 0:
            out[at] = "z"
        elif kind == 1:
            out.insert(at, "z")
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize("block_chars", [4_000_000, 500])
def test_leaks_match_brute_force(spark, block_chars):
    rng = random.Random(6)
    items = [(i, sentence(rng, rng.randint(1, 30))) for i in range(25)] + [(90, ""), (91, None), (92, "  ")]
    docs = []
    for i in range(60):
        parts = [sentence(rng, rng.randint(0, 40))]
        if i % 2:
            item = items[rng.randrange(25)][1]
            parts += [edit(rng, item, rng.randint(0, 1 + len(item) // 15)).upper().replace(" ", " \n"), sentence(rng, 20)]
        docs.append((i, " ".join(parts)))
    docs += [(70, None), (71, ""), (72, items[3][1] + " x " + items[4][1]), (72, items[3][1])]
    want = set()
    for doc, text in docs:
        for item, pattern in items:
            p, t = d.normalised(pattern), d.normalised(text)
            if p and t and (found := least_distance(p, t)) <= d.budget_of(len(p)):
                want.add((doc, item, found))
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "'x' as distance")
    bench = spark.createDataFrame(items + items[:5], "item_id long, text string").selectExpr("*", "7 as doc_id")
    found = d.leaks(frame, bench, block_chars=block_chars).collect()
    assert {(r.doc_id, r.item_id, r.distance) for r in found} == want and len(want) > 15
    assert len([r for r in found if r.doc_id == 72 and r.item_id == 3]) == 2
    stays = d.clean(frame.selectExpr("doc_id", "text", "item_id as lang"), bench, block_chars=block_chars)
    dirty = {doc for doc, *_ in want}
    assert sorted(r.doc_id for r in stays.collect()) == sorted(doc for doc, _ in docs if doc not in dirty)
    assert stays.columns == ["doc_id", "text", "lang"]


def test_one_block_at_a_time(spark, monkeypatch):
    """A block is fetched when the pass of the one before is stored; plans do not grow with the blocks."""
    rng = random.Random(7)
    items = [(i, sentence(rng, 30)) for i in range(40)] + [(None, "nameless item of the benchmark")]
    docs = [(i, sentence(rng, 10) + " " + items[i][1]) for i in range(41)] + [(50, "nothing of it")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    log = []
    fetch, store = d.Blocks.fetch, d.settle_all
    monkeypatch.setattr(d.Blocks, "fetch", lambda self, k: log.append(f"fetch {k}") or fetch(self, k))

    def stored(frames):
        def noted():
            for frame in frames:
                log.append("pass")
                yield frame

        return store(noted())

    monkeypatch.setattr(d, "settle_all", stored)
    found = d.leaks(docs, bench, block_chars=1500)
    blocks = len(log) // 2
    assert blocks > 3 and log == [entry for k in range(blocks) for entry in (f"fetch {k}", "pass")]
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i in range(40)}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    stays = d.clean(docs, bench, block_chars=1500)
    assert [r.doc_id for r in stays.collect()] == [50]
    assert stays._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "text")], "item_id long, text string")
    assert d.leaks(docs.limit(0), bench).collect() == [] == d.leaks(docs, bench.limit(0)).collect()
    assert d.clean(docs, bench.limit(0)).count() == 1 and d.clean(docs, bench).count() == 0
