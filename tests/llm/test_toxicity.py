import random
import zlib

import numpy as np
import pytest

from pulsegrid.llm import toxicity as t

BAD = ["grumpf", "wazzle", "snark"]


def rows(n, seed=1, start=0):
    rng = random.Random(seed)
    common = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 6))) for _ in range(300)]
    out = []
    for i in range(start, start + n):
        words = rng.choices(common, k=rng.randint(5, 120))
        toxic = i % 5 == 0
        if toxic:
            for bad in rng.sample(BAD, 2):
                words[rng.randrange(len(words))] = rng.choice([bad, bad.upper() + "!!", bad + "ed"])
        out.append((i, " ".join(words), ("en", "de", None)[i % 3], int(toxic)))
    return out


@pytest.fixture(scope="module")
def tables(spark):
    given = rows(900)
    docs = spark.createDataFrame([r[:3] for r in given], "doc_id long, text string, lang string").selectExpr("*", "1 as score", "'x' as toxic")
    labels = spark.createDataFrame([(r[0], r[3]) for r in given], "doc_id long, toxic int").selectExpr("*", "1 as quality", "'y' as lang")
    return given, docs, labels


def test_held_out_rows_are_told_apart(spark, tables):
    given, docs, labels = tables
    found = {r.doc_id: r for r in t.judge(docs, labels).collect()}
    held = [g for g in given if zlib.crc32(str(g[0]).encode()) % 4 == 2]
    assert {r.doc_id for r in found.values() if r.held_out} == {g[0] for g in held}
    right = sum(found[g[0]].predicted == g[3] for g in held) / len(held)
    assert len(held) > 150 and right > 0.97
    assert sum(found[g[0]].toxic == bool(g[3]) for g in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())


def test_held_out_labels_are_never_read(spark, tables):
    given, docs, labels = tables
    flipped = [(g[0], 1 - g[3] if zlib.crc32(str(g[0]).encode()) % 4 == 2 else g[3]) for g in given]
    other = spark.createDataFrame(flipped, "doc_id long, toxic int")
    one = {r.doc_id: r.score for r in t.judge(docs, labels).collect()}
    two = {r.doc_id: r.score for r in t.judge(docs, other).collect()}
    assert one == two


def test_a_late_word_counts_in_a_long_text():
    given = rows(900)
    model = t.fit([g[1].encode() for g in given], np.array([g[3] for g in given], np.float32), ["en"] * 900, range(900), 0.2)
    filler = " ".join(g[1] for g in given if not g[3])
    clean, toxic = model.scores(t.new_reader(), [filler.encode(), (filler + " grumpf wazzle").encode()])
    assert clean < 0.3 <= toxic
    empty = model.scores(t.new_reader(), [None, b"", b" 12 !"])
    assert empty == pytest.approx([0.2] * 3)


def test_the_gradient_is_the_slope_of_the_loss():
    s = t.Settings(word_rows=64, prefix_rows=32, size=4, filters=3)
    model, reader = t.Model.fresh(s), t.new_reader()
    texts, toxic = [b"aa bb cc dd", b"ee ff", b"gg hh ii"], np.array([1, 0, 1], np.float32)
    words, *places = t._words(reader, texts, s)
    caught = {}
    trainer = t.Trainer(model)
    trainer._step = lambda name, values, gradient: caught.setdefault(name, gradient.copy())
    trainer._row_step = lambda name, table, at, gradient: caught.setdefault(name, (at, gradient.copy()))
    shift = model.shift
    trainer.step(words, *places, toxic)
    model.shift = shift

    def loss():
        pooled = model.pooled(words, *places)[0].astype(float)
        p = 1 / (1 + np.exp(-(pooled @ model.top + model.shift)))
        return -np.mean(toxic * np.log(p) + (1 - toxic) * np.log(1 - p))

    def slope(array, at, step=1e-2):
        before = array[at]
        array[at] = before + step
        high = loss()
        array[at] = before - step
        low = loss()
        array[at] = before
        return (high - low) / (2 * step)

    for width in s.widths:
        for at in np.ndindex(model.conv[width].shape):
            assert caught[f"conv{width}"][at] == pytest.approx(slope(model.conv[width], at, 1e-3), abs=2e-3)
    at, gradient = caught["word"]
    total = np.zeros_like(model.word)
    np.add.at(total, at, gradient)
    for row in set(at.tolist()):
        assert total[row, 1] == pytest.approx(slope(model.word, (row, 1), 1e-3), abs=2e-3)


def test_rows_of_all_kinds(spark, tables):
    _, docs, labels = tables
    more = spark.createDataFrame([(5, None, None), (5, "", "en"), (None, "grumpf wazzle", "de")], "doc_id long, text string, lang string")
    model = t.train(docs, labels)
    found = t.score(more, model).collect()
    assert len(found) == 3 and all(0 <= r.score <= 1 for r in found)
    assert t.score(more.limit(0), model).collect() == []
    stays = t.accept(more.selectExpr("*", "1 as n_chars"), model)
    assert stays.columns == ["doc_id", "text", "lang", "n_chars"] and sorted(r.text or "" for r in stays.collect()) == ["", ""]


def test_the_sample_holds_one_row_of_an_id(spark, tables):
    """An id that very many rows repeat, and ids whose texts are all too long, do not fill the sample."""
    given, docs, labels = tables
    docs = docs.select("doc_id", "text", "lang")
    many = spark.range(100_000).selectExpr("0L as doc_id", "concat('row ', id % 7) as text", "'en' as lang")
    long = docs.where("doc_id % 2 = 1").selectExpr("doc_id", "repeat('x ', 20000) as text", "lang")
    known = labels.selectExpr("doc_id", "toxic")
    sample = t._sample(docs.where("doc_id % 2 = 0").unionByName(many).unionByName(long), known, t.Settings(toxic=60, clean=90)).collect()
    assert sum(r.toxic for r in sample) == 60 and len(sample) == 150
    assert len({r.doc_id for r in sample}) == 150 and all(r.doc_id % 2 == 0 for r in sample)
    texts = {g[0]: g[1] for g in given}
    assert all(r.text == texts[r.doc_id] for r in sample if r.doc_id)
    every = t._sample(docs.unionByName(many), known, t.Settings()).collect()
    assert [r.text for r in every if r.doc_id == 0] == [min(texts[0], "row 0")]


def test_without_labels_the_score_is_the_share(spark, tables):
    _, docs, labels = tables
    none = t.judge(docs, labels.limit(0)).select("score").distinct().collect()
    assert len(none) == 1 and none[0].score < 0.3
    assert t.judge(docs.limit(0), labels).collect() == []
    null = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert t.judge(docs, null).where("score > 0.3").count() == 0


def test_rows_beyond_the_start_are_learned(spark, tables):
    """A word of long texts, which the start leaves out, tells toxic rows; all rows calibrate, in any order of the table."""
    given, docs, labels = tables
    rng = random.Random(3)
    common = sorted({w for g in given if not g[3] for w in g[1].split()})
    long = [(10_000 + k, " ".join(rng.choices(common, k=200) + ["zorkle"] * (k % 2)), "en", k % 2) for k in range(240)]
    s = t.Settings(longest=800)
    assert min(len(g[1]) for g in long) > s.longest >= max(len(g[1]) for g in given)
    docs = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame([g[:3] for g in long], "doc_id long, text string, lang string"))
    labels = labels.select("doc_id", "toxic").unionByName(spark.createDataFrame([(g[0], g[3]) for g in long], "doc_id long, toxic int"))
    found = {r.doc_id: r.score for r in t.judge(docs, labels, s).collect()}
    bad, good = [[found[g[0]] for g in long if g[3] == kind] for kind in (1, 0)]
    assert np.mean(bad) > np.mean(good) + 0.1
    s = t.Settings(longest=800, shard=400, passes=1)
    model, other = t.train(docs, labels, s), t.train(docs.repartition(7), labels.repartition(3), s)
    assert (model.flat() == other.flat()).all() and model.thresholds == other.thresholds
    held = [i for i, *_ in given + long if t._for_calibration(i) and zlib.crc32(str(i).encode()) % 4 != 2]
    assert sum(n for _, _, n, _ in t._calibration_counts(docs, t._labelled(labels), model)) == len(held)


def test_texts_that_are_all_too_long_for_the_start(spark, tables):
    given, docs, labels = tables
    s = t.Settings(longest=1, batch=8)
    found = {r.doc_id: r.score for r in t.judge(docs, labels, s).collect()}
    bad, good = [[found[g[0]] for g in given if g[3] == kind] for kind in (1, 0)]
    assert np.mean(bad) > np.mean(good) + 0.2
