import random
import re
from collections import Counter

import numpy as np
import pytest

from pulsegrid.llm import quality as q


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = list(zip(*[words[k:] for k in range(5)], strict=False))
    often, covered = Counter(windows), set()
    for k, window in enumerate(windows):
        if often[window] > 1:
            covered |= set(range(k, k + 5))
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)]


def test_statistics_of_whole_texts(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a ", "b ", "é# ", "\n", "c\n", "|", " \t", "日"], k=rng.randint(0, 120))) for _ in range(80)]
    texts += [None, "", " \n ", "x" * 5000, "a b c d e " * 400, "one\r\none\r\n", "\n\n\n"]
    rows = [(i, t, None if i % 7 == 0 else "en", "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "9 as n_words", "'x' as kept")
    found = {r.doc_id: r for r in q.judge(docs).collect()}
    for doc, text, *_ in rows:
        r, want = found[doc], brute(text)
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words] == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert r.kept <= (not r.base_failed)
    assert q.judge(docs.limit(0)).collect() == []


def test_chi_squared():
    assert q.chi2_cdf(11.0705, 5) == pytest.approx(0.95, abs=1e-5)
    assert q.chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-4)
    assert q.consistency(1 - 1e-12, 5) == pytest.approx(1, abs=1e-6)


def points(rows, outliers, seed):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(5, 5))
    inner = rng.normal(size=(rows, 5)) @ mixed * 2 + 10
    outer = rng.normal(size=(outliers, 5)) + inner.mean(0) + 40 * np.array([1, -1, 1, 1, -1])
    return inner, outer


def mcd_by_numpy(x, s):
    """The same concentration steps, one group, with exact quantiles."""
    p, best = x.shape[1], None
    quartile = np.quantile(x, [0.25, 0.5, 0.75], axis=0)
    scale = np.maximum((quartile[2] - quartile[0]) / 1.349, s.floors)
    centre, cov = quartile[1], np.diag(scale**2)
    for _ in range(s.steps):
        d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
        inner = x[d <= np.quantile(d, s.share)]
        centre = inner.mean(0)
        cov = np.cov(inner.T, bias=True) * q.consistency(s.share, p) + np.diag(np.array(s.floors) ** 2)
        best = centre, cov
    centre, cov = best
    d = np.einsum("ij,jk,ik->i", x - centre, np.linalg.inv(cov), x - centre)
    inner = x[d <= q.chi2_quantile(0.975, p)]
    return inner.mean(0), np.cov(inner.T, bias=True) * q.consistency(0.975, p) + np.diag(np.array(s.floors) ** 2)


def test_estimates_resist_a_quarter_of_outliers(spark):
    s = q.Settings()
    groups = {"a": points(800, 180, 1), "b": points(500, 0, 2)}
    rows = [(g, *map(float, x)) for g, parts in groups.items() for x in np.concatenate(parts)]
    frame = spark.createDataFrame(rows, "grp string, x0 double, x1 double, x2 double, x3 double, x4 double")
    found = {r.grp: r for r in q.robust_estimates(frame, s).collect()}
    for g, (inner, outer) in groups.items():
        centre, cov = mcd_by_numpy(np.concatenate([inner, outer]), s)
        ours, inverse = np.array(found[g].centre), np.array(found[g].inverse).reshape(5, 5)
        assert np.allclose(ours, centre, atol=0.25)
        assert np.allclose(np.linalg.inv(inverse), cov, rtol=0.2, atol=0.6)
        d = np.einsum("ij,jk,ik->i", outer - ours, inverse, outer - ours)
        assert (d > s.cutoff).all()
        d = np.einsum("ij,jk,ik->i", inner - ours, inverse, inner - ours)
        assert (d < s.cutoff).mean() > 0.999


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(n))


def test_outliers_go_and_small_groups_are_pooled(spark):
    rng = random.Random(4)
    rows = []
    for i in range(400):
        lang, source = ("en", "big") if i < 200 else ("de", f"tiny{i}") if i < 300 else (None, "s")
        rows.append((i, prose(rng, rng.randint(20, 400)), lang, source))
    odd = {1000: ("en", "big"), 1001: ("de", "tiny250"), 1002: (None, "s")}
    rows += [(i, " ".join(w + "###$$$" for w in prose(rng, 120).split()), *key) for i, key in odd.items()]
    rows += [(2000, prose(rng, 50), "xx", "alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: (r.kept, r.distance) for r in q.judge(docs).collect()}
    assert all(kept[i][0] for i in range(400))
    assert not any(kept[i][0] for i in odd)
    assert kept[2000] == (True, None)
    more = docs.selectExpr("*", "length(text) as n_chars", "doc_id as n_words")
    stays = q.accept(more)
    assert stays.columns == more.columns
    assert sorted(r.doc_id for r in stays.collect()) == sorted(i for i, (k, _) in kept.items() if k)
