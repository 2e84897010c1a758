import random
import re

import numpy as np
import pyarrow as pa

from pulsegrid.llm import words as w


def texts(seed=1, n=60):
    rng = random.Random(seed)
    alphabet = ["a", "b", "É", "日", " ", " ", "\n", "\t", "\x0b", "\u00a0", "\x1c"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(n)] + [None, "", " ", "x" * 50]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_words_are_runs_between_white_space():
    given = texts()
    found = w.WordReader().read([t.encode() if t is not None else None for t in given])
    assert found.counts().tolist() == [len(split(t)) for t in given]
    every = [x for t in given for x in split(t)]
    assert len(set(found.hash.tolist())) == len(set(every))
    by_hash = dict(zip(found.hash.tolist(), every, strict=True))
    assert [by_hash[h] for h in found.hash.tolist()] == every


def test_windows_stay_within_a_text():
    given = ["a b c d e f", "a b", None, "a b c d e"]
    found = w.WordReader().read([t and t.encode() for t in given])
    at, windows = found.windows()
    assert found.text[at].tolist() == [0, 0, 3]
    assert windows[0] == windows[2] != windows[1]


def test_blocks_change_nothing(monkeypatch):
    given = [("wort " * 300 + "x" * 900 + " é " * 200).encode(), b"", b"y" * 3000, b"a b c"]
    whole = w.WordReader().read(given)
    monkeypatch.setattr(w, "BLOCK_BYTES", 64)
    small = w.WordReader().read(given)
    assert np.array_equal(whole.hash, small.hash) and np.array_equal(whole.text, small.text)
    assert np.array_equal(whole.prefix, small.prefix)


def test_lower_case_is_ascii_only():
    found = w.WordReader(lower=True).read(["ABC abc É é".encode()])
    a, b, c, d = found.hash.tolist()
    assert a == b and c != d


def test_text_blocks_cover_all_rows():
    column = pa.array(["abc", None, "", "x" * 100, "de"])
    parts = list(w.text_blocks(column, 10))
    assert [t for _, part in parts for t in part] == [b"abc", None, b"", b"x" * 100, b"de"]
    assert [at for at, _ in parts] == sorted({at for at, _ in parts})
    assert list(w.text_blocks(column.slice(1, 2), 10)) == [(0, [None, b""])]
    assert list(w.text_blocks(pa.array([], pa.string()))) == []
