import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from pulsegrid.llm import byte_tokens
from pulsegrid.llm import packing as p
from pulsegrid.llm.byte_tokens import ByteEncoder
from pulsegrid.sources.settle import settle

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["hello world", "a  b\n\n c", "", "<|endoftext|> x <|endoftext|>", "日本 é 's 'LL 12345", " lead", "tail  ", "w " * 900]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_are_those_of_the_library(library):
    encoder = ByteEncoder(RANKS)
    rng = random.Random(5)
    hard = ["".join(rng.choices(["the", " ", "  ", "\n", "\t", "é", "'re", "42", "!!", "日", "\u0085", "\x1c"], k=60)) for _ in range(200)]
    for text in [*TEXTS, *hard]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("blank", [" ", "\n", "\u3000", " \n"])
def test_long_white_space_runs_have_the_ids_of_the_library(library, blank):
    run = blank * (2_000_000 // len(blank))
    encoder = ByteEncoder(RANKS)
    for text in (run, f"a{run}b", f"a {run}<|endoftext|>{run}\x1c{run[:150_000]}'re"):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_cut_runs_have_the_ids_of_the_library(library, monkeypatch):
    monkeypatch.setattr(byte_tokens, "LONG_RUN", 3)
    encoder = ByteEncoder(RANKS)
    rng = random.Random(6)
    parts = ["the", " ", "   ", "\n", "\t", "é", "'re", "42", "!!", "日", "\u0085", "\x1c", "\u2028", "<|endoftext|>"]
    for text in ["".join(rng.choices(parts, k=40)) for _ in range(400)]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def best_fit_by_scan(lengths, size, most):
    bins, made, out = {}, 0, []
    for n in lengths:
        fitting = [(free, -k) for k, free in bins.items() if free >= n]
        if fitting:
            free = min(fitting)[0]
            k = [b for b, f in bins.items() if f == free][-1]
        else:
            k, free, made = made, size, made + 1
        out.append(size - free)
        bins.pop(k, None)
        left = free - n
        if left:
            if len(bins) == most:
                fullest = min(bins.values())
                if left <= fullest:
                    continue
                bins.pop([b for b, f in bins.items() if f == fullest][-1])
            bins[k] = left
    return out, made


@pytest.mark.parametrize("most", [1, 3, 20, 1000])
def test_best_fit_matches_a_scan_over_all_bins(most):
    rng = random.Random(most)
    lengths = [rng.randint(1, 50) for _ in range(600)]
    fit = p.BestFit(50, most)
    placed = [fit.place(n) for n in lengths]
    offsets, made = best_fit_by_scan(lengths, 50, most)
    assert [at for _, at in placed] == offsets and fit._made == made
    filled = {}
    for (k, at), n in zip(placed, lengths, strict=True):
        assert filled.get(k, 0) == at and at + n <= 50
        filled[k] = at + n
    with pytest.raises(ValueError):
        fit.place(51)


def test_cut_keeps_the_short_piece_first():
    assert p.cut(5, 8) == [(0, 5)]
    assert p.cut(16, 8) == [(0, 8), (8, 8)]
    assert p.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def test_sequences_hold_all_ids(spark, library):
    given = [(i, t) for i, t in enumerate(TEXTS)] + [(98, None)]
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "7 as piece", "'x' as offset")
    pieces = settle(p.token_pieces(docs, RANKS, 16))
    placed = settle(p.place(pieces, 16))
    sequences = {r.sequence_id: np.frombuffer(r.ids, "<u4") for r in p.packed_ids(pieces, placed).collect()}
    documents, used = {}, {}
    for r in sorted(placed.collect(), key=lambda r: (r.doc_id, r.piece)):
        ids = sequences[r.sequence_id][r.offset : r.offset + r.length]
        assert zlib.crc32(ids.tobytes()) == r.ids_crc32
        assert r.start == len(documents.setdefault(r.doc_id, []))
        documents[r.doc_id] += ids.tolist()
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc, text in given:
        assert documents[doc] == library.encode(text or "", add_special_tokens=False).ids + [0]
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 16
    total = sum(map(len, documents.values()))
    assert len(used) <= -(-total // 16) + 1


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "same"), (1, "same"), (None, "no id")], "doc_id long, text string")
    rows = p.pack(docs, RANKS, 16).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert p.pack(docs.limit(0), RANKS, 16).collect() == []
