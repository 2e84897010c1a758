import random

import public_tokenizers
import pytest
import sentencepiece

from pulsegrid.llm import token_counts as t

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def hard_texts():
    rng = random.Random(3)
    mixed = "".join(rng.choices(["the ", "word", " ", "\n", "é", "日本", "▁", "<s>", "xx", "  ", "\t"], k=1500))
    return [
        mixed,
        "a" * 3000,
        "ab " * 900 + "x" * 2000 + " y z" * 300,
        "  " * 1500,
        "é\n" * 1500,
        "▁a b" * 600,
        "日本語 " * 500,
        "日本語" * 600,
        " a" * 900 + " " * 60,
    ]


@pytest.mark.parametrize("chunk, overlap", [(64, 4), (100, 10), (997, 3), (1000, 600)])
def test_spliced_chunks_give_the_whole_texts_tokens(model, chunk, overlap):
    for text in hard_texts():
        assert t.encode_long(model, text, chunk, overlap) == model.encode(text)


def test_stable_places_are_proven_from_the_vocabulary(model):
    assert t._splits_before_spaces(model)
    assert [i for i in range(5) if t._stable(b"a b  ", i)] == [1, 3]
    assert not t._stable("▁ a".encode(), 3)


def test_counts_of_all_rows(spark, model):
    given = [(1, "hello world <s>"), (2, None), (3, ""), (3, "twice"), (3, "twice"), (None, "no id"), (4, hard_texts()[0])]
    docs = spark.createDataFrame(given, "doc_id long, text string").selectExpr("*", "'x' as n_tokens", "1 as over_limit")
    rows = t.count_tokens(docs, PATH, limit=2, chunk_bytes=200, overlap_bytes=8).collect()
    want = sorted(
        (d or 0, len((x or "").encode()), len(model.encode(x or "")), len(model.encode(x or "")) > 2) for d, x in given
    )
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert t.count_tokens(docs.limit(0), PATH).collect() == []
