"""The pipeline on a small corpus whose right result is known."""

import random

import corpus_pipeline
from pulsegrid.llm import packing, queries
from pulsegrid.llm.byte_tokens import ByteEncoder
import public_tokenizers


def prose(rng, n):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(n))


def build(spark, folder):
    rng = random.Random(8)
    common = prose(rng, 400).split()
    text = lambda k: " ".join(rng.choices(common, k=k))
    docs = {i: text(rng.randint(30, 300)) for i in range(600)}
    toxic = {i for i in docs if i % 10 == 0}
    for i in toxic:
        docs[i] += " grumpf wazzle " + text(5) + " snark grumpf"
    item = prose(rng, 30)
    planted = {
        "copy": 701, "near": 702, "leak": 703, "junk": 704, "short": 705,
    }
    docs[701] = docs[1]
    docs[702] = docs[3] + " " + text(200)
    docs[3] = docs[702] + " one more"
    docs[703] = text(40) + " " + item + " " + text(40)
    docs[704] = " ".join(w + "%%%$$$" for w in text(100).split())
    docs[705] = "too short"
    rows = [(i, t, "en", "s", len(t)) for i, t in docs.items()] + [(800, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i in toxic)) for i in docs if i < 600]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    gone = toxic | {701, 702, 703, 704, 705, 800}
    return docs, gone


def test_each_stage_takes_its_documents(spark, tmp_path):
    docs, gone = build(spark, str(tmp_path))
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(docs) - gone - {702} | ({3} - gone)
    encoder = ByteEncoder(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    lengths = {}
    for r in rows:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
        assert 0 <= r.offset and r.offset + r.length <= packing.SEQUENCE
    assert all(n == len(encoder.encode(docs[i])) // 4 + 1 for i, n in lengths.items())


def test_stages_keep_the_columns(spark, tmp_path):
    build(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns


def test_the_stage_takes_copies_from_a_jaccard_index_of_80_percent_on(spark, tmp_path):
    rng, rows = random.Random(11), []
    for first, shingles, kept in ((1, 100, 80), (11, 100, 82), (21, 100, 79), (31, 1250, 1000), (41, 1250, 1025), (51, 1200, 948)):
        words = prose(rng, shingles + 4).split()
        rows += [(first, " ".join(words)), (first + 1, " ".join(words[: kept + 4]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    stays = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()}
    assert stays == {1, 11, 21, 22, 31, 41, 51, 52}


def test_every_operator_has_a_query():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))


def test_no_stage_sends_large_batches(spark, tmp_path):
    """The driver writes what a stage returns, by its own settings: by then it must be stored."""
    build(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert "MapInArrow" not in docs._jdf.queryExecution().executedPlan().toString(), name
