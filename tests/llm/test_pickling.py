"""Executors need no copy of the package: what runs in tasks is pickled by value."""

import pickle
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from pulsegrid.llm import (
    chat,
    decontamination,
    hard_negatives,
    html_text,
    near_duplicates,
    packing,
    quality,
    queries,
    simhash,
    token_counts,
    toxicity,
    training_order,
    url_filter,
)
from pulsegrid.sources.settle import settle, shared_folder

BARE = """
import pickle, sys
sys.path = [p for p in sys.path if p not in ("", {root!r})]
try:
    import pulsegrid
except ImportError:
    pass
else:
    raise SystemExit("the package can be imported")
for name, data in pickle.load(open({path!r}, "rb")):
    try:
        pickle.loads(data)
    except Exception as error:
        raise SystemExit(f"{{name}}: {{error!r}}")
"""


@pytest.fixture
def caught(spark, monkeypatch):
    """All functions that are handed to Spark."""
    found, frame = [], type(spark.range(0))
    for kind in ("mapInArrow", "mapInPandas"):
        real = getattr(frame, kind)
        monkeypatch.setattr(frame, kind, lambda self, f, *a, _real=real, **k: (found.append(f), _real(self, f, *a, **k))[1])
    real = F.pandas_udf
    monkeypatch.setattr(F, "pandas_udf", lambda *a, **k: lambda f: (found.append(f), real(*a, **k)(f))[1])
    return found


def test_task_functions_load_without_the_package(spark, caught, tmp_path):
    text = "some words that stand here and are long enough for all rules of the base " * 3
    docs = spark.createDataFrame([(k, f"{text} {k}", "en", "web", 9) for k in range(40)], "doc_id long, text string, lang string, source string, n_chars int")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(40)], "doc_id long, quality int, toxic int")
    pages = spark.createDataFrame([(1, "http://a.com/x", "<p>hello</p>")], "page_id long, url string, html string")
    turns = spark.createDataFrame([(1, 0, "user", "x"), (1, 1, "assistant", "y")], "conv_id long, turn long, role string, text string")
    items = spark.createDataFrame([(1, "a benchmark item with some words")], "item_id long, text string")
    vectors = spark.createDataFrame([(k, [0.1 * k, 0.5], k % 2) for k in range(1, 40)], "vec_id long, embedding array<float>, label int")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")

    url_filter.judge(pages, queries.URL_RULES)
    quality.judge(docs)
    html_text.extract(pages)
    chat.digests(chat.format_turns(turns))
    token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    near_duplicates.sketches(docs, 80)
    sets = near_duplicates.full_sets(docs, docs.selectExpr("doc_id as cls"), 80)
    near_duplicates.confirmed(spark.createDataFrame([(1, 2)], "a long, b long"), sets, 80)
    near_duplicates.stray_links(docs.selectExpr("1L as key", "doc_id as cls", "doc_id as label", "0L as centre"), sets, 80)
    decontamination.leaks(docs, items)
    packing.assign(settle(packing.token_pieces(docs, ranks).drop("ids")))
    toxicity.judge(docs, labels)
    path = f"{shared_folder(spark)}/pickled-shards"
    training_order.materialise(docs, ranks, path)
    training_order.read_records(spark, path)
    training_order.record_checksums(spark, path)
    queries.trie_of(turns)
    rows = hard_negatives.vectors(vectors, F.col("label"))
    hard_negatives.hard_negatives(rows, F.col("vec_id") % 10 == 0)
    simhash.fingerprints(docs)
    fps = spark.createDataFrame([(5,)], "fp long")
    simhash.links(simhash.variants_by_bucket(fps, 10, 0))

    assert len(caught) > 25
    stored = tmp_path / "functions"
    stored.write_bytes(pickle.dumps([(f"{f.__module__}.{f.__qualname__}", cloudpickle.dumps(f)) for f in caught]))
    root = str(Path(__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", BARE.format(root=root, path=str(stored))], cwd=tmp_path, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
