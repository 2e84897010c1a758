import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest

from pulsegrid.llm import training_order as t
from pulsegrid.llm.byte_tokens import ByteEncoder
from pulsegrid.sources.settle import shared_folder

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_the_permutation_is_a_bijection(n):
    order = t.Permutation(n, 99)
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert order.indexes(slots).tolist() == list(range(n))
    if n > 10:
        assert t.Permutation(n, 100).slots(np.arange(n)).tolist() != slots.tolist()


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(i, f"document {i} " + "words and lines\n" * (i % 40)) for i in range(120)]
    texts += [(200, None), (201, ""), (202, "<|endoftext|>"), (7, "again"), (None, "no id")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as slot", "'x' as shard")
    return frame.repartition(5), texts


def test_shards_hold_every_id_once(spark, docs):
    frame, texts = docs
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    parts = t.materialise(frame, RANKS, path, size=32, per_shard=8).collect()
    sums = {r.slot: r.ids_crc32 for r in t.record_checksums(spark, path, 32, 8).collect()}
    records = {r.slot: np.frombuffer(r.ids, "<u2").tolist() for r in t.read_records(spark, path, 32, 8).collect()}
    assert sorted(records) == list(range(len(records))) and len(records) > 3 * 8 * t.SHARDS_PER_TASK
    assert sums == {slot: zlib.crc32(np.array(ids, "<u2").tobytes()) for slot, ids in records.items()}
    files = {r.shard: r.n_bytes for r in t.shard_files(spark, path).select("shard", "n_bytes").collect()}
    assert sorted(files) == list(range(-(-len(records) // 8)))
    assert all(n == 8 * t.stride(32) for k, n in files.items() if k < max(files))
    encoder, found = ByteEncoder(RANKS, 2), {}
    for r in parts:
        assert (r.shard, r.position) == (r.slot // 8, r.slot % 8)
        found.setdefault(r.doc_id, []).append((r.start, records[r.slot][r.offset : r.offset + r.length]))
    expected = {}
    for doc, text in texts:
        expected.setdefault(doc, []).append(np.frombuffer(encoder.encode(text), "<u2").tolist() + [0])
    for doc, wanted in expected.items():
        held = sorted(found[doc], key=lambda part: part[0])
        if len(wanted) > 1:  # rows with one doc_id: each has all of its ids, in parts that start where the one before ends
            ends = {start + len(ids) for start, ids in held}
            assert sum(len(ids) for _, ids in held) == sum(map(len, wanted))
            assert sorted(i for _, ids in held for i in ids) == sorted(i for ids in wanted for i in ids)
            assert {len(ids) for ids in wanted} <= ends and sum(start == 0 for start, _ in held) == len(wanted)
        else:
            assert [i for _, ids in held for i in ids] == wanted[0]
    later = t.read_records(spark, path, 32, 8, first_slot=13).collect()
    assert sorted(r.slot for r in later) == list(range(13, len(records)))


def test_writing_goes_on_where_it_stopped(spark, docs):
    frame, _ = docs
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    rows, total = t.indexed(t.stored(t.sequences(frame, RANKS, 32), f"{path}-sequences"))
    rows = t.with_slots(rows, total, per_shard=8)
    t.write_shards(rows.where("shard < 3"), total, path, 32, 8)
    before = {r.path: r.modificationTime for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()}
    found = t.materialise(frame, RANKS, path, 32, 8, resume=True)
    after = {r.path: r.modificationTime for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).collect()}
    assert before.items() <= after.items()
    records = {r.slot: r.ids for r in t.read_records(spark, path, 32, 8).collect()}
    assert sorted(records) == list(range(total))
    whole = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    assert sorted(map(str, found.collect())) == sorted(map(str, t.materialise(frame, RANKS, whole, 32, 8).collect()))
    assert records == {r.slot: r.ids for r in t.read_records(spark, whole, 32, 8).collect()}


def test_an_empty_table_gives_no_record(spark, docs):
    path = f"{shared_folder(spark)}/shards-{uuid.uuid4().hex}"
    assert t.materialise(docs[0].limit(0), RANKS, path, 32, 8).collect() == []
    assert t.read_records(spark, path, 32, 8).collect() == []
