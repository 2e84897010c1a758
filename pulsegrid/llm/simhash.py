"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's words are lower-cased (A-Z) runs of anything but white space. Its shingles are all windows
of four words, repeats included, joined by one space (with fewer words, the whole sequence as one);
h is a shingle's XXH64 with seed 42. A bit of the fingerprint is 1 if it is set in over half the h.
Documents are linked if their fingerprints differ in at most ``2 * HALF`` bits.

1. **Classes.** Rows with one fingerprint are one class, folded before the shuffle to the least
   doc_id. All that follows is about distinct fingerprints, however many copies there are.
2. **Balls.** Every fingerprint emits all variants with up to ``HALF`` flipped bits. Two that
   differ in at most 2 * HALF bits have a variant in common, halfway between them, and two that
   have one differ in no more than that. So nothing is missed and nothing has to be guessed.
3. **Shuffle on variants.** A variant's hash names its bucket. Tasks group their variants by
   bucket into blobs of (fingerprint, number of the flip mask, label), eighteen bytes each, so that
   the shuffle moves a few thousand blobs and not billions of rows. The number of buckets grows with
   the number of fingerprints, so a bucket keeps its size. Buckets are taken in passes, of which none
   holds more than one in ``PASSES``, which bounds the disk that their shuffle holds at a time.
4. **Deduplicate, verify.** A task rebuilds a bucket's variants and sorts them. The fingerprints
   of one variant lie in one ball and are all linked, so they form a star around the least label:
   a link less than labels, not all pairs. Repeated links of a task are dropped, the others
   are verified by their distance and give components.
5. **Contract.** A label is the least fingerprint of the component that the passes before have
   found. Links join labels, so fingerprints that are known to be connected make no link any more.
   The first pass takes few buckets, each of the next about four times as many as all before it:
   what is dense comes together there, from few links, before the many buckets are read. Every
   variant of every fingerprint is still looked at, and every link between two labels is kept.

Null and empty texts, and texts without words, have fingerprint zero and are linked like any other.
Long texts are read in pieces. Rows with the same doc_id are one node, through which the classes
of unlike texts are joined. A row with a null doc_id belongs to its class but names none; where no
row of a component has an id, component_id is null. Other columns are left out. An empty table
gives an empty result. There are no ties: every result is a minimum or a count.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.components import components
from pulsegrid.llm.frames import only, settle_few, tasks_for
from pulsegrid.llm.settings import shuffles_removed
from pulsegrid.sources.settle import settle

WORDS = 4
SEED = 42
HALF = 2
#: The last passes hold one in PASSES of the buckets each; the first of them is divided, from 1 / EARLY on.
PASSES, EARLY = 4, 64
#: (fingerprint, mask) pairs that a bucket holds on average at most, and buckets there are at least.
BUCKET, LEAST_BITS = 1 << 18, 10
#: Variants that a task makes at once, and pairs that it holds until they are written out as blobs.
CHUNK, HELD = 1 << 21, 1 << 21
PAIR = 18  # bytes of a pair in a blob
PIECE = 1 << 20  # bytes of a text that are split at once
LINKS = 1 << 20
CLASSES_PER_TASK = 100_000
BALLS_PER_TASK = 8_000

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WHITE = b" \t\n\x0b\x0c\r"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of a text, in lists that hold about so many bytes."""
    text, at = text.translate(_LOWER) if len(text) <= size else text, 0
    if len(text) <= size:
        yield text.split()
        return
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end] not in _WHITE:
            end += 1
        yield text[at:end].translate(_LOWER).split()
        at = end


def shingle_hashes(text: bytes | None) -> Iterator[np.ndarray]:
    """The hashes of all shingles, in order and in parts."""
    from xxhash import xxh64_intdigest

    held: list[bytes] = []
    any_whole = False
    for words in pieces(text or b""):
        held += words
        if len(held) >= WORDS:
            any_whole = True
            joined = b" ".join(held)
            ends = np.cumsum(np.fromiter(map(len, held), np.int64, len(held)) + 1) - 1
            starts = np.concatenate([[0], ends[: -WORDS] + 1]).tolist()
            yield np.fromiter(
                (xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[WORDS - 1 :].tolist(), strict=True)), np.uint64, len(starts)
            )
            held = held[1 - WORDS :]
    if held and not any_whole:
        yield np.array([xxh64_intdigest(b" ".join(held), SEED)], np.uint64)


def fingerprint(text: bytes | None) -> int:
    set_bits, n = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text):
        n += len(hashes)
        for at in range(0, len(hashes), 255 * 16):  # 255 rows add up in bytes
            part = hashes[at : at + 255 * 16]
            rows = np.zeros(-(-len(part) // 255) * 255, ">u8")
            rows[: len(part)] = part
            bits = np.unpackbits(rows.view(np.uint8)).reshape(-1, 255, 64)
            set_bits += bits.sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed number, for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty(batch.num_rows, np.uint64)
            for at, text in enumerate(batch.column("text")):
                found[at] = fingerprint(text.as_buffer().to_pybytes() if text.is_valid else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return only(docs, ("doc_id", "text"), "documents").mapInArrow(run, "doc_id long, fp long")


def flip_masks(half: int = HALF) -> np.ndarray:
    """All masks with up to ``half`` of 64 bits."""
    found = [sum(1 << b for b in bits) for k in range(half + 1) for bits in combinations(range(64), k)]
    return np.array(found, np.uint64)


def bucket_bits(n: int, half: int = HALF) -> int:
    """Of so many fingerprints' variants, a bucket holds ``BUCKET`` at most, on average."""
    return max(LEAST_BITS, (n * len(flip_masks(half)) // BUCKET).bit_length())


def _buckets(variants: np.ndarray, bits: int) -> np.ndarray:
    return ((variants * _SPREAD) >> np.uint64(64 - bits)).astype(np.uint32 if bits > 16 else np.uint16)


def pass_bounds(passes: int = PASSES) -> list[int]:
    """Where the passes begin and end in ``EARLY * passes`` equal parts of the buckets: 0, 1, 4, 16, then steps of ``EARLY``."""
    early = [4**k for k in range(EARLY.bit_length() // 2)]
    return [0, *early, *range(EARLY, EARLY * passes + 1, EARLY)]


def variants_by_bucket(classes: DataFrame, bits: int, number: int, passes: int = PASSES, half: int = HALF) -> DataFrame:
    """bucket and pairs (fingerprints, labels, then 16-bit numbers of masks) of the buckets of pass number of ``pass_bounds``.

    classes: fp, and label where components are known. A label is kept as its difference from the fingerprint, mostly zeros, which the shuffle packs well.
    """

    bounds = pass_bounds(passes)
    first, last, parts = bounds[number], bounds[number + 1], bounds[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, held, n = flip_masks(half), [], 0
        step = max(1, CHUNK // len(masks))

        def flush() -> Iterator[pa.RecordBatch]:
            bucket, fp, label, mask = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(bucket, kind="stable")
            bucket, fp, label, mask = bucket[order], fp[order].astype("<u8"), label[order].astype("<u8"), mask[order].astype("<u2")
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
            for at in range(0, len(cuts) - 1, 1024):
                ends = cuts[at : at + 1025]
                blobs = [fp[a:b].tobytes() + label[a:b].tobytes() + mask[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(bucket[ends[:-1]].astype(np.int32)), pa.array(blobs, pa.binary())], ["bucket", "pairs"])

        for batch in batches:
            all_fps, labels = (batch.column(c).to_numpy().view(np.uint64) for c in ("fp", "label"))
            for at in range(0, len(all_fps), step):
                fps, apart = all_fps[at : at + step], labels[at : at + step] ^ all_fps[at : at + step]
                bucket = _buckets(fps[:, None] ^ masks[None, :], bits)
                part = bucket.ravel() % parts
                found = np.flatnonzero((part >= first) & (part < last))
                row = found // len(masks)
                held.append((bucket.ravel()[found], fps[row], apart[row], (found - row * len(masks)).astype(np.uint16)))
                n += len(row)
                if n >= HELD:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    label = F.col("label") if "label" in classes.columns else F.col("fp")
    return classes.select("fp", label.alias("label")).mapInArrow(run, "bucket int, pairs binary")


def ball_links(fps: np.ndarray, masks: np.ndarray, labels: np.ndarray | None = None, most: int = 2 * HALF) -> np.ndarray:
    """Links (n x 2) between the labels whose fingerprints share a variant, a star for each variant.

    Without labels, every fingerprint is its own. ``most``: the distance up to which fingerprints are linked.
    """
    variants, labels = fps ^ masks, fps if labels is None else labels
    ordered = np.sort(variants)
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(shared):
        return np.zeros((0, 2), np.uint64)
    inside = shared[np.minimum(np.searchsorted(shared, variants), len(shared) - 1)] == variants
    variants, fps, labels = variants[inside], fps[inside], labels[inside]
    order = np.lexsort((fps, labels, variants))
    variants, fps, labels = variants[order], fps[order], labels[order]
    first = np.concatenate([[True], variants[1:] != variants[:-1]])
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    apart = (labels[head] != labels) & (np.bitwise_count(fps[head] ^ fps) <= most)
    links = np.stack([labels[head], labels], 1)[apart]
    return np.unique(links, axis=0) if len(links) else links


def links(blobs: DataFrame, half: int = HALF) -> DataFrame:
    """Links (a, b) between labels of a pass; the blobs of a bucket follow each other in a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, current = flip_masks(half), None
        fps: list[np.ndarray] = []
        labels: list[np.ndarray] = []
        numbers: list[np.ndarray] = []
        held: list[np.ndarray] = []
        n = 0

        def bucket_done() -> None:
            nonlocal n
            whole = np.concatenate(fps)
            found = ball_links(whole, masks[np.concatenate(numbers)], whole ^ np.concatenate(labels), 2 * half)
            for part in (fps, labels, numbers):
                part.clear()
            if len(found):
                held.append(found)
                n += len(found)

        def flush() -> pa.RecordBatch:
            out = np.unique(np.concatenate(held), axis=0).view(np.int64) if held else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("pairs"), strict=True):
                if bucket != current and fps:
                    bucket_done()
                    if n >= LINKS:
                        yield flush()
                        held, n = [], 0
                current, data = bucket, blob.as_buffer()
                k = len(data) // PAIR
                fps.append(np.frombuffer(data, "<u8", k).copy())
                labels.append(np.frombuffer(data, "<u8", k, 8 * k).copy())
                numbers.append(np.frombuffer(data, "<u2", k, 16 * k).copy())
        if fps:
            bucket_done()
        yield flush()

    return blobs.mapInArrow(run, "a long, b long")


def linked_classes(classes: DataFrame, half: int = HALF, passes: int = PASSES) -> DataFrame:
    """node and label of the fingerprints (a stored frame with the column fp) that have a link."""
    spark = classes.sparkSession
    n = classes.count()
    bits, tasks, balls = bucket_bits(n, half), tasks_for(n, CLASSES_PER_TASK, 1), tasks_for(n, BALLS_PER_TASK)
    classes = settle(classes.select("fp").repartition(balls))
    labelled, found, labels, count = classes, None, None, len(pass_bounds(passes)) - 1
    for number in range(count):
        with shuffles_removed(spark):
            blobs = variants_by_bucket(labelled, bits, number, passes, half).repartition("bucket").sortWithinPartitions("bucket")
            part = settle_few(links(blobs, half).distinct(), tasks)
        if part.isEmpty() and labels is not None:
            continue
        found = part if found is None else found.unionByName(part)
        labels = components(found.distinct())
        if number + 1 < count:
            labels = settle_few(labels, tasks)
            known = classes.join(labels, classes["fp"] == labels["node"], "left").select("fp", F.coalesce("label", "fp").alias("label"))
            labelled = settle(known.repartition(balls))
    return labels


def near_duplicates(docs: DataFrame, half: int = HALF, passes: int = PASSES) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id for every row."""
    members = settle(fingerprints(docs))
    counted = members.groupBy("fp").agg(F.min("doc_id").alias("least"))
    classes = settle_few(counted, tasks_for(members.count(), CLASSES_PER_TASK))
    labels = linked_classes(classes, half, passes)
    shared = members.where("doc_id is not null").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("z"))
    torn = shared.where("a < z").select("doc_id", "a")
    if not torn.isEmpty():  # ids with unlike texts join the texts' components
        more = members.join(torn, "doc_id").select("a", F.col("fp").alias("b"))
        labels = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(more))
    labels = settle_few(labels, tasks_for(members.count(), CLASSES_PER_TASK))
    named = classes.join(labels, classes["fp"] == labels["node"], "left").select("fp", "least", F.coalesce("label", "fp").alias("label"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    component = settle_few(named.join(least, "label").select("fp", "component_id"), tasks_for(members.count(), CLASSES_PER_TASK))
    return members.join(component, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
