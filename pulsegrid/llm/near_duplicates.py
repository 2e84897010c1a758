"""Near-duplicate components by HyperMinHash sketches.

A document's set holds its distinct five-word shingles (with fewer words, the whole sequence as
one). Documents with 100 * intersection >= ``percent`` * union are linked; it is 85 if not given.

1. **Classes.** Documents with the same set (two 64-bit sums over its hashes, and its size) are
   one class, named by the least doc_id. All that follows is about classes.
2. **Sketch.** Hashes fall into ``BUCKETS`` buckets; a bucket keeps its least value as the count
   of leading zeros and ten mantissa bits, 16 bits in all. Small sets are hashed in several
   rounds, so that a bucket sees eight values on average: sets of 1024 to 2047 shingles in two,
   of 512 to 1023 in four, and so on. Sets near such a border have a sketch for both sides (for
   all sizes down to ``percent``), so two sets that could be linked share a number of rounds.
3. **Bands.** Bands of registers give keys: 24 of six at 85, 38 of six at 80. Classes that share
   a key are candidates; at the threshold, a pair without a common key has a chance of about 1e-5.
4. **Stars.** In each bucket of a key the most central class (the one that sits in the largest
   buckets) is paired with all others: as many pairs as members. The collision-corrected
   estimate of the Jaccard index drops those ``MARGIN`` standard deviations below the
   threshold, full sets decide on the rest, and links give components.
5. **Strays.** Where a bucket still holds several components, its members outside the central
   class's component are compared with all others of other components, in bounded blocks and
   again by estimate and full set, some dozens of full sets at a time. A pair is looked at in its
   first common band only. Only links leave a task. So no link between candidates is lost, and no group's pairs are listed.

Full sets are built for candidates alone. Which documents those are is passed to the reading
tasks as a bitmap of one megabyte; a false hit costs a row that no pair asks for. Shingles are
compared by 40 bits of their hashes.

Null and empty texts, and texts without words, have an empty set and no link. Rows with the same
doc_id are one node. A row with a null doc_id belongs to its class but names none; alone, its
component is null. Other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.components import components
from pulsegrid.llm.frames import only, settle_few, tasks_for
from pulsegrid.llm.settings import small_batches
from pulsegrid.llm.words import WINDOW, WordReader, Words, mix, text_blocks
from pulsegrid.sources.settle import settle

BUCKETS = 256
MANTISSA = 10
ROWS, MISS = 6, 1.2e-5  # registers of a band at most; chance that a pair at the threshold shares no band
FILL = 8 * BUCKETS  # hashes that a sketch takes at least
PERCENT = 85
MARGIN = 5.0
BITMAP_BITS = 1 << 23
STRAYS, OTHERS = 128, 512  # rows of a block
AT_ONCE = 64  # rows with full sets that a task turns into Python objects
DOCS_PER_TASK = 20_000  # documents whose keys and labels one task writes

MEMBERS = "doc_id long, n int, sum1 long, sum2 long, keys array<long>"
SETS = "cls long, n int, rounds array<int>, registers binary, high binary, low binary"

_ROUND = np.uint64(0xA0761D6478BD642F)


def shingle_sets(words: Words) -> list[np.ndarray]:
    """For each text, the sorted distinct hashes of its shingles."""
    at, windows = words.windows()
    counts = words.counts()
    first = np.concatenate([[0], np.cumsum(counts)])
    ends = np.cumsum(np.maximum(counts - WINDOW + 1, 0))
    out = []
    for i, n in enumerate(counts):
        if n >= WINDOW:
            out.append(np.unique(windows[ends[i] - (n - WINDOW + 1) : ends[i]]))
        elif n:
            joined = np.array([n], np.uint64)
            for h in words.hash[first[i] : first[i + 1]]:
                joined = mix(joined * _ROUND + h)
            out.append(joined)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def bands_for(percent: int = PERCENT) -> tuple[int, int]:
    """The number of bands and of registers in each: the longest bands whose number meets ``MISS``."""
    for rows in range(ROWS, 0, -1):
        equal = min(percent / 100, 1) ** rows
        bands = math.ceil(math.log(MISS) / math.log1p(-equal)) if equal < 1 else 1
        if bands * rows <= BUCKETS:
            return bands, rows
    raise ValueError(f"{BUCKETS} registers are too few for a threshold of {percent} percent")


def rounds_for(n: int, percent: int = PERCENT) -> list[int]:
    """The numbers of rounds, as powers of two, for which a set of n shingles has a sketch."""
    power = lambda size: max(0, int(np.ceil(np.log2(FILL / size))))
    return list(range(power(n), power(n * percent / 100) + 1))


def registers(hashes: np.ndarray, power: int) -> np.ndarray:
    """The sketch: for each bucket 1 + leading zeros * 2**MANTISSA + mantissa, or 0 if it is empty."""
    salts = mix(np.arange(1, (1 << power) + 1, dtype=np.uint64) * _ROUND)
    values = mix((hashes[:, None] ^ salts[None, :]).ravel())
    least = np.full(BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, (values & np.uint64(BUCKETS - 1)).astype(np.int64), values >> np.uint64(8))
    mantissa, length = np.frexp(least.astype(float))
    coded = (56 - np.minimum(length, 56)).astype(np.int64) << MANTISSA
    coded += ((2 * mantissa - 1) * (1 << MANTISSA)).astype(np.int64) + 1
    return np.where(least >> np.uint64(56) > 0, 0, coded).astype("<u2")


def band_keys(sketch: np.ndarray, power: int, shape: tuple[int, int] = bands_for(PERCENT)) -> np.ndarray:
    """The keys of a sketch's bands; shape is what ``bands_for`` gives."""
    bands, rows = shape
    joined = np.arange(bands, dtype=np.uint64) * _ROUND + np.uint64(power + 1)
    for column in sketch[: bands * rows].reshape(bands, rows).T:
        joined = mix(joined + column.astype(np.uint64))
    return joined.view(np.int64)


def chance_collisions(n: np.ndarray, m: np.ndarray, power: int) -> np.ndarray:
    """The chance that a register of two disjoint sets is the same, from the sets' sizes.

    The least of k hashes lies at x with density k * exp(-k * x); two minima give one register
    if they fall into the same of the 2**MANTISSA cells between two powers of two.
    """
    a, b = np.asarray(n, float) * 2.0**power / BUCKETS, np.asarray(m, float) * 2.0**power / BUCKETS
    low = 2.0 ** -np.arange(1, 57)
    rate = (a + b)[..., None]
    within = np.exp(-rate * low) - np.exp(-2 * rate * low)
    return (a * b / (a + b)) * (within * low).sum(-1) / (1 << MANTISSA)


def estimate(same: np.ndarray, used: np.ndarray, n: np.ndarray, m: np.ndarray, power: int) -> np.ndarray:
    """The Jaccard index from the shares of equal registers, without the expected chance collisions."""
    chance = chance_collisions(n, m, power)
    return np.clip((same / np.maximum(used, 1) - chance) / (1 - chance), 0, 1)


def lowest_estimate(percent: int = PERCENT) -> float:
    j = percent / 100
    return j - MARGIN * (j * (1 - j) / BUCKETS) ** 0.5


def sketches(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``MEMBERS`` for every row: the set's size, two sums over it, and its band keys."""
    shape = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(lower=True)
        for batch in batches:
            for at, texts in text_blocks(batch.column("text")):
                rows = []
                for hashes in shingle_sets(reader.read(texts)):
                    keys = np.zeros(0, np.int64)
                    if len(hashes):
                        powers = rounds_for(len(hashes), percent)
                        keys = np.concatenate([band_keys(registers(hashes, p), p, shape) for p in powers])
                    sums = np.array([hashes.sum(dtype=np.uint64), mix(hashes).sum(dtype=np.uint64)]).astype(np.uint64).view(np.int64)
                    rows.append((len(hashes), sums[0], sums[1], keys))
                n, one, two, keys = zip(*rows, strict=True)
                columns = [
                    batch.column("doc_id").slice(at, len(texts)).cast(pa.int64()),
                    pa.array(n, pa.int32()),
                    pa.array(one, pa.int64()),
                    pa.array(two, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "sum1", "sum2", "keys"])

    return only(docs, ("doc_id", "text"), "documents").mapInArrow(run, MEMBERS)


def _bit(column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS)).cast("int")


def _bitmap_words(ids: DataFrame, name: str) -> DataFrame:
    """word and bits: BITMAP_BITS bits, set for the ids; at most BITMAP_BITS / 32 rows."""
    bit = ids.select(_bit(F.col(name)).alias("bit")).distinct()
    return bit.groupBy(F.shiftright("bit", 5).alias("word")).agg(F.sum(F.expr("shiftleft(1L, bit & 31)")).alias("bits"))


def _bitmap(ids: DataFrame) -> np.ndarray:
    out = np.zeros(BITMAP_BITS // 32, np.uint32)
    for word, bits in _bitmap_words(ids, "cls").collect():
        out[word] = bits
    return out


def full_sets(docs: DataFrame, ids: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``SETS`` for the documents among ids, and for a few more."""
    bitmap = _bitmap(ids)
    rows = only(docs, ("doc_id", "text"), "documents").where("doc_id is not null").withColumn("bit", _bit(F.col("doc_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = WordReader(lower=True)
        names = [c.strip().split()[0] for c in SETS.split(", ")]
        for batch in batches:
            bit = batch.column("bit").to_numpy()
            wanted = (bitmap[bit >> 5] >> (bit & 31).astype(np.uint32)) & 1 == 1
            part = batch.filter(pa.array(wanted))
            for at, texts in text_blocks(part.column("text")):
                rows = []
                ids = part.column("doc_id").slice(at, len(texts)).to_pylist()
                for doc, hashes in zip(ids, shingle_sets(reader.read(texts)), strict=True):
                    if len(hashes):
                        powers = rounds_for(len(hashes), percent)
                        regs = b"".join(registers(hashes, p).tobytes() for p in powers)
                        high = (hashes >> np.uint64(32)).astype("<u4").tobytes()
                        low = (hashes >> np.uint64(24)).astype("u1").tobytes()
                        rows.append((doc, len(hashes), powers, regs, high, low))
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.binary(), pa.binary())
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return rows.mapInArrow(run, SETS)


def _set(high: bytes, low: bytes) -> np.ndarray:
    return np.frombuffer(high, "<u4").astype(np.uint64) << np.uint64(8) | np.frombuffer(low, "u1")


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted sets reach the threshold."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    place = np.searchsorted(a, b)
    common = int((a[np.minimum(place, len(a) - 1)] == b).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _sketch(rounds: list[int], data: bytes, power: int) -> np.ndarray:
    at = list(rounds).index(power) * BUCKETS
    return np.frombuffer(data, "<u2")[at : at + BUCKETS]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows as Python objects, a few at a time: full sets are large."""
    for batch in batches:
        for at in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(at, AT_ONCE).to_pylist()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes that are linked."""
    names = [c for c in sets.columns if c != "cls"]
    side = lambda s: sets.select(F.col("cls").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in names])
    lowest = lowest_estimate(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            out = []
            for r in part:
                for power in set(r["rounds_a"]) & set(r["rounds_b"]):
                    x = _sketch(r["rounds_a"], r["registers_a"], power)
                    y = _sketch(r["rounds_b"], r["registers_b"], power)
                    same, used = ((x == y) & (x > 0)).sum(), ((x > 0) | (y > 0)).sum()
                    if estimate(same, used, r["n_a"], r["n_b"], power) >= lowest:
                        if linked(_set(r["high_a"], r["low_a"]), _set(r["high_b"], r["low_b"]), percent):
                            out.append((r["a"], r["b"]))
                        break
            yield _pairs(out)

    near = (100 * F.least("n_a", "n_b")) >= (percent * F.greatest("n_a", "n_b"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(near).mapInArrow(run, "a long, b long")


def _holders(rows: list[dict], shape: tuple[int, int]) -> Iterator[tuple[int, int, list[dict]]]:
    """Powers and bands that give the block's key, each with the rows whose sketch has it there.

    A doc_id with several texts also brings sets without the key, and now and then sketches of two
    powers give one key.
    """
    key = rows[0]["key"]
    for power in sorted({p for r in rows for p in r["rounds"]}):
        having = [r for r in rows if power in r["rounds"]]
        hits = np.stack([band_keys(_sketch(r["rounds"], r["registers"], power), power, shape) for r in having]) == key
        for band in np.flatnonzero(hits.any(0)):
            yield power, int(band), [having[i] for i in np.flatnonzero(hits[:, band])]


def _block_links(rows: list[dict], percent: int, root: dict[int, int] | None = None) -> list[tuple[int, int]]:
    """Links between the strays of a block and others; all of them share the bucket ``key``.

    root tells which labels the links so far have joined, and is kept up.
    """
    shape, root = bands_for(percent), {} if root is None else root
    return [link for place in _holders(rows, shape) for link in _place_links(*place, percent, shape[1], root)]


def _place_links(power: int, band: int, rows: list[dict], percent: int, width: int, root: dict[int, int]) -> list[tuple[int, int]]:
    strays, others = [r for r in rows if r["stray"]], [r for r in rows if not r["stray"]]
    if not strays or not others:
        return []
    lowest, found = lowest_estimate(percent), []
    names, labels = np.array([r["cls"] for r in others]), np.array([r["label"] for r in others])
    sizes = np.array([r["n"] for r in others], float)
    sets: dict[int, np.ndarray] = {}

    def top(v: int) -> int:
        while v in root:
            v = root[v]
        return v

    y = np.stack([_sketch(r["rounds"], r["registers"], power) for r in others])
    for row in strays:
        x = _sketch(row["rounds"], row["registers"], power)
        good = (labels != row["label"]) & (names != row["cls"])
        good &= 100 * np.minimum(sizes, row["n"]) >= percent * np.maximum(sizes, row["n"])
        at = np.flatnonzero(good)
        if band and len(at):  # of the bands that two share, the first one compares them
            before = (y[at, : band * width] == x[: band * width]).reshape(len(at), band, width).all(2).any(1)
            at = at[~before]
        if not len(at):
            continue
        same = ((y[at] == x) & (y[at] > 0)).sum(1)
        used = ((y[at] > 0) | (x > 0)).sum(1)
        near = estimate(same, used, row["n"], sizes[at], power) >= lowest
        own = None
        for j in at[near][np.argsort(-same[near], kind="stable")]:
            one, two = top(row["label"]), top(int(labels[j]))
            if one == two:
                continue
            if own is None:
                own = _set(row["high"], row["low"])
            if j not in sets:
                sets[j] = _set(others[j]["high"], others[j]["low"])
            if linked(own, sets[j], percent):
                found.append((row["cls"], int(names[j])))
                root[max(one, two)] = min(one, two)
    return found


def stray_links(labelled: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links that the stars may have missed: labelled has key, cls, label and centre (the centre's label).

    The rows of a block, at most STRAYS + OTHERS, follow each other in a sorted partition, strays first. A
    task holds the strays of one block and ``AT_ONCE`` of the others.
    """
    stray = F.col("label") != F.col("centre")
    sizes = labelled.groupBy("key").agg(F.count("*").alias("all"), F.sum(stray.cast("int")).alias("strays")).where("strays > 0")
    rows = labelled.withColumn("is_stray", stray).join(sizes, "key")
    blocks = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    mine = lambda n: F.pmod(F.xxhash64("cls"), n).cast("int")
    every = lambda n: F.sequence(F.lit(0), n - 1)
    rows = rows.withColumns({"n_s": blocks("strays", STRAYS), "n_o": blocks("all", OTHERS)})
    rows = rows.withColumns({"s": mine(F.col("n_s")), "o": mine(F.col("n_o"))})
    as_other = rows.select("key", "cls", "label", F.explode(every(F.col("n_s"))).alias("s"), "o", F.lit(False).alias("stray"))
    as_stray = rows.where("is_stray").select("key", "cls", "label", "s", F.explode(every(F.col("n_o"))).alias("o"), F.lit(True).alias("stray"))
    dealt = as_other.unionByName(as_stray).join(sets, "cls").repartition("key", "s", "o").sortWithinPartitions("key", "s", "o", F.desc("stray"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, strays, others = None, [], []
        root: dict[int, int] = {}
        for part in _slices(batches):
            out = []
            for row in part:
                name = (row["key"], row["s"], row["o"])
                if name != block:
                    out += _block_links(strays + others, percent, root) if others else []
                    block, strays, others, root = name, [], [], {}
                (strays if row["stray"] else others).append(row)
                if len(others) == AT_ONCE:
                    out += _block_links(strays + others, percent, root)
                    others = []
            yield _pairs(out)
        yield _pairs(_block_links(strays + others, percent, root) if others else [])

    return dealt.mapInArrow(run, "a long, b long")


def _pairs(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    with small_batches(docs.sparkSession):
        return _near_duplicates(docs, percent)


def _near_duplicates(docs: DataFrame, percent: int) -> DataFrame:
    members = settle(sketches(docs, percent))
    same = ("sum1", "sum2", "n")
    classes = members.where("n > 0").groupBy(*same).agg(F.min("doc_id").alias("cls"))
    tasks = tasks_for(members.count(), DOCS_PER_TASK)
    classes = settle_few(classes, tasks)
    heads = members.join(classes.select("cls").where("cls is not null").withColumnRenamed("cls", "doc_id"), "doc_id", "left_semi")
    keys = settle_few(heads.select(F.col("doc_id").alias("cls"), F.explode("keys").alias("key")), tasks)
    shared = keys.groupBy("key").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), F.count("*").alias("size"))
    live = settle_few(keys.join(shared.where("low < high").select("key", "size"), "key"), tasks)
    labels = settle_few(_labels(docs, live, percent, tasks), tasks)
    named = members.join(classes, list(same), "left").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    component = F.when(F.col("n") > 0, F.coalesce("label", "cls")).otherwise(F.col("doc_id"))
    return named.select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _labels(docs: DataFrame, live: DataFrame, percent: int, tasks: int) -> DataFrame:
    """node and label of the classes that have a link."""
    sets = settle(full_sets(docs, live, percent))
    weight = live.groupBy("cls").agg(F.sum("size").alias("weight"))
    centres = live.join(weight, "cls").groupBy("key").agg(F.max(F.struct("weight", (-F.col("cls")).alias("minus"))).alias("top"))
    centres = settle_few(centres.select("key", (-F.col("top.minus")).alias("head")), tasks)
    stars = live.join(centres, "key").where("cls <> head")
    pairs = stars.select(F.least("cls", "head").alias("a"), F.greatest("cls", "head").alias("b")).distinct()
    found = settle_few(components(confirmed(pairs, sets, percent)), tasks)
    name = lambda c: F.coalesce("label", c)
    centre = centres.join(found, centres["head"] == found["node"], "left").select("key", name("head").alias("centre"))
    labelled = live.join(found, live["cls"] == found["node"], "left").select("key", "cls", name("cls").alias("label"))
    missed = settle(stray_links(settle_few(labelled.join(centre, "key"), tasks), sets, percent))
    if missed.isEmpty():
        return found
    return components(found.select(F.col("node").alias("a"), F.col("label").alias("b")).unionByName(missed))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row of each component, the one with the least doc_id, with all columns.

    Rows are told apart by doc_id and text, so an id with several texts loses only those that are
    copies. A row with a null doc_id goes if it copies a row that has one; of such rows alone one stays.
    Of rows equal in doc_id and text, one stays: the least by its other columns. Rows without words
    have no copies but such.
    """
    name = lambda c: _fresh(docs, c)
    many = settle(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if many.isEmpty() and docs.where("doc_id is null").isEmpty():
        found = settle(near_duplicates(docs, percent))
        return _without(docs, found.where("not kept").select("doc_id"), "doc_id")
    # Rows of such ids (and a few more, which does no harm) get a node of their own, the others keep their id.
    row, marked = name("row"), name("marked")
    rows = _marked(docs, many, "doc_id", marked).withColumn(marked, F.col(marked) | F.col("doc_id").isNull())
    rows = rows.withColumn(row, F.when(F.col(marked), F.xxhash64("doc_id", "text")).otherwise(F.col("doc_id")))
    nodes = rows.select(F.col(row).alias("doc_id"), "text")
    found = settle(near_duplicates(nodes, percent)).select(F.col("doc_id").alias("node"), "component_id").distinct()
    ids = rows.select(F.col(row).alias("node"), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col(row).alias("node")).alias("rank"))
    ranked = settle(found.join(ids.distinct(), "node"))
    first = ranked.groupBy("component_id").agg(F.min("rank").alias("first"))
    goes = ranked.join(first, "component_id").where(F.col("node") != F.col("first.node"))
    kept = _without(rows, goes.select(F.col("node").alias(row)), row)
    sure = kept.where(~F.col(marked)).select(docs.columns)
    least = kept.where(F.col(marked)).groupBy(row).agg(F.min(F.struct(*docs.columns)).alias("least"))
    return sure.unionByName(least.select("least.*"))


def _fresh(docs: DataFrame, name: str) -> str:
    """The name, or a longer one that is no column of docs."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _marked(docs: DataFrame, ids: DataFrame, of: str, mark: str) -> DataFrame:
    """Adds the column ``mark``: true for the listed ids and for a few more, by a bitmap, which is bounded and so broadcast."""
    word, bits, bit = (_fresh(docs, c) for c in ("word", "bits", "bit"))
    words = F.broadcast(settle(_bitmap_words(ids, of)).select(F.col("word").alias(word), F.col("bits").alias(bits)))
    rows = docs.withColumn(bit, _bit(F.col(of))).join(words, F.shiftright(bit, 5) == F.col(word), "left")
    listed = F.getbit(F.coalesce(bits, F.lit(0)), F.col(bit).bitwiseAND(31)) == 1
    return rows.select(*docs.columns, listed.alias(mark))


def _without(docs: DataFrame, dropped: DataFrame, of: str) -> DataFrame:
    """The rows whose id is not among the dropped ones; rows with a null id stay.

    Most rows that stay are told by a bitmap; only the others, the dropped ones and a few more, are
    shuffled to be compared with the ids themselves.
    """
    listed = _fresh(docs, "listed")
    dropped = settle(dropped.where(F.col(of).isNotNull()).distinct())
    rows = _marked(docs, dropped, of, listed)
    sure = rows.where(~F.col(listed) | F.col(of).isNull()).select(docs.columns)
    unsure = rows.where(F.col(listed) & F.col(of).isNotNull()).select(docs.columns)
    return sure.unionByName(unsure.join(dropped, of, "left_anti").select(docs.columns))
