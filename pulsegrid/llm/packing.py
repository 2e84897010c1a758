"""Packing documents into token sequences: online best-fit with a bounded number of open bins.

Documents are tokenised, get a closing id, and only those longer than a sequence are cut: their
*first* piece takes the remainder, the others are full. Full pieces are sequences of their own.
All other pieces are dealt evenly to tasks. A task takes what arrives in runs of ``LOOKAHEAD``
pieces, sorts the run by length, longest first, and places piece after piece: into the open bin with the least free space that fits, else into a new bin. ``BestFit`` keeps a stack of
bins for each amount of free space and one bitset of the amounts that occur, so the best bin is
the lowest set bit at or above the piece's length. A task holds at most ``open_bins`` bins; when
one more is needed, the fullest closes first.

Tasks share nothing: a sequence's number joins the task's number and the bin's. The token table
and the packed table are written to the shared folder before anything is read from them, so a
lost executor costs only its running tasks.

Null and empty texts are one piece that holds the closing id alone. Rows with the same id are
packed each; other columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.byte_tokens import ByteEncoder
from pulsegrid.llm.frames import only, spread
from pulsegrid.sources.settle import settle

SEQUENCE = 2048
CLOSING_ID = 0
#: Pieces that one task packs. Its loss is a few open bins, so more pieces waste less.
PIECES_PER_TASK = 60_000
OPEN_BINS = 4096
#: Pieces that are placed longest first, out of those that have arrived.
LOOKAHEAD = 6_000
PIECES = "doc_id long, piece int, start long, length int, ids binary, ids_crc32 long"


class BestFit:
    """Open bins by free space. ``place`` returns (bin, offset) and may close a bin to make room."""

    def __init__(self, size: int = SEQUENCE, open_bins: int = OPEN_BINS):
        self.size, self.open_bins = size, open_bins
        self._by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self._free_bits = 0  # bit f: some open bin has f places free
        self._open = self._made = 0

    def _take(self, free: int) -> int:
        stack = self._by_free[free]
        taken = stack.pop()
        if not stack:
            self._free_bits &= ~(1 << free)
        self._open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        if not 0 < length <= self.size:
            raise ValueError(f"a piece of {length} ids does not fit into {self.size}")
        fitting = self._free_bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            found = self._take(free)
        else:
            free, found = self.size, self._made
            self._made += 1
        left = free - length
        if left:
            if self._open == self.open_bins:  # the fullest of all, this one included, closes
                least = (self._free_bits & -self._free_bits).bit_length() - 1
                if left <= least:
                    return found, self.size - free
                self._take(least)
            self._by_free[left].append(found)
            self._free_bits |= 1 << left
            self._open += 1
        return found, self.size - free


def cut(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: the first takes the remainder, the others are full."""
    first = length % size or size
    return [(0, first), *((at, size) for at in range(first, length, size))]


def token_pieces(docs: DataFrame, ranks_path: str, size: int = SEQUENCE, closing_id: int = CLOSING_ID) -> DataFrame:
    """The pieces of all documents as ``PIECES``; ids are little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, closing = ByteEncoder(ranks_path), closing_id.to_bytes(4, "little")
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part, rows = batch.slice(at, 512), []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    data = encoder.encode(text) + closing
                    for piece, (start, length) in enumerate(cut(len(data) // 4, size)):
                        own = data[4 * start : 4 * (start + length)]
                        rows.append((doc, piece, start, length, own, zlib.crc32(own)))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64())
                names = [c.split()[0] for c in PIECES.split(", ")]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return only(docs, ("doc_id", "text"), "documents").mapInArrow(run, PIECES)


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of so many; the last may be shorter."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - n)
            held.append(part)
            n, batch = n + part.num_rows, batch.slice(part.num_rows)
            if n == rows:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def assign(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS, per_task: int = PIECES_PER_TASK) -> DataFrame:
    """The rows of a stored frame with a column ``length``, and sequence_id and offset for each."""
    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        fit, base = BestFit(size, open_bins), TaskContext.get().partitionId() << 40
        for batch in _runs(batches, LOOKAHEAD):
            lengths = batch.column("length").to_pylist()
            numbers, offsets = [0] * len(lengths), [0] * len(lengths)
            for k in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
                found, offsets[k] = fit.place(lengths[k])
                numbers[k] = base + found
            names = [*batch.schema.names, "sequence_id", "offset"]
            columns = [*batch.columns, pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return spread(pieces, per_task).mapInArrow(run, schema)


def pack(docs: DataFrame, ranks_path: str, size: int = SEQUENCE, open_bins: int = OPEN_BINS) -> DataFrame:
    """Every piece with its place: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Only the lengths are dealt out; the ids stay in the table that ``packed_ids`` reads.
    """
    return place(settle(token_pieces(docs, ranks_path, size)), size, open_bins)


def place(pieces: DataFrame, size: int = SEQUENCE, open_bins: int = OPEN_BINS) -> DataFrame:
    placed = settle(assign(pieces.drop("ids"), size, open_bins))
    return placed.withColumns({"length": F.col("length").cast("long")})


def packed_ids(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id and ids, the pieces' ids in the order of their offsets.

    Needs documents with distinct ids. A group is one sequence, so it is bounded by its size.
    """
    joined = placed.select("doc_id", "piece", "sequence_id", "offset").join(
        pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"]
    )
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(parts, F.lit(b""), lambda out, part: F.concat(out, part["ids"]))
    return joined.groupBy("sequence_id").agg(whole.alias("ids"))
