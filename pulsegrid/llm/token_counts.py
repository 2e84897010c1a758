"""Token counts by a sentencepiece model, with huge texts encoded in overlapping chunks.

A text up to ``chunk_bytes`` is encoded whole. A longer one is encoded chunk by chunk; each
chunk starts ``overlap_bytes`` before the one before it ends. Both chunks' tokens carry
offsets, and they are spliced at a boundary that both have and that is proven stable: a place
where a space follows another character. No piece of the vocabulary reaches over such a place
(``_splits_before_spaces`` proves it from the pieces; a model without that property is encoded
whole), so no merge does either, and the tokens to its left and right depend on the text of
their own side alone. Where an overlap holds no common stable boundary it is doubled, up to
the whole rest of the text.

Null and empty texts have no tokens. Rows with the same id are counted each. Other columns are
left out.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from pulsegrid.llm.frames import only

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
CHUNK_BYTES = 32_768
OVERLAP_BYTES = 512
LIMIT = 4096
_SPACE_PIECE = "▁"
_SPACE_BYTES = _SPACE_PIECE.encode()


def _splits_before_spaces(model) -> bool:
    """Whether no piece holds a space after another character, so that none crosses such a place."""
    crossing = re.compile(f"[^{_SPACE_PIECE}]{_SPACE_PIECE}")
    return not any(crossing.search(model.id_to_piece(i)) for i in range(model.get_piece_size()))


def _stable(data: bytes, at: int) -> bool:
    return 0 < at < len(data) and data[at] == 0x20 and data[at - 1] != 0x20 and data[max(0, at - 3) : at] != _SPACE_BYTES


def _character(data: bytes, at: int) -> int:
    """The place itself, or else the start of the character that it lies in."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def _spans(model, data: bytes, start: int, end: int) -> tuple[list[int], list[int]]:
    """Token ids of a chunk and the bytes of the whole text where they begin."""
    proto = model.encode(data[start:end].decode(), return_type="proto")
    return [p.id for p in proto.pieces], [start + p.begin for p in proto.pieces]


def encode_long(model, text: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES) -> list[int]:
    """The ids of the whole text, from overlapping chunks."""
    data = text.encode()
    out: list[int] = []
    end = _character(data, min(chunk, len(data)))
    ids, begins = _spans(model, data, 0, end)
    while end < len(data):
        next_end, width = _character(data, min(end + chunk, len(data))), overlap
        while True:
            start = _character(data, max(0, end - width))
            if start == 0:  # Nowhere stable in all that came before: the chunk begins where the text does.
                out, (ids, begins), chunk = [], _spans(model, data, 0, next_end), 2 * chunk
                break
            if start < begins[0]:  # Wider than the tokens held back: take those anew.
                out, (ids, begins) = [], _spans(model, data, 0, end)
            more, more_begins = _spans(model, data, start, next_end)
            right = {at: k for k, at in reversed(list(enumerate(more_begins)))}
            at = next((at for at in reversed(begins) if start < at and at in right and _stable(data, at)), None)
            if at is not None:
                keep = bisect_left(begins, at)
                out += ids[:keep]
                ids, begins = more[right[at] :], more_begins[right[at] :]
                break
            width *= 2
        end = next_end
    return out + ids


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int = LIMIT,
    chunk_bytes: int = CHUNK_BYTES,
    overlap_bytes: int = OVERLAP_BYTES,
) -> DataFrame:
    """Bytes and tokens of every text, as ``SCHEMA``. Needs doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        chunked = _splits_before_spaces(model)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes = [len(t.encode()) for t in texts]
            small = [i for i, n in enumerate(sizes) if n <= chunk_bytes or not chunked]
            counts = [0] * len(texts)
            for at in range(0, len(small), 256):  # one list of ids for few texts at a time
                part = small[at : at + 256]
                for i, ids in zip(part, model.encode([texts[i] for i in part], num_threads=1), strict=True):
                    counts[i] = len(ids)
            for i in set(range(len(texts))) - set(small):
                counts[i] = len(encode_long(model, texts[i], chunk_bytes, overlap_bytes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([n > limit for n in counts], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return only(docs, ("doc_id", "text"), "documents").mapInArrow(run, SCHEMA)
