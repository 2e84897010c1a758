"""Benchmark items inside documents, up to an error budget, by pigeonhole pieces and Myers' algorithm.

Texts are normalised: lower case, runs of white space as one space, none at the ends. An
item of m characters may be found with up to k = m * ``budget`` insertions, deletions and
substitutions. Cut into k + 1 pieces, at least one piece of it is then in the document
unchanged. One automaton finds all items' pieces in one pass over a text; each hit proposes a
place, places of an item that lie within the budget of each other are one, and Myers'
bit-parallel recurrence gives the least distance within the place's window.

The items reach the tasks in blocks of about ``BLOCK_CHARS`` characters, one pass over the
documents for each block. A pass is stored before the next block is fetched, so the driver holds
one block at a time, whatever the size of the benchmark.

Documents are read whole. Null and empty texts, on either side, match nothing; so do items with a
null id in ``leaks``, which has no name for them (``clean`` drops documents that hold one). Rows
with the same id are searched each; a repeated item row gives repeated pairs once. Of places with
the same distance the first one counts. Empty documents give an empty result, an empty benchmark
finds nothing. Other columns are left out by ``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import only
from pulsegrid.sources.settle import settle, settle_all

BUDGET = 0.08
BLOCK_CHARS = 4_000_000
LEAKS = "doc_id long, item_id long, distance int, start int, end int"


def normalised(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget_of(length: int, budget: float = BUDGET) -> int:
    return int(length * budget)


def pieces(item: str, budget: float = BUDGET) -> list[tuple[int, str]]:
    """(place, piece) of one piece more than the item's budget, of nearly equal lengths."""
    parts = budget_of(len(item), budget) + 1
    cuts = [len(item) * i // parts for i in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Least edit distance of a pattern to any stretch of a text."""

    def __init__(self, pattern: str):
        self.length = len(pattern)
        self.at: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.at[c] = self.at.get(c, 0) | 1 << i

    def best(self, text: str) -> tuple[int, int]:
        """(distance, end of the first stretch that has it)."""
        every, top = (1 << self.length) - 1, 1 << self.length - 1
        up, down, score = every, 0, self.length  # vertical steps of +1 and of -1
        best, end = score, 0
        at = self.at
        for place, c in enumerate(text, 1):
            equal = at.get(c, 0)
            flat = equal | down
            across = ((equal & up) + up ^ up) | equal
            right, left = down | ~(across | up) & every, up & across
            if right & top:
                score += 1
            elif left & top:
                score -= 1
                if score < best:
                    best, end = score, place
            right, left = right << 1 & every, left << 1 & every
            up, down = left | ~(flat | right) & every, right & flat
        return best, end


class Searcher:
    """Finds the items of a block in texts."""

    def __init__(self, items: list[tuple[int, str]], budget: float = BUDGET):
        import ahocorasick

        self.budget = budget
        self.items = list(dict.fromkeys((i, text) for i, text in items if text))
        self.patterns: dict[int, Pattern] = {}
        owners: dict[str, list[tuple[int, int]]] = {}
        for number, (_, text) in enumerate(self.items):
            for place, piece in pieces(text, budget):
                owners.setdefault(piece, []).append((number, place))
        self.automaton = ahocorasick.Automaton()
        for piece, found in owners.items():
            self.automaton.add_word(piece, (len(piece), found))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best place of every item that is found."""
        if not self.items or not text:
            return []
        proposed: dict[int, set[int]] = {}
        for last, (size, owners) in self.automaton.iter(text):
            for number, place in owners:
                proposed.setdefault(number, set()).add(last + 1 - size - place)
        out = []
        for number, starts in proposed.items():
            best = self._best(number, sorted(starts), text)
            if best:
                out.append((self.items[number][0], *best))
        return out

    def _best(self, number: int, starts: list[int], text: str) -> tuple[int, int, int] | None:
        item = self.items[number][1]
        for start in starts:
            if start >= 0 and text.startswith(item, start):
                return 0, start, start + len(item)
        most, best = budget_of(len(item), self.budget), None
        if not most:
            return None
        if number not in self.patterns:
            self.patterns[number] = Pattern(item)
        at = 0
        while at < len(starts):
            last = at
            while last + 1 < len(starts) and starts[last + 1] - starts[last] <= most:
                last += 1
            low = max(0, starts[at] - most)
            distance, end = self.patterns[number].best(text[low : starts[last] + len(item) + most])
            if distance <= most and (best is None or distance < best[0]):
                best = distance, max(low, low + end - len(item)), low + end
            at = last + 1
        return best


Items = list[tuple[int | None, str]]


class Blocks:
    """The benchmark's different items in blocks of about so many characters, fetched one at a time."""

    def __init__(self, benchmark: DataFrame, chars: int):
        items = only(benchmark, ("item_id", "text"), "benchmark").where("text is not null").distinct()
        total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        self.number = max(1, -(-total // chars))
        block = F.pmod(F.xxhash64("item_id", "text"), F.lit(self.number)).alias("block")
        items = items.select("item_id", "text", block)
        self.items = items if self.number == 1 else settle(items)

    def fetch(self, k: int) -> Items:
        rows = self.items.where(F.col("block") == k).collect()  # about as many characters as a block has
        return sorted(((r.item_id, normalised(r.text)) for r in rows), key=lambda item: (item[0] is None, *item))


def leaks(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``LEAKS``: a row for each document row and item found in it, with its best place.

    Places count characters of the normalised text; start is exact up to the insertions or
    deletions of the match.
    """
    docs = only(docs, ("doc_id", "text"), "documents")
    blocks = Blocks(benchmark, block_chars)
    names = [c.split()[0] for c in LEAKS.split(", ")]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())

    def search(block: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(block, budget)
            for batch in batches:
                rows = [
                    (doc.as_py(), *found)
                    for doc, text in zip(batch.column("doc_id"), batch.column("text"), strict=True)
                    for found in searcher.find(normalised(text.as_py()))
                ]
                columns = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        return docs.mapInArrow(run, LEAKS)

    passes = (search([item for item in blocks.fetch(k) if item[0] is not None]) for k in range(blocks.number))
    return next(passes) if blocks.number == 1 else settle_all(passes)


def clean(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents in which no item is found, with all their columns; a row is judged by its text alone."""
    blocks = Blocks(benchmark, block_chars)

    def without(rows: DataFrame, block: Items) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(block, budget)
            for batch in batches:
                stays = [not searcher.find(normalised(text.as_py())) for text in batch.column("text")]
                yield batch.filter(pa.array(stays, pa.bool_()))

        return rows.mapInArrow(run, rows.schema)

    for k in range(blocks.number - 1):
        docs = settle(without(docs, blocks.fetch(k)))
    return without(docs, blocks.fetch(blocks.number - 1))
