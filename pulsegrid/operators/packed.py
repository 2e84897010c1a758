"""The dedup of minutes with each subject-day moved as one row.

A task that reads minutes folds its copies of a minute and packs what is left of a subject-day into one row: times and
orders as differences, readings as numbers of the day's distinct texts, the bytes of a column that weigh alike side by
side, which the shuffle compresses to little. The rows of a subject-day meet in one task, in bounded pieces, and are
folded again and unpacked there. So minutes are moved once, and leave the exchange sorted by subject, day and time.
Any text, time, order and number of copies passes through as it is. Rows without a date are only counted by subject.

Functions that run in tasks are pickled by value, so that executors need no copy of the package.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator, Sequence
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType

from pulsegrid.config import DEDUP_KEY, MINUTE_COLUMNS
from pulsegrid.sources.tables import SRC_ORDER

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Minutes that a task holds at a time, and bytes of their texts.
CHUNK = 1 << 17
MOST_BYTES = 1 << 26
# Flags that may be set to find the distinct readings of each day; beyond, they are sorted.
_MOST_FLAGS = 1 << 23
_SECONDS = 86_400
_FULL_TIME = r"([01]\d|2[0-3]):([0-5]\d):([0-5]\d)"

_PACKED = (
    "subject_id string, date string, others bigint, n int, first_order bigint, times binary, orders binary, "
    "voids binary, repeats binary, hrs binary, odd_times array<string>, readings array<string>"
)
_FOLDED = "subject_id string, date string, time string, hr string, src_order bigint, copies bigint, unrecorded boolean"


class Minutes(NamedTuple):
    """Minutes as numbers. ``time`` is the second of the day, or 86,400 and the place of a text that is no full time."""

    day: np.ndarray
    time: np.ndarray
    order: np.ndarray
    void: np.ndarray  # whether the order is null; it is 0 then
    hr: np.ndarray  # the place of the reading's text
    copies: np.ndarray

    def take(self, rows: np.ndarray | slice) -> Minutes:
        return Minutes(*[column[rows] for column in self])


def can_pack(minutes: DataFrame, key: Sequence[str]) -> bool:
    """Whether the minutes have the columns of raw minutes alone, of their types, and are deduplicated by the usual key."""
    types = {field.name: field.dataType for field in minutes.schema}
    usual = {**dict.fromkeys(MINUTE_COLUMNS, StringType()), SRC_ORDER: LongType()}
    return types == usual and len(minutes.columns) == len(usual) and set(key) == set(DEDUP_KEY)


def keep_one(minutes: DataFrame, keep: str = "last") -> DataFrame:
    """One row per minute, and for each subject one that counts its rows without a date, which is ``unrecorded``."""
    last = keep == "last"
    days = minutes.select(*MINUTE_COLUMNS, SRC_ORDER).mapInArrow(partial(_pack, last=last), _PACKED)
    met = days.repartition("subject_id", "date").sortWithinPartitions("subject_id", "date")
    return met.mapInArrow(partial(_unpack, last=last), _FOLDED)


def _array(column: pa.Array | pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    """The column as one array of the type, as it also comes in types with large offsets."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column if column.type == kind else column.cast(kind)


def _coded(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each text's place among the distinct ones, and those."""
    coded = texts.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def _firsts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _runs(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    changed = np.zeros(len(columns[0]), bool)
    changed[:1] = True
    for column in columns:
        changed[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(changed)


def _fold(minutes: Minutes, readings: pa.Array, last: bool) -> Minutes:
    """One row per day and time, sorted by both: that of the last or first order, null being the least.

    Of rows with the same order, the one with the last or first text counts.
    """
    key = minutes.day * (int(minutes.time.max(initial=0)) + 1) + minutes.time
    by = np.argsort(key, kind="stable")
    key = key[by]
    starts = _runs(key)
    if len(starts) == len(key):
        return minutes.take(by)
    sizes = np.diff(starts, append=len(key))
    at = np.flatnonzero(np.repeat(sizes > 1, sizes))
    rows = by[at]
    rank = pc.rank(readings, tiebreaker="dense").to_numpy()[minutes.hr[rows]]
    by[at] = rows[np.lexsort((rank, minutes.order[rows], ~minutes.void[rows], key[at]))]
    copies = np.add.reduceat(minutes.copies[by], starts)
    return minutes.take(by[starts + sizes - 1 if last else starts])._replace(copies=copies)


def _planes(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """The numbers of each group as bytes: the lowest byte of all, then the next one of all, as many as the greatest needs."""
    width = (int(values.max(initial=0)).bit_length() + 7) // 8
    at = np.arange(len(values)) + np.repeat(_firsts(counts) * (width - 1), counts)
    step, out = np.repeat(counts, counts), np.empty(len(values) * width, np.uint8)
    for plane in range(width):
        out[at + plane * step] = (values >> values.dtype.type(8 * plane)).astype(np.uint8)
    ends = np.concatenate([[0], np.cumsum(counts * width)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _numbers(column: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The numbers that _planes made bytes of."""
    column = _array(column, pa.binary())
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    out = np.zeros(int(counts.sum()), np.uint64)
    widths = np.diff(ends) // np.maximum(counts, 1)
    if not widths.any():
        return out
    data, width, step = np.frombuffer(data, np.uint8), np.repeat(widths, counts), np.repeat(counts, counts)
    at = np.arange(len(out)) + np.repeat(ends[:-1] - _firsts(counts), counts)
    for plane in range(int(widths.max())):
        there = np.flatnonzero(width > plane)
        out[there] |= data[at[there] + plane * step[there]].astype(np.uint64) << np.uint64(8 * plane)
    return out


def _lists(places: np.ndarray, texts: pa.Array, counts: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), texts.take(pa.array(places)))


def _of_lists(column: pa.Array, rows: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """For a place in the list of each row, that of the text among the distinct ones, and those."""
    column = _array(column, pa.list_(pa.string()))
    codes, texts = _coded(column.values)
    return codes[column.offsets.to_numpy().astype(np.int64)[rows] + places], texts


def _batch(subjects: pa.Array, dates: pa.Array, others: np.ndarray, n: np.ndarray, *columns: pa.Array) -> pa.RecordBatch:
    names = [column.split()[0] for column in _PACKED.split(", ")]
    if not columns:
        nothing = lambda kind: pa.nulls(len(subjects), kind)
        columns = [nothing(pa.int64()), *[nothing(pa.binary())] * 5, *[nothing(pa.list_(pa.string()))] * 2]
    return pa.RecordBatch.from_arrays([subjects, dates, pa.array(others), pa.array(n.astype(np.int32)), *columns], names)


def _count_rows(subjects: pa.Array, others: np.ndarray) -> pa.RecordBatch:
    return _batch(subjects, pa.nulls(len(subjects), pa.string()), others.astype(np.int64), np.zeros(len(subjects)))


def _encode(minutes: Minutes, subjects: pa.Array, dates: pa.Array, odd: pa.Array, readings: pa.Array) -> pa.RecordBatch:
    """One row per day from folded minutes; the texts are named for each of the days."""
    counts = np.diff(_runs(minutes.day), append=len(minutes.day))
    n, firsts = len(counts), _firsts(counts)
    day = np.repeat(np.arange(n), counts)
    # Odd times stand last in their day, each once: their place in its list follows.
    is_odd = minutes.time >= _SECONDS
    odds = np.bincount(day[is_odd], minlength=n)
    places = minutes.time[is_odd] - _SECONDS
    time = minutes.time.copy()
    time[is_odd] = _SECONDS + np.arange(len(places)) - np.repeat(_firsts(odds), odds)
    steps = np.diff(time, prepend=0)
    steps[firsts] = time[firsts]
    turns = np.diff(minutes.order, prepend=0)
    turns[firsts] = 0
    pair, most = day * len(readings) + minutes.hr, n * len(readings)
    if most <= _MOST_FLAGS:
        seen = np.zeros(most, bool)
        seen[pair] = True
        used, found = np.flatnonzero(seen), (np.cumsum(seen) - 1)[pair]
    else:
        used, found = np.unique(pair, return_inverse=True)
    distinct = np.bincount(used // max(len(readings), 1), minlength=n)
    return _batch(
        subjects,
        dates,
        np.zeros(n, np.int64),
        counts,
        pa.array(minutes.order[firsts]),
        _planes(steps, counts),
        _planes(((turns << 1) ^ (turns >> 63)).view(np.uint64), counts),
        _planes(minutes.void.astype(np.int64), counts),
        _planes(minutes.copies - 1, counts),
        _planes(found - np.repeat(_firsts(distinct), counts), counts),
        _lists(places, odd, odds),
        _lists(used % max(len(readings), 1), readings, distinct),
    )


def _decode(days: pa.Table, run: np.ndarray) -> tuple[Minutes, pa.Array, pa.Array]:
    """The minutes of packed days, whose numbers are given, with the texts of odd times and of readings."""
    counts = days["n"].to_numpy().astype(np.int64)
    rows, firsts = np.repeat(np.arange(len(counts)), counts), _firsts(counts)
    total = lambda steps: np.cumsum(steps) - np.repeat(np.concatenate([[0], np.cumsum(steps)])[firsts], counts)
    time = total(_numbers(days["times"], counts).view(np.int64))
    turns = _numbers(days["orders"], counts)
    turns = (turns >> np.uint64(1)).view(np.int64) ^ -(turns & np.uint64(1)).view(np.int64)
    order = total(turns) + np.repeat(days["first_order"].fill_null(0).to_numpy(), counts)
    is_odd = time >= _SECONDS
    codes, odd = _of_lists(days["odd_times"], rows[is_odd], time[is_odd] - _SECONDS)
    time[is_odd] = _SECONDS + codes
    hr, readings = _of_lists(days["readings"], rows, _numbers(days["hrs"], counts).view(np.int64))
    void, copies = _numbers(days["voids"], counts) > 0, _numbers(days["repeats"], counts).view(np.int64) + 1
    return Minutes(run[rows], time, order, void, hr, copies), odd, readings


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for start in range(0, batch.num_rows, CHUNK):
            part = batch.slice(start, CHUNK)
            both = [*held, part]
            if held and (sum(b.num_rows for b in both) > CHUNK or sum(b.nbytes for b in both) > MOST_BYTES):
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.Table.from_batches(held)


def _seconds(times: pa.Array, known: dict[str, int]) -> np.ndarray:
    """The second of the day of each text that is a full time, -1 for others."""
    out = []
    for text in times.to_pylist():
        if text not in known:
            match = re.fullmatch(_FULL_TIME, text, re.ASCII)
            second = int(match[1]) * 3600 + int(match[2]) * 60 + int(match[3]) if match else -1
            if not match:
                out.append(second)
                continue
            known[text] = second
        out.append(known[text])
    return np.array(out, np.int64)


def _pack(batches: Iterable[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    known: dict[str, int] = {}
    for table in _chunks(batches):
        subject, subjects = _coded(_array(table["subject_id"], pa.string()))
        dated = _array(table["date"], pa.string()).is_valid().to_numpy(zero_copy_only=False)
        if not dated.all():
            others = np.bincount(subject[~dated], minlength=len(subjects))
            seen = np.flatnonzero(others)
            yield _count_rows(subjects.take(pa.array(seen)), others[seen])
            table, subject = table.filter(pa.array(dated)), subject[dated]
        if not table.num_rows:
            continue
        date, dates = _coded(_array(table["date"], pa.string()))
        hr, readings = _coded(_array(table["hr"], pa.string()))
        time, times = _coded(_array(table["time"], pa.string()))
        seconds = _seconds(times, known)
        odd = np.flatnonzero(seconds < 0)
        seconds[odd] = _SECONDS + np.arange(len(odd))
        orders = _array(table[SRC_ORDER], pa.int64())
        void = orders.is_null().to_numpy(zero_copy_only=False)
        order = orders.fill_null(0).to_numpy()
        raw = Minutes(subject * len(dates) + date, seconds[time], order, void, hr, np.ones(len(hr), np.int64))
        folded = _fold(raw, readings, last)
        days = folded.day[_runs(folded.day)]
        found = subjects.take(pa.array(days // len(dates))), dates.take(pa.array(days % len(dates)))
        yield _encode(folded, *found, times.take(pa.array(odd)), readings)


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The packed days, so many at a time that they hold no more minutes than a chunk, one at least."""
    for batch in batches:
        size = np.cumsum(batch.column("n").to_numpy().astype(np.int64) + 1)
        start = 0
        while start < batch.num_rows:
            before = size[start - 1] if start else 0
            end = max(int(np.searchsorted(size, before + CHUNK, side="right")), start + 1)
            yield batch.slice(start, end - start)
            start = end


def _longest(texts: pa.Array) -> int:
    return pc.max(pc.binary_length(texts)).as_py() or 0


def _unpack(batches: Iterable[pa.RecordBatch], last: bool) -> Iterator[pa.RecordBatch]:
    """Folded minutes from days that come sorted. The last day of a slice may go on in the next, so it waits, folded."""
    names = [column.split()[0] for column in _FOLDED.split(", ")]
    usual = pa.array([f"{h:02d}:{m:02d}:{s:02d}" for h in range(24) for m in range(60) for s in range(60)])
    waiting: list[pa.RecordBatch] = []

    def rows(subjects: pa.Array, dates: pa.Array, minutes: Minutes, times: pa.Array, readings: pa.Array) -> pa.RecordBatch:
        orders = pa.array(minutes.order, mask=minutes.void)
        hrs, recorded = readings.take(pa.array(minutes.hr)), pa.repeat(False, len(minutes.hr))
        return pa.RecordBatch.from_arrays(
            [subjects, dates, times.take(pa.array(minutes.time)), hrs, orders, pa.array(minutes.copies), recorded], names
        )

    def markers(subjects: pa.Array, others: np.ndarray) -> pa.RecordBatch:
        empty = [pa.nulls(len(subjects), kind) for kind in (pa.string(), pa.string(), pa.string(), pa.int64())]
        return pa.RecordBatch.from_arrays([subjects, *empty, pa.array(others), pa.repeat(True, len(subjects))], names)

    def unpacked(parts: list[pa.RecordBatch], ends: bool) -> Iterator[pa.RecordBatch]:
        days = pa.Table.from_batches([part.cast(parts[0].schema) for part in parts]).combine_chunks()
        subject, subjects = _coded(_array(days["subject_id"], pa.string()))
        date, dates = _coded(_array(days["date"], pa.string()))
        starts = _runs(subject, date)
        run = np.repeat(np.arange(len(starts)), np.diff(starts, append=len(subject)))
        subject, date = subject[starts], date[starts]
        others = np.add.reduceat(days["others"].to_numpy(), starts)
        minutes, odd, readings = _decode(days, run)
        folded = _fold(minutes, readings, last)
        done = len(starts) - (not ends)
        if not ends:
            stays = np.searchsorted(folded.day, done)
            tail, folded = folded.take(np.s_[stays:]), folded.take(np.s_[:stays])
            its = subjects.take(pa.array(subject[done:])), dates.take(pa.array(date[done:]))
            waiting[:] = [_encode(tail, *its, odd, readings) if len(tail.day) else _count_rows(its[0], others[done:])]
        seen = np.flatnonzero(others[:done])
        if len(seen):
            yield markers(subjects.take(pa.array(subject[seen])), others[seen])
        times = pa.concat_arrays([usual, odd]) if len(odd) else usual
        # Texts are named again in each row, so their length tells how many rows go together.
        size = max(1, MOST_BYTES // (sum(map(_longest, (subjects, dates, odd, readings))) + 1))
        for start in range(0, len(folded.day), size):
            part = folded.take(np.s_[start : start + size])
            found = subjects.take(pa.array(subject[part.day])), dates.take(pa.array(date[part.day]))
            yield rows(*found, part, times, readings)

    for batch in _slices(batches):
        if batch.num_rows:
            yield from unpacked([*waiting, batch], ends=False)
    if waiting:
        yield from unpacked(waiting, ends=True)
