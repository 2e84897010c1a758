"""Words, word hashes and word windows of many texts at once, in numpy.

A text is UTF-8 bytes; None counts as empty. A word is a maximal run of word bytes: every byte
but white space by default. Hashes are 64-bit: a polynomial over the word's bytes, mixed. Two
different words or windows share a hash with a chance of about 2**-60.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
WINDOW = 5

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
NOT_WHITE = ~WHITE
#: ASCII letters and every byte of a non-ASCII character.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of a 64-bit value over the others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(count, _BASE, np.uint64)
    down = np.full(count, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


@dataclass
class Words:
    """One entry per word, in text order: its text's number, its hash, its hash up to the prefix length."""

    text: np.ndarray
    hash: np.ndarray
    prefix: np.ndarray
    n_texts: int

    def counts(self) -> np.ndarray:
        return np.bincount(self.text, minlength=self.n_texts)

    def windows(self, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the first words, hashes) of all windows that stay within a text."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[:n] == self.text[size - 1 :])
        joined = np.zeros(len(at), np.uint64)
        for k in range(size):
            joined = mix(joined * _STEP + self.hash[at + k])
        return at, joined


class WordReader:
    """Splits texts into hashed words. Keeps the powers it needs, so make one per task."""

    def __init__(self, word_bytes: np.ndarray = NOT_WHITE, lower: bool = False, prefix: int = 4):
        self.word_bytes, self.lower, self.prefix = word_bytes, lower, prefix
        self._up, self._down = powers(BLOCK_BYTES + 1)

    def read(self, texts: list[bytes | None]) -> Words:
        data = np.frombuffer(b"\n".join(t or b"" for t in texts), np.uint8)
        ends = np.cumsum([len(t or b"") + 1 for t in texts], dtype=np.int64)
        starts, hashes, prefixes = [], [], []
        for at, block in self._blocks(data):
            s, h, p = self._block(block)
            starts.append(s + at)
            hashes.append(h)
            prefixes.append(p)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        start = join(starts, np.int64)
        text = np.searchsorted(ends, start, side="right")
        return Words(text, join(hashes, np.uint64), join(prefixes, np.uint64), len(texts))

    def _blocks(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Cuts the bytes between words, so that long texts need no long arrays of 64-bit values."""
        at = 0
        while at < len(data):
            end = min(at + BLOCK_BYTES, len(data))
            while end < len(data):
                gaps = np.flatnonzero(~self.word_bytes[data[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                    break
                end = min(end + BLOCK_BYTES, len(data))
            yield at, data[at:end]
            at = end

    def _block(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if len(data) >= len(self._up):
            self._up, self._down = powers(len(data) + 1)
        edge = np.diff(self.word_bytes[data].astype(np.int8), prepend=0, append=0)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if self.lower:
            data = _LOWER[data]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self._up[: len(data)], out=sums[1:])
        back = self._down[start]
        whole = mix((sums[end] - sums[start]) * back)
        first = mix((sums[np.minimum(end, start + self.prefix)] - sums[start]) * back)
        return start, whole, first


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of runs of rows that hold about so many bytes, or one row that holds more."""
    column = column.cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]) if len(column) else np.zeros(0, np.int64)
    at = 0
    while at < len(column):
        total, end = int(sizes[at]), at + 1
        while end < len(column) and total + sizes[end] <= limit:
            total += int(sizes[end])
            end += 1
        yield at, column.slice(at, end - at).to_pylist()
        at = end
