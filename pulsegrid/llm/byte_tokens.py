"""Token ids of the byte-level vocabulary.

The rank file holds the vocabulary that tokenizers reads from its JSON file; tiktoken gives the
same ids from it, several times as fast (the tests compare both).

tiktoken's pattern matcher fails on a run of about a million white-space characters. In a run of
``LONG_RUN`` or more, the pattern's own cut is made here: it takes a run whole at the end of a text or
before a special string, and otherwise leaves the run's last character to what follows.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array

#: The pattern that splits text before the merges, and the one special token.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = {"<|endoftext|>": 50256}
#: Runs of what the pattern's \s matches; Python's own also holds U+001C to U+001F.
_SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LONG_RUN = 100_000


class ByteEncoder:
    """Texts to ids, as little-endian unsigned numbers of 4 or 2 bytes. Special strings become their one id."""

    def __init__(self, ranks_path: str, width: int = 4):
        import tiktoken

        self._kind = {4: "I", 2: "H"}[width]
        if array(self._kind).itemsize != width or sys.byteorder != "little":
            raise RuntimeError("ids are stored as the machine's own numbers, which must be little-endian")
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._encoding = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        runs = [m.span() for m in _SPACES.finditer(text) if m.end() - m.start() >= LONG_RUN] if len(text) >= LONG_RUN else []
        return array(self._kind, self._around(text, runs) if runs else self._ids(text)).tobytes()

    def _ids(self, text: str) -> list[int]:
        if any(special in text for special in SPECIAL):
            return self._encoding.encode(text, allowed_special="all")
        return self._encoding.encode_ordinary(text)

    def _around(self, text: str, runs: list[tuple[int, int]]) -> list[int]:
        """The ids of a text with long runs: each is a piece of its own, like the texts between them."""
        ids, at = [], 0
        for start, end in runs:
            whole = end == len(text) or any(text.startswith(special, end) for special in SPECIAL)
            ids += self._ids(text[at:start])
            at = end if whole else end - 1
            ids += self._encoding._encode_single_piece(text[start:at])
        return ids + self._ids(text[at:])
