"""Chat formatting: a state machine checks the turns, a template turns them into segments.

A template names the header of each role, the end of a turn, the escape character and the roles
whose text is learned. A turn becomes three segments: header, text, end; only the text of a
learned role carries the loss flag. Inside a text, the escape character is doubled and every
character of a control string gets one, so control strings in the output are control strings of
the template, and ``read_back`` restores every text exactly.

The state machine runs over the roles in order of turn: a conversation starts with ``system`` or
``user``, then ``user`` and ``assistant`` take turns. ``valid`` says whether it accepts all turns
so far; turns that it does not accept are formatted all the same, none is dropped.

Rows are sorted by (conv_id, turn, role, text), which settles ties; a null text counts as empty,
a null or unknown role is written out after ``role=``, a null conv_id is one conversation.
Conversations run through a task as a stream, turn by turn, so one of any length needs no more
memory than its longest turn. Other columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import only

SEGMENTS = "conv_id long, turn_number long, part int, text string, loss boolean, valid boolean"
DIGESTS = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
    "formatted_chars long, valid boolean"
)

#: Which roles may follow a state; a state is the role before, or start.
ORDER = {
    "start": ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user",),
}


@dataclass(frozen=True)
class Template:
    headers: dict[str, str] = field(
        default_factory=lambda: {"system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "}
    )
    other: tuple[str, str] = ("### role=", ": ")
    end: str = "</turn>\n"
    escape: str = "\\"
    learned: frozenset[str] = frozenset({"assistant"})

    def controls(self) -> list[str]:
        """The strings that a text may not hold unescaped, longest first."""
        found = {self.escape, self.end.strip(), self.other[0].strip(), *(h.strip() for h in self.headers.values())}
        return sorted(found, key=lambda c: (-len(c), c))


class Codec:
    def __init__(self, template: Template):
        self.template = template
        self._controls = re.compile("|".join(map(re.escape, template.controls())))
        one = re.escape(template.escape)
        self._escaped = re.compile(f"{one}(.)", re.DOTALL)
        self._end = re.compile(f"(?:[^{one}]|{one}.)*?(?={re.escape(template.end)})", re.DOTALL)

    def escape(self, text: str) -> str:
        mark = self.template.escape
        return self._controls.sub(lambda m: "".join(mark + c for c in m[0]), text)

    def unescape(self, text: str) -> str:
        return self._escaped.sub(r"\1", text)

    def segments(self, role: str | None, text: str | None) -> list[tuple[str, bool]]:
        t = self.template
        header = t.headers.get(role) or t.other[0] + self.escape(role or "").replace(t.other[1], t.escape.join(("", *t.other[1]))) + t.other[1]
        return [(header, False), (self.escape(text or ""), role in t.learned), (t.end, False)]

    def read(self, formatted: str) -> tuple[str, str]:
        """(role, text) of one formatted turn."""
        body = self._end.match(formatted)
        if not body or body.end() + len(self.template.end) != len(formatted):
            raise ValueError("a turn does not end where its end mark is")
        body = body[0]
        for role, header in self.template.headers.items():
            if body.startswith(header):
                return role, self.unescape(body[len(header) :])
        before, after = self.template.other
        if not body.startswith(before):
            raise ValueError("a turn starts with no header")
        mark = re.escape(self.template.escape)
        role = re.match(f"(?:[^{mark}]|{mark}.)*?(?={re.escape(after)})", body[len(before) :], re.DOTALL)[0]
        return self.unescape(role), self.unescape(body[len(before) + len(role) + len(after) :])


def format_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """``SEGMENTS``: three rows for each turn, conversations whole and in order within a partition."""
    rows = only(conversations, ("conv_id", "turn", "role", "text"), "conversations")
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, current, state, valid, number = Codec(template), object(), "start", True, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv != current:
                    current, state, valid, number = conv, "start", True, 0
                valid = valid and role in ORDER.get(state, ())
                state = role
                out += [(conv, number, k, text_, loss, valid) for k, (text_, loss) in enumerate(codec.segments(role, text))]
                number += 1
            yield _batch(out, SEGMENTS)

    return rows.mapInArrow(run, SEGMENTS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def digests(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """``DIGESTS`` of every conversation, read back from the segments as ``format_turns`` orders them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, now = Codec(template), None
        turn: list[str] = []
        for batch in batches:
            out = []
            for conv, number, part, text, loss, valid in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number == 0 and part == 0:
                    if now:
                        out.append(now.row())
                    now = _Digest(conv)
                turn.append(text)
                now.chars += len(text)
                if loss:
                    learned = codec.unescape(text)
                    now.loss_chars += len(learned)
                    now.loss.update(learned.encode())
                if part == 2:
                    role, plain = codec.read("".join(turn))
                    now.turns += 1
                    now.all.update(f"{role}\n{plain}\n".encode())
                    now.valid = valid
                    turn = []
            if out:
                yield _batch(out, DIGESTS)
        if now:
            yield _batch([now.row()], DIGESTS)

    return segments.select(*[c.split()[0] for c in SEGMENTS.split(", ")]).mapInArrow(run, DIGESTS)


class _Digest:
    def __init__(self, conv: int | None):
        self.conv, self.turns, self.chars, self.loss_chars, self.valid = conv, 0, 0, 0, True
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def row(self) -> tuple:
        return self.conv, self.turns, self.all.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid
