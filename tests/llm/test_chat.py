import hashlib

from hypothesis import given
from hypothesis import strategies as st

from pulsegrid.llm import chat

PIECES = st.sampled_from(["### User: ", "### Assistant:", "###", "</turn>", "</turn>\n", "\\", "#", "\n", "x", "### role=", ": ", "é"])
TEXTS = st.lists(PIECES, max_size=12).map("".join)


@given(TEXTS, st.sampled_from(["user", "assistant", "system", "tool", "", None, "a: b", "### role="]))
def test_a_turn_is_read_back_as_it_was(text, role):
    codec = chat.Codec(chat.Template())
    segments = codec.segments(role, text)
    assert codec.read("".join(s for s, _ in segments)) == (role or "", text)
    assert [loss for _, loss in segments] == [False, role == "assistant", False]
    escaped = segments[1][0]
    assert codec.unescape(escaped) == text
    bare = escaped.replace("\\\\", "")
    assert not any(c in bare for c in ("### User:", "</turn>", "### role="))


def digest(turns):
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    learned = "".join(text for role, text in turns if role == "assistant")
    return [len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest()]


def test_conversations_in_order_whatever_the_rows_order(spark):
    rows = [
        (1, 2, "assistant", "two </turn>"),
        (1, 0, "system", None),
        (1, 1, "user", "one\\"),
        (2, 0, "assistant", "too early"),
        (3, 5, "user", "b"),
        (3, 5, "user", "a"),
        (None, 0, "user", "no id"),
        (4, None, None, "no turn"),
        (4, 1, "tool", ""),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as part", "true as loss")
    found = {r.conv_id: list(r) for r in chat.digests(chat.format_turns(frame)).collect()}
    want = {
        1: [("system", ""), ("user", "one\\"), ("assistant", "two </turn>")],
        2: [("assistant", "too early")],
        3: [("user", "a"), ("user", "b")],
        None: [("user", "no id")],
        4: [("", "no turn"), ("tool", "")],
    }
    assert found.keys() == want.keys()
    for conv, turns in want.items():
        assert found[conv][1:5] == digest(turns)
    assert [found[c][6] for c in (1, 2, 3, None, 4)] == [True, False, False, True, False]
    assert chat.digests(chat.format_turns(frame.limit(0))).collect() == []


def test_a_long_conversation_is_one_stream(spark):
    frame = spark.range(20_000).selectExpr(
        "1 as conv_id", "id as turn", "case when id % 2 = 0 then 'user' else 'assistant' end as role", "concat('t', id) as text"
    )
    row = chat.digests(chat.format_turns(frame)).collect()
    turns = [("user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(20_000)]
    assert len(row) == 1 and list(row[0])[1:5] == digest(turns) and row[0].valid
