"""Chat formatting: round trips, the state machine, and the query against SQL."""

import hashlib

import compare
from hypothesis import given, settings
from hypothesis import strategies as st
from swathe.llm import chat

T = chat.Template()
TEXT = st.lists(st.sampled_from(["\\", "#", "### ", *T.controls, "</turn", ">", "a", "\n", ": ", T.closing]), max_size=8).map("".join) | st.text(max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a:b\\", "Tool", "### "]) | st.text(max_size=5), TEXT), max_size=4))
def test_formatted_turns_read_back(turns):
    formatted = "".join(T.open(role) + T.escape(text) + T.closing for role, text in turns)
    assert T.read(formatted) == turns


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, loss string, Position int")


def test_segments_and_digests(spark):
    rows = [
        (1, 0, "user", "q", "x", 1), (1, 1, "assistant", "a\\b", "x", 1), (1, 2, "user", None, "x", 1), (1, 3, "assistant", "</turn>", "x", 1),
        (2, 0, "assistant", "hi", "x", 1), (2, 1, None, "no role", "x", 1),
        (None, 0, "user", "u", "x", 1), (None, None, "user", "first", "x", 1),
        (3, 0, "user", "same", "x", 1), (3, 0, "user", "same", "x", 1),
    ]
    segments = chat.format_chat(rows_of(spark, rows))
    assert segments.columns == ["conv_id", "position", "segment", "text", "loss", "state", "valid"]
    loss = [r["text"] for r in segments.where("conv_id = 1 and loss").orderBy("position").collect()]
    assert loss == ["a\\\\b", "\\</turn>"]
    out = {r["conv_id"]: r for r in chat.digests(segments).collect()}
    assert {k: r["n_turns"] for k, r in out.items()} == {1: 4, 2: 2, None: 2, 3: 2}
    assert {k: r["valid"] for k, r in out.items()} == {1: True, 2: False, None: False, 3: False}
    assert out[1]["loss_sha256"] == hashlib.sha256(b"a\\b</turn>").hexdigest() and out[1]["loss_chars"] == 10
    assert out[None]["turns_sha256"] == hashlib.sha256(b"user\nfirst\nuser\nu\n").hexdigest()
    assert out[2]["turns_sha256"] == hashlib.sha256(b"assistant\nhi\n\nno role\n").hexdigest()


def test_long_conversation_and_no_rows(spark):
    rows = [(5, i, ("user", "assistant")[i % 2], "t" * (i % 50), "", 0) for i in range(3000)]
    out = chat.digests(chat.format_chat(rows_of(spark, rows))).first()
    assert out["n_turns"] == 3000 and out["valid"]
    assert chat.digests(chat.format_chat(rows_of(spark, rows).limit(0))).count() == 0


def test_query_agrees_with_sql(spark, sf):
    entry = compare.load_entry()
    assert compare.run(spark, compare.duck(sf), entry, "op1_chat", sf) is None
    own = entry.queries()["op1_chat"](spark, sf).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert own["loss_chars"] == len(text) and own["valid"]
    assert own["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
