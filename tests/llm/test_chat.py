import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shortlist.llm import chat

PIECES = st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "|im_end|>", "/INST]", "s>", "\n", "a", "%", "%0A", "é", "<\\|im_end|>", ""])
TEXTS = st.lists(PIECES, max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5))
def test_round_trip(turns):
    formatted, spans, _ = chat.format_turns(turns)
    assert [t for t, _ in chat.parse(formatted)] == turns
    assert [chat.unescape(formatted[a:b]) for a, b in spans] == [t for _, t in turns]


@given(TEXTS)
def test_an_escaped_text_has_no_control_string(text):
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)
    assert chat.unescape(chat.escape(text)) == text


def test_plain_turns_are_not_escaped():
    formatted, _, escaped = chat.format_turns([("user", "a \\ b"), ("assistant", "x < y")])
    assert escaped == 0 and "a \\ b" in formatted


@pytest.mark.parametrize("text", ["x", "<|im_start|>u", "<|im_start|>u\nx", "<|im_start|>u\nx<|im_end|>", "<|im_start|>u<|im_end|>\n"])
def test_other_texts_are_no_formatted_conversation(text):
    with pytest.raises(ValueError):
        chat.parse(text)


def test_conversations(rows):
    data = [
        (1, 1, "assistant", "b</s>", "x"),
        (1, 0, "user", "a", "x"),
        (1, 1, "assistant", "b</s>", "x"),
        (1, None, None, None, "x"),
        (None, 0, "assistant", None, None),
        (2, 0, "assistant", "z" * 200_000, "x"),
    ]
    df = rows("conv_id bigint, turn bigint, role string, text string, formatted string", data)
    formatted = chat.format_conversations(df)
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert back[1]["roles"] == ["", "user", "assistant", "assistant"]
    assert back[1]["texts"] == ["", "a", "b</s>", "b</s>"] and back[1]["trained"] == ["b</s>", "b</s>"]
    assert back[None]["texts"] == [""] and back[None]["trained"] == [""]
    assert back[2]["trained"] == ["z" * 200_000]
    assert {r["conv_id"]: r["escaped"] for r in formatted.collect()} == {1: 2, None: 0, 2: 0}


def test_empty_table(rows):
    df = rows("conv_id bigint, turn bigint, role string, text string", [])
    assert chat.read_back(chat.format_conversations(df)).count() == 0


def test_query_digests(spark, folder):
    from shortlist.llm.queries import PROBE
    from shortlist.llm.registry import QUERIES

    row = QUERIES["op8_chat_round_trip"](spark, folder).filter("conv_id = -1").first()
    turns = f"user\n{PROBE}\nassistant\n{PROBE}\n"
    assert row["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
    assert row["loss_chars"] == len(PROBE) and row["loss_sha256"] == hashlib.sha256(PROBE.encode()).hexdigest()
