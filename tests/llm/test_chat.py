"""Chat formatting: the grammar, its escapes, and what is read back."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from zonelens.llm import chat

PIECES = st.lists(st.sampled_from(["</s>", "<s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "\\", "<", "[",
                                   "/s>", "INST]", " ", "a", "\n", "é"]), max_size=8).map("".join)
TURNS = "conv_id long, turn long, role string, text string, segment int, loss string"


@settings(max_examples=500, deadline=None)
@given(role=st.one_of(st.sampled_from(["user", "assistant", "system", ""]), PIECES), text=PIECES)
def test_every_turn_reads_back(role, text):
    assert chat.unescape(chat.escape(text)) == text
    piece = chat.settled(role, text)
    assert [t[:2] for t in chat.Parser(piece).turns()] == [(role, text)]


@settings(max_examples=200, deadline=None)
@given(turns=st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]), PIECES), max_size=6))
def test_conversations_read_back(turns):
    said = "".join(chat.settled(*t) for t in turns)
    assert [t[:2] for t in chat.Parser(said).turns()] == turns


def test_plain_text_is_not_escaped():
    for text in ("a < b", "see [1]", "C:\\dir", "<b>", "[INST", ""):
        assert chat.settled("user", text) == f"[INST] {text} [/INST]"
    assert chat.settled("assistant", "</s>") == " <\\/s></s>"
    assert chat.settled("assistant", "<\\/s>") == " <\\\\/s></s>"


@pytest.mark.parametrize("bad", ["[INST] a", "[INST] a</s>", "a</s>", " a[/INST]", "[ROLE] x [/ROLE]y</s>", "[INST]a [/INST]", "<s>"])
def test_the_parser_refuses(bad):
    with pytest.raises(chat.GrammarError):
        list(chat.Parser(bad).turns())


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x, *_ in rows if c == conv))
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("segment_chars", [1, 40, 1 << 20])
def test_odd_conversations(spark, segment_chars):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello </s> [INST] x"), (1, 1, "assistant", "hello </s> [INST] x"),
            (2, None, None, None), (2, 3, "assistant", ""), (2, 3, "assistant", None), (3, 0, "[ROLE] x\n</s>", "<s>é\U0001f600"),
            (None, 0, "user", "no id"), (None, 1, "assistant", "still\n"), (4, 0, "assistant", "word " * 50_000),
            *((5, k, ("user", "assistant")[k % 2], f"turn {k} " + "<s>" * (k % 3)) for k in range(700))]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], TURNS)
    formatted = chat.format_chats(df, segment_chars)
    for got in (chat.read_back(formatted, in_order=True), chat.read_back(formatted.repartition(3))):
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got.collect()}
        assert got == expected(rows)
    parts = formatted.filter("conv_id = 1").orderBy("segment").collect()
    text = "".join(p.text for p in parts)
    assert text == "<s>[INST] hi [/INST]" + " hello <\\/s> [\\INST] x</s>" * 2
    assert [p.text[s.start:s.end] for p in parts for s in p.loss] == ["hello <\\/s> [\\INST] x"] * 2
    if segment_chars == 40:
        assert formatted.filter("conv_id = 5").count() > 100


def test_no_conversations(spark):
    assert chat.read_back(chat.format_chats(spark.createDataFrame([], TURNS))).collect() == []
