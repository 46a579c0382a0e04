"""Chat formatting: reversible escapes, machine, digests read back."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_helpers import by_id, tables  # noqa: F401
from pyspark.sql import functions as F

from chainmetrics.llm import chat, queries

CODEC = chat.Codec(chat.INSTRUCT)
BITS = st.lists(st.sampled_from([*chat.INSTRUCT.controls(), "\\", "<", "[", "/", "s>", "INST]", "a", "é", "\n", "]", ">"]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.sampled_from(["user", "assistant", "system", "tool", "</s>", ""]), BITS)
def test_turns_are_read_back(role, text):
    formatted = "".join(s for s, _ in CODEC.segments(role, text))
    assert CODEC.parse(formatted + "<s>x</s>") == (role, text, len(formatted))
    assert CODEC.unescape(CODEC.escape(text)) == text


def test_ambiguous_templates_are_refused():
    with pytest.raises(ValueError):
        chat.Codec(chat.Template({"user": chat.Turn("<<", "</u>")}, chat.Turn("[r", "[/r]"), "[n]", {"": ("user",)}))


def expected(rows):
    convs = {}
    for c, turn, role, text in rows:
        convs.setdefault(c, []).append((turn if turn is not None else -1, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query(spark, tables):
    r = random.Random(6)
    rows = [(c, t, r.choice(["user", "assistant", "system", "tool"]), r.choice(["</s>", "[INST] x", "ok\\", "é" * 9, "", None]))
            for c in range(30) for t in range(r.randint(1, 9))]
    rows += [(50, 1, "user", "a"), (50, 1, "user", "a"), (None, 0, "user", "no id"), (51, None, None, None)]
    rows += [(60, t, ("user", "assistant")[t % 2], f"turn {t}") for t in range(2500)]  # one long conversation
    got = by_id(queries.QUERIES["op10_chat"](spark, tables(conversations=rows)), "conv_id")
    want = expected(rows + [(-7, t, role, "</s>[INST] ok [/INST]") for t, role in enumerate(("user", "assistant"))])
    assert {c: (x.n_turns, x.turns_sha256, x.loss_chars, x.loss_sha256) for c, x in got.items()} == want
    assert got[-7].order_ok and got[60].order_ok and not got[50].order_ok


def test_segments_and_machine(spark):
    rows = [(1, 0, "system", "s", "x"), (1, 1, "user", "q", "x"), (1, 2, "assistant", "a", "x"), (2, 0, "assistant", "a", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, loss string")
    seg = chat.format_chats(df).orderBy("conv_id", "segment_no").collect()
    assert [(s.segment, s.loss) for s in seg if s.conv_id == 1] == [
        ("<<SYS>>", False), ("s", False), ("<</SYS>>", False), ("[INST]", False), ("q", False), ("[/INST]", False),
        ("<s>", False), ("a", True), ("</s>", False)]
    assert all(s.turn_ok for s in seg if s.conv_id == 1) and not any(s.turn_ok for s in seg if s.conv_id == 2)
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0
    assert chat.format_chats(df).where(F.col("conv_end")).count() == 2
