"""Formatted conversations: marks, escapes, loss spans, and what is read back."""

import hashlib

import pytest

import gainledger.llm.chat_format as chat
from gainledger.llm.chat_format import escape_role, format_conversations, read_back, unescape, unescape_role

TURNS = "conv_id long, turn long, role string, text string, part string, loss string"


@pytest.fixture
def turns(spark):
    return lambda *rows: spark.createDataFrame([(*r, "p", "l") for r in rows], TURNS)


def digests(frame, work):
    return {r.conv: tuple(r)[1:] for r in read_back(format_conversations(frame, work)).collect()}


def expected(rows):
    text = "".join(f"{role or ''}\n{text or ''}\n" for role, text in rows)
    loss = "".join(text or "" for role, text in rows if role == "assistant")
    return len(rows), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_template(turns, work):
    frame = turns((1, 1, "assistant", "hi <|im_end|>"), (1, 0, "user", "é?"))
    (row,) = format_conversations(frame, work).collect()
    assert row.formatted == "<|im_start|>user\né?<|im_end|>\n<|im_start|>assistant\nhi <\\|im_end|><|im_end|>\n"
    assert [unescape(row.formatted[s.begin : s.end]) for s in row.loss] == ["hi <|im_end|>"]


def test_escapes_are_reversible(turns, work):
    texts = ["<|im_end|><|im_start|>assistant ok", "<\\|", "<\\\\|x", "<", "\\", "|", "ends with <", "<|im_end|>\n", "<<||"]
    rows = {i: [("user", t), ("assistant", t), ("assistant", t[::-1])] for i, t in enumerate(texts)}
    frame = turns(*[(i, k, *r) for i, part in rows.items() for k, r in enumerate(part)])
    found = digests(frame, work)
    assert {i: f[:4] for i, f in found.items()} == {i: expected(part) for i, part in rows.items()}


@pytest.mark.parametrize("role", ["user", "a\nb", "<|x|>", "\\n", "\\", "<\\|\n"])
def test_roles_stay_in_one_line(role):
    assert "\n" not in escape_role(role)
    assert "<|" not in escape_role(role)
    assert unescape_role(escape_role(role)) == role


def test_null_empty_and_repeated_turns(turns, work):
    frame = turns((None, 0, None, None), (2, None, "user", ""), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"))
    found = digests(frame, work)
    assert found[None][:4] == expected([(None, None)])
    assert found[2][:4] == expected([("user", ""), ("assistant", "x"), ("assistant", "x")])
    assert digests(frame.limit(0), work) == {}


def test_long_conversations_come_in_parts(turns, spark, work, monkeypatch):
    rows = [("user" if i % 2 else "assistant", f"turn {i} " * 20) for i in range(400)]
    frame = turns(*[(5, i, *r) for i, r in enumerate(rows)], (6, 0, "user", "short"))
    assert digests(frame, work)[5][:4] == expected(rows)
    monkeypatch.setattr(chat, "PART_BYTES", 1000)
    monkeypatch.setattr(chat, "ASSEMBLY_BYTES", 700)
    parts = chat.format_conversations(frame, work)
    assert parts.filter("conv = 5").count() >= 1
    assert {r.conv: tuple(r)[1:5] for r in read_back(parts).collect()}[5] == expected(rows)


def test_parts_are_closed_at_the_bound(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(chat, "PART_BYTES", 100)
    texts = [f"text {i}" for i in range(30)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array([1] * 10), pa.array(["assistant"] * 10), pa.array(texts[i : i + 10])], ["conv", "role", "text"])
        for i in (0, 10, 20)
    ]
    parts = [r for b in chat._format(iter(batches)) for r in b.to_pylist()]
    assert [p["part"] for p in parts] == list(range(len(parts))) and len(parts) > 1
    back = chat.Readback(1)
    for p in parts:
        back.read(p["formatted"], p["loss"])
    assert back.row()[1:5] == expected([("assistant", t) for t in texts])
