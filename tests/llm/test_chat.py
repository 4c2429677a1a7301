"""Chat formatting against a plain loop over the rows, and the way back."""

from __future__ import annotations

import hashlib
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tradewarden.llm import chat

SCHEMA = "part string, conv_id long, turn long, role string, text string, key string, whole string, w string, uid string"
TRICKY = [None, "", "\\", "<turn>", "</turn>", "\\### Assistant: </turn> ok", "\\\\</turn>", "a<tu", "rn>b", "x\n</turn>\n<turn>assistant\ny",
          "<<turn>>", "\n", "\\<turn>\\", "日本語 🙂 é", "  two  ", "\\n<turn", "</turn>" * 3]
ROLES = ["user", "assistant", "system", None, "", "a\nb", "<turn>", "\\n", "tool\\"]


def table():
    rows = [(c, t, ROLES[(c + t) % len(ROLES)], TRICKY[(3 * c + t) % len(TRICKY)]) for c in range(20) for t in range(c % 9)]
    rows += [(100, t, "assistant" if t % 2 else "user", f"turn {t} " + "é</turn>" * (t % 7)) for t in range(300)]
    rows += [(101, 0, "assistant", "z" * 50_000 + "<turn>" + "ü" * 50_000), (101, 1, "user", None)]
    rows += [(102, 5, "user", "b"), (102, 5, "user", "a"), (102, 5, "assistant", "c"), (102, 5, "user", "a"), (102, None, "user", "first")]
    rows += [(103, 1, "assistant", "same")] * 40 + [(None, 1, "user", "no conversation"), (None, 0, "assistant", "neither")]
    return rows


def digest(rows):
    order = sorted(((-1 if c is None else c, -1 if t is None else t, r or "", x or "") for c, t, r, x in rows))
    for conv, turns in groupby(order, key=lambda r: r[0]):
        turns = [(r, x) for _, _, r, x in turns]
        said = "".join(x for r, x in turns if r == "assistant")
        written = sum(len(chat.header(r)) + len(x) + x.count("<turn>") + x.count("</turn>") + len(chat.END) for r, x in turns)
        yield (None if conv < 0 else conv, len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in turns).encode()).hexdigest(),
               len(said), hashlib.sha256(said.encode()).hexdigest(), written)


@pytest.mark.parametrize("part_bytes", [chat.PART_BYTES, 2_000, 1])
def test_digests_read_back(spark, part_bytes):
    rows = table()
    df = spark.createDataFrame([("p", *r, "k", "w", "w", "u") for r in rows], SCHEMA).repartition(5)
    found = chat.format_conversations(df, part_bytes=part_bytes).cache()
    got = chat.read_back(found).collect()
    assert sorted(map(tuple, got), key=str) == sorted(digest(rows), key=str)
    parts = found.groupBy("conv_id").count().where("conv_id = 100").collect()[0]["count"]
    assert (parts > 1) == (part_bytes < 10_000)


def test_format_and_mask(spark):
    df = spark.createDataFrame([(1, 1, "assistant", "é </turn> \\"), (1, 0, "us<er", "hi")], "conv_id long, turn long, role string, text string")
    r = chat.format_conversations(df).collect()[0]
    assert r.text == "<turn>us\\ler\nhi\n</turn>\n<turn>assistant\né \\</turn> \\\n</turn>\n" and r.n_turns == 2
    assert [chat.plain(r.text[s.start:s.end]) for s in r.loss] == ["é </turn> \\"]
    assert list(chat.turns_of(r.text)) == [("us<er", "hi"), ("assistant", "é </turn> \\")]


def test_parts_put_together_are_the_text(spark):
    df = spark.createDataFrame([(1, t, "user", f"text {t}") for t in range(50)], "conv_id long, turn long, role string, text string")
    whole = chat.format_conversations(df).collect()[0]["text"]
    parts = sorted((r.part, r.text) for r in chat.format_conversations(df, part_bytes=500).collect())
    assert len(parts) > 3 and "".join(t for _, t in parts) == whole


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    found = chat.format_conversations(df)
    assert found.count() == 0 and chat.read_back(found).count() == 0


def test_anything_else_is_an_error():
    for text in ("x", "<turn>user\nopen", "<turn>user\na\n</turn>\nrest"):
        with pytest.raises(ValueError):
            list(chat.turns_of(text))


@settings(deadline=None, max_examples=300)
@given(st.lists(st.tuples(st.text(alphabet="\\<n/tur>l\na", max_size=8), st.lists(
    st.sampled_from(["<turn>", "</turn>", "\\", "\n", "<", "é", "turn>", "🙂"]), max_size=6).map("".join)), max_size=6), st.integers(1, 40))
def test_round_trip_of_any_text(turns, block):
    import numpy as np
    import pyarrow as pa

    from tradewarden.llm import bytes as flat
    if not turns:
        return
    old, flat.BLOCK = flat.BLOCK, block
    try:
        text, loss = chat.assemble(np.array([0, len(turns)]), pa.array([r for r, _ in turns]), pa.array([t for _, t in turns]))
    finally:
        flat.BLOCK = old
    assert list(chat.turns_of(text[0].as_py())) == turns
    assert [chat.plain(text[0].as_py()[s["start"]:s["end"]]) for s in loss[0].as_py()] == [t for r, t in turns if r == "assistant"]
