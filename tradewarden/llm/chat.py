"""Conversations as training texts with a loss mask, by columnar byte assembly.

A turn is written as `<turn>role`, a line break, its text, a line break, `</turn>` and a line break. A text may hold the two
control strings itself: each gets one backslash more in front of it than it has, and loses it when it is read, so a control
string without a backslash is always the template's, and every other text stands in the output as it is. The line break before the
closing mark keeps a text's last backslashes away from it. In a role, which ends with its line, `\\`, a line break and `<` are
written as `\\\\`, `\\n` and `\\l`.

Rows meet by conversation, sorted. For a batch of them the lengths of all segments (header, text, escapes, closing mark), their
cumulative offsets and the scatter indices are computed in numpy, and everything is copied into one preallocated buffer,
which becomes the Arrow column. A conversation longer than `part_bytes` is cut between turns into numbered parts by a
distributed running total, so no task ever gathers it; its parts put together are its text.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewarden.llm.bytes import flat, scatter, strings
from tradewarden.llm.common import text_of
from tradewarden.operators.joins import keyed_join
from tradewarden.operators.ranking import running_total

#: Bytes of a conversation from which on it is cut into parts of about this size.
PART_BYTES = 4 << 20
#: Bytes that a turn weighs besides its text.
TURN_BYTES = 64
#: Bytes assembled in one buffer; a part longer than this has a buffer of its own.
BUFFER_BYTES = 8 << 20

# The template.
OPEN, CLOSE, END = "<turn>", "</turn>", "\n</turn>\n"
LOSS_ROLE = "assistant"

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FORMATTED = "key string, part long, n_turns long, text string, loss array<struct<start:long,end:long>>"


def header(role: str) -> str:
    return OPEN + role.replace("\\", "\\\\").replace("\n", "\\n").replace("<", "\\l") + "\n"


def _control_strings(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where control strings begin that lie within one text."""
    found = []
    opening = np.flatnonzero(raw == ord("<"))
    for control in (OPEN.encode(), CLOSE.encode()):
        p = opening[opening + len(control) <= len(raw)]
        for k, c in enumerate(control):
            p = p[raw[p + k] == c]
        found.append(p[np.searchsorted(at, p, side="right") == np.searchsorted(at, p + len(control) - 1, side="right")])
    return np.sort(np.concatenate(found))


def assemble(groups: np.ndarray, roles: pa.StringArray, texts: pa.StringArray) -> tuple[pa.StringArray, pa.ListArray]:
    """The formatted text of each group of rows and its loss spans in code points; `groups` holds the groups' first rows
    and the number of rows."""
    coded = roles.dictionary_encode()
    kinds, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    heads = [header(r) for r in kinds]
    head_raw = np.frombuffer("".join(heads).encode(), np.uint8)
    head_bytes = np.array([len(h.encode()) for h in heads])
    head_at = np.cumsum(head_bytes) - head_bytes

    raw, at = flat(texts)
    marks = _control_strings(raw, at)
    row_of_mark = np.searchsorted(at, marks, side="right") - 1
    escapes = np.bincount(row_of_mark, minlength=len(texts))
    text_bytes, end = np.diff(at), len(END)

    # Rows in the output: header, text with its escapes, closing mark.
    row_end = np.cumsum(head_bytes[code] + text_bytes + escapes + end)
    row_at = np.append(0, row_end)
    text_at = row_at[:-1] + head_bytes[code]
    out = np.empty(row_at[-1], np.uint8)
    scatter(out, row_at[:-1], head_raw, head_at[code], head_bytes[code])
    scatter(out, row_end - end, np.frombuffer(END.encode(), np.uint8), np.zeros(len(texts), np.int64), np.full(len(texts), end))
    # Texts are cut at their control strings; the k-th cut of a text moves what follows by k bytes.
    cut = np.sort(np.concatenate([at[:-1], marks]))
    row = np.concatenate([np.arange(len(texts)), row_of_mark])[np.argsort(np.concatenate([at[:-1], marks]), kind="stable")]
    moved = np.arange(len(cut)) - np.searchsorted(row, row)
    place = text_at[row] + cut - at[row] + moved
    scatter(out, place, raw, cut, np.diff(np.append(cut, len(raw))))
    out[place[moved > 0] - 1] = ord("\\")

    chars = pc.utf8_length(texts).to_numpy() + escapes
    head_chars = np.array([len(h) for h in heads])[code]
    row_chars = np.cumsum(head_chars + chars + end) - (head_chars + chars + end)
    first = np.repeat(row_chars[groups[:-1]], np.diff(groups))
    start = row_chars + head_chars - first
    learnt = np.flatnonzero(np.array([r == LOSS_ROLE for r in kinds])[code])
    spans = pa.StructArray.from_arrays([pa.array(start[learnt]), pa.array((start + chars)[learnt])], ["start", "end"])
    return strings(row_at[groups], out), pa.ListArray.from_arrays(pa.array(np.searchsorted(learnt, groups), pa.int32()), spans)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formatted parts from rows that are sorted by key and part; a batch's last part waits for the next batch."""
    def finish(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        key, part, role, text = (rows.column(c).chunk(0) for c in ("key", "part", "role", "text"))
        first = _starts(key, part)
        size = np.diff(flat(text)[1][np.append(first, len(key))])
        block = (np.cumsum(size) - 1) // BUFFER_BYTES
        for some in np.split(np.arange(len(first)), np.flatnonzero(np.diff(block)) + 1):
            lo, hi = first[some[0]], first[some[-1] + 1] if some[-1] + 1 < len(first) else len(key)
            groups = np.append(first[some], hi) - lo
            formatted, loss = assemble(groups, role.slice(lo, hi - lo), text.slice(lo, hi - lo))
            heads = pa.array(first[some])
            yield pa.RecordBatch.from_arrays([key.take(heads), part.take(heads), pa.array(np.diff(groups), pa.int64()), formatted, loss],
                                             names=["key", "part", "n_turns", "text", "loss"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        if waiting and not _same_part(waiting[-1], batch):
            yield from finish(pa.Table.from_batches(waiting))
            waiting = []
        last = int(_starts(batch.column("key"), batch.column("part"))[-1])
        if last:
            yield from finish(pa.Table.from_batches([*waiting, batch.slice(0, last)]))
            waiting = []
        waiting.append(batch.slice(last))
    if waiting:
        yield from finish(pa.Table.from_batches(waiting))


def _starts(key: pa.Array, part: pa.Array) -> np.ndarray:
    """Rows at which a part begins."""
    if len(key) < 2:
        return np.arange(len(key))
    new = pc.or_(pc.not_equal(key[1:], key[:-1]), pc.not_equal(part[1:], part[:-1])).to_numpy(zero_copy_only=False)
    return np.append(0, np.flatnonzero(new) + 1)


def _same_part(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
    return all(a.column(c)[len(a) - 1] == b.column(c)[0] for c in ("key", "part"))


def format_conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                         text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """(conv_id, part, whole, n_turns, text, loss): the formatted conversations, in parts where they are long.

    `loss` lists the spans of the part's text, in code points from 0, that hold what the assistant says, escapes included.
    Turns stand in the order of turn, role and text, a NULL turn first. A NULL role or text is empty; the rows without a
    conversation form one conversation of their own; repeated rows are repeated turns. Other columns are left out, whatever
    their names; an empty table gives an empty table. Long texts are never cut: a part holds whole turns."""
    id_type = rows.schema[conv_col].dataType
    conv = F.col(f"`{conv_col}`")
    turns = rows.select(F.when(conv.isNull(), "").otherwise(F.concat(F.lit("="), conv.cast("string"))).alias("key"),
                        F.col(f"`{turn_col}`").alias("turn"), text_of(role_col).alias("role"), text_of(text_col).alias("text"))
    weight = (F.octet_length("text") + TURN_BYTES).cast("long")
    long = (turns.groupBy("key").agg(F.sum(weight).alias("size"), F.count("*").alias("n"))
            .where(F.col("size") > part_bytes).select("key", "n"))
    whole = turns.withColumn("part", F.lit(-1).cast("long"))
    if not long.isEmpty():
        marked = keyed_join(turns, long, ["key"], "n", "text", "left")
        # Equal rows are interchangeable; numbers tell them apart, so that they too can lie in several slices.
        cut = marked.where(F.col("n").isNotNull()).withColumns({"w": weight, "uid": F.monotonically_increasing_id()})
        cut = running_total(cut, ["turn", "role", "text", "uid"], {"before": "w"}, ["key"])
        whole = marked.where(F.col("n").isNull()).select(*turns.columns, F.lit(-1).cast("long").alias("part")).unionByName(
            cut.select(*turns.columns, F.floor(F.col("before") / part_bytes).alias("part")))
    together = whole.repartition("key", "part").sortWithinPartitions("key", "part", "turn", "role", "text")
    conv_id = F.when(F.col("key") != "", F.substr("key", F.lit(2))).cast(id_type).alias(conv_col)
    return together.select("key", "part", "role", "text").mapInArrow(_format, FORMATTED).select(
        conv_id, F.greatest("part", F.lit(0)).alias("part"), (F.col("part") < 0).alias("whole"), "n_turns", "text", "loss")


# ---- reading

_TURN = re.compile(r"<turn>([^\n]*)\n(.*?)\n</turn>\n", re.DOTALL)
_ROLE = re.compile(r"\\(.)", re.DOTALL)


def plain(text: str) -> str:
    """A text without its escapes."""
    return text.replace("\\" + OPEN, OPEN).replace("\\" + CLOSE, CLOSE)


def turns_of(formatted: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of a formatted text; anything that the template doesn't allow is an error."""
    at = 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        yield _ROLE.sub(lambda x: {"n": "\n", "l": "<"}.get(x[1], x[1]), m[1]), plain(m[2])
        at = m.end()


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digest(id_type: pa.DataType):
    """Figures of each conversation, over parts that come in their order; only a running digest is kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", id_type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        done: list[tuple] = []
        state: list | None = None

        def close() -> None:
            done.append((state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]))
        for batch in batches:
            for i in range(len(batch)):
                conv, part, text = (batch.column(c)[i].as_py() for c in ("conv_id", "part", "text"))
                if part == 0 or state is None:
                    if state is not None:
                        close()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in turns_of(text):
                    state[1] += 1
                    state[2].update(f"{role}\n{said}\n".encode())
                for span in batch.column("loss")[i].as_py():
                    said = plain(text[span["start"]:span["end"]])
                    state[3] += len(said)
                    state[4].update(said.encode())
                state[5] += len(text)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*done), schema)] if done else
                                             [pa.array([], f.type) for f in schema], schema=schema)
            done = []
        if state is not None:
            close()
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*done), schema)], schema=schema)
    return run


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from formatted conversations: what a reader
    finds in the texts and under their masks. The digests run over a conversation's parts in their order, one part at a time."""
    kind = formatted.schema["conv_id"].dataType
    schema = f"conv_id {kind.simpleString()}, " + DIGESTS.split(", ", 1)[1]
    arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    narrow = formatted.select("conv_id", "part", "text", "loss", "whole")
    parted = narrow.where(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return narrow.where("whole").drop("whole").mapInArrow(_digest(arrow), schema).unionByName(
        parted.drop("whole").mapInArrow(_digest(arrow), schema))
