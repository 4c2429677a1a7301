"""Packing of documents into fixed-length training sequences by shortest-pack-first over the length histogram.

A document is encoded, ended with one id, and cut into pieces of `size` ids and a rest. The histogram of piece lengths
has at most `size` entries whatever the size of the corpus, so the placement is done on it alone: lengths from the
longest to the shortest, each into the shortest pack that it still fits, a pack being a pattern with a count. The
patterns are then joined back to the pieces: the pieces of one length are numbered, and each slot of a pattern takes a
range of those numbers.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.llm.common import stored, text_of

SIZE = 1024
END_ID = 0
MEMO_UNITS = 600_000
BUCKET_ROWS = 20_000

# Fixed value: the pre-tokenizer of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# A blank inside or at the end of a run of white space isn't a safe place to cut a text.
UNSAFE = re.compile(r"\s (?=\s|\Z)")


def _ranks(path: str) -> dict[bytes, int] | None:
    """The vocabulary as ranks by bytes, where its ids follow the order of its merges; else None."""
    model = json.loads(Path(path).read_text())["model"]
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in merges]
    if any(x >= y for x, y in zip(made, made[1:])):
        return None
    # A byte stands for itself if printable, else for the next character from 256 on.
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    return {bytes(of[c] for c in token): i for token, i in model["vocab"].items() if all(c in of for c in token)}


class Ids:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, for a byte-level BPE tokenizer.

    Its pre-tokenizer always starts a new token at a blank that has no white space on both sides, so a text is cut there
    into units and each distinct unit is encoded once; the memo is emptied at `MEMO_UNITS` units. Texts with other
    blanks or with a special string are encoded whole. Units of Latin letters go through an encoder for the same
    vocabulary that is faster on short strings; both split such text alike."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.memo = Tokenizer.from_file(path), {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = _ranks(path)
        self.quick = ranks and tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _learn(self, new: set[str]) -> None:
        quick = [u for u in new if self.quick and (u.isascii() or max(u) < "\u0100")]
        for u in quick:
            self.memo[u] = pack_ids(self.quick(" " + u))
        rest = list(new.difference(quick))
        for at in range(0, len(rest), 4096):
            part = rest[at:at + 4096]
            found = self.tokenizer.encode_batch_fast([" " + u for u in part], add_special_tokens=False)
            self.memo.update((u, pack_ids(e.ids)) for u, e in zip(part, found, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        units = [None if UNSAFE.search(t) or any(s in t for s in self.special) else t.split(" ") for t in texts]
        seen = set().union(*(parts[1:] for parts in units if parts))
        new = seen - self.memo.keys()
        if len(self.memo) + len(new) > MEMO_UNITS:
            self.memo = {}
            new = seen
        self._learn(new)
        get = self.memo.__getitem__
        return [self.whole(t) if parts is None else self.whole(parts[0]) + b"".join(map(get, parts[1:]))
                for t, parts in zip(texts, units, strict=True)]


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@cache
def ids_of(path: str) -> Ids:
    """One encoder per process; a task forgets its units when it ends."""
    return Ids(path)


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(path: str, size: int, end_id: int):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ids_of(path)
        for batch in batches:
            doc_ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for at in range(0, len(texts), 256):
                rows = []
                for doc_id, coded in zip(doc_ids[at:at + 256], ids.encode(texts[at:at + 256]), strict=True):
                    coded = memoryview(coded + end)
                    n = len(coded) // 4
                    for start in range(0, n, size):
                        length = min(size, n - start)
                        rows.append((doc_id, start, length, zlib.crc32(coded[4 * start:4 * (start + length)]), n))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                 names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        ids.memo = {}
    return run


def pack_histogram(histogram: dict[int, int], size: int) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of the packing patterns for `histogram` (length -> count)."""
    by_room: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    rooms: list[int] = []  # max-heap of the rooms in use

    def add(room: int, count: int, pattern: tuple[int, ...]) -> None:
        if room not in by_room:
            by_room[room] = []
            heapq.heappush(rooms, -room)
        by_room[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while rooms and not by_room[-rooms[0]]:
                del by_room[-heapq.heappop(rooms)]
            room = -rooms[0] if rooms else 0
            if room < length:
                most = size // length
                whole, rest = divmod(left, most)
                if whole:
                    add(size - most * length, whole, (length,) * most)
                if rest:
                    add(size - rest * length, 1, (length,) * rest)
                break
            count, pattern = by_room[room].pop()
            used = min(count, left)
            if used < count:
                by_room[room].append((count - used, pattern))
            add(room - length, used, (*pattern, length))
            left -= used
    return [x for room in sorted(by_room) for x in by_room[room]]


def slots(patterns: list[tuple[int, tuple[int, ...]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset, filled): which pieces of a length go where."""
    out, used, sequence = [], {}, 0
    for count, pattern in patterns:
        offset, filled = 0, sum(pattern)
        for length in pattern:
            first = used.get(length, 0)
            out.append((length, first, first + count, sequence, offset, filled))
            used[length] = first + count
            offset += length
        sequence += count
    return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE,
         end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens, padded_tokens: one row per piece.

    A sequence is padded to `size` unless its ids are a power of two in number. NULL and empty texts are documents of
    one id, the end. Rows with NULL or repeated ids are packed as documents of their own; an empty table gives an empty
    result; other columns are ignored, whatever their names."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    pieces = stored(texts.mapInArrow(_pieces(tokenizer_path, size, end_id), PIECES), "pieces")
    # The rows of a length are numbered within buckets, so that a common length is not one task's work.
    buckets = max(256, pieces.count() // BUCKET_ROWS)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = (pieces.withColumn("rank", F.row_number().over(within) - 1).join(counts, ["length", "bucket"])
              .withColumn("rank", F.col("rank") + F.col("before")))
    places = spark.createDataFrame(slots(pack_histogram(histogram, size)),
                                   "length long, first long, end long, sequence long, offset long, sequence_tokens long")
    # The number of slots is bounded by the square of the sequence length, whatever the number of documents.
    placed = (ranked.join(F.broadcast(places), "length")
              .where((F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))))
    full = F.when(F.expr("(sequence_tokens & (sequence_tokens - 1)) = 0"), F.col("sequence_tokens")).otherwise(F.lit(size))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                         (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset", "sequence_tokens",
                         full.cast("long").alias("padded_tokens"))
