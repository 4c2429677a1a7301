"""Token counts of whole texts by a public tokenizer, with overlap resynchronisation for huge texts.

A text up to `chunk` characters is counted in one piece. A longer one is cut into chunks that overlap by `overlap`
characters on both sides of each cut and that are encoded in separate tasks, with offsets. Two neighbours are spliced
at a boundary that is proven stable: a position after ASCII white space at which both encodings start a token. White
space is never part of a token of this tokenizer and no rule of it looks across white space, so what follows such a
position doesn't depend on what stands before it. Where an overlap has no common stable boundary, the text goes into a
further round with longer chunks and wider overlaps, at last in one piece.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.llm.common import stored, text_of

CHUNK = 32_768
OVERLAP = 1_024
LIMIT = 2_048
MEMO_WORDS = 300_000
WHITE = frozenset(" \t\n\v\f\r")


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class WordCounter:
    """Tokens of a text as the sum over its white-space separated words, each distinct word encoded once.

    The memo is emptied when it reaches `MEMO_WORDS` words, so its memory is bounded."""

    def __init__(self, path: str):
        self.tokenizer, self.memo = _tokenizer(path), {}

    def counts(self, texts: list[str]) -> list[int]:
        split = [t.encode().split() for t in texts]
        new = {w for words in split for w in words} - self.memo.keys()
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo = {}
            new = {w for words in split for w in words}
        new = list(new)
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            self.memo.update(zip(part, map(len, found), strict=True))
        return [sum(map(self.memo.__getitem__, words)) for words in split]


def _short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounter(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n: list[int] = []
            for at in range(0, len(texts), 256):
                n += counter.counts(texts[at:at + 256])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                                             names=["doc_id", "n_bytes", "n_tokens"])
    return run


def _cut(chunk: int, overlap: int):
    """Chunks of each text: core [i * chunk, (i + 1) * chunk), extended by the overlap on both sides."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                n = max(1, -(-len(text) // chunk))
                for i in range(n):
                    start = max(0, i * chunk - overlap)
                    yield pa.RecordBatch.from_pylist([{"key": key, "i": i, "n": n, "start": start,
                                                       "part": text[start:(i + 1) * chunk + overlap]}])
    return run


EDGE = "array<struct<at:long,before:long>>"
_EDGE = pa.list_(pa.struct([("at", pa.int64()), ("before", pa.int64())]))


def _encode_chunks(path: str, chunk: int, overlap: int):
    """Tokens of each chunk, and for the zones it shares with its neighbours the stable boundaries at which a token
    starts, with the number of the chunk's tokens before each."""
    def edges(part: str, start: int, starts: np.ndarray, middle: int) -> list[dict]:
        lo, hi = max(1, middle - overlap - start + 1), min(len(part), middle + overlap - start)
        found = []
        for p in range(lo, hi):
            if part[p - 1] in WHITE and part[p] not in WHITE:
                before = int(np.searchsorted(starts, p))
                if before < len(starts) and starts[before] == p:
                    found.append({"at": p + start, "before": before})
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                offsets = tokenizer.encode(r["part"], add_special_tokens=False).offsets
                starts = np.array([s for s, _ in offsets], dtype=np.int64)
                out.append((len(starts),
                            edges(r["part"], r["start"], starts, r["i"] * chunk) if r["i"] else [],
                            edges(r["part"], r["start"], starts, (r["i"] + 1) * chunk) if r["i"] + 1 < r["n"] else []))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("i"), batch.column("n"), pa.array([x[0] for x in out], pa.int64()),
                 pa.array([x[1] for x in out], _EDGE), pa.array([x[2] for x in out], _EDGE)],
                names=["key", "i", "n", "tokens", "left", "right"])
    return run


def splice(texts: DataFrame, path: str, chunk: int, overlap: int) -> DataFrame:
    """key, n_tokens of each row of `texts` (key, text); n_tokens is NULL where some overlap holds no common boundary."""
    cut = texts.mapInArrow(_cut(chunk, overlap), "key string, i long, n long, start long, part string")
    n = max(12, texts.sparkSession.sparkContext.defaultParallelism * 2)
    coded = cut.repartition(n, "key", "i").mapInArrow(
        _encode_chunks(path, chunk, overlap), f"key string, i long, n long, tokens long, left {EDGE}, right {EDGE}")
    spliced = coded.withColumn("next", F.lead("left").over(Window.partitionBy("key").orderBy("i")))
    common = F.array_intersect("right.at", "next.at")
    nearest = F.array_min(F.transform(common, lambda p: F.struct(F.abs(p - (F.col("i") + 1) * chunk), p.alias("at"))))
    spliced = spliced.withColumn("cut", nearest["at"])
    before = lambda col: F.get(F.filter(col, lambda e: e["at"] == F.col("cut")), F.lit(0))["before"]
    last = F.col("i") + 1 == F.col("n")
    own = F.when(last, F.col("tokens")).otherwise(before("right") - before("next"))
    return spliced.groupBy("key").agg(
        F.when(F.count(F.when(~last & F.col("cut").isNull(), 1)) == 0, F.sum(own)).alias("n_tokens"))


def long_counts(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """key, n_tokens for `texts` (key, text) with unique keys, over as many rounds as alignment takes."""
    done, pending = None, texts
    while True:
        found = stored(splice(pending, path, chunk, overlap), "token-splice")
        good = found.where(F.col("n_tokens").isNotNull())
        done = good if done is None else done.unionByName(good)
        failed = found.where(F.col("n_tokens").isNull()).select("key")
        if failed.isEmpty():
            return done
        pending = pending.join(failed, "key", "left_semi")
        chunk, overlap = chunk * 8, overlap * 16


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit): one row per row of `docs`.

    The tokenizer must be a `tokenizers` file whose pre-tokenizer drops white space. Special strings inside texts are
    read as the library does by default; no special tokens are added. NULL and empty texts have 0 tokens; rows with a
    NULL or repeated id stay, each with the count of its own text; an empty table gives an empty result; other columns
    of `docs` are ignored, whatever their names."""
    text = text_of(text_col)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    short = docs.where(F.length("text") <= chunk).mapInArrow(_short(tokenizer_path), "doc_id long, n_bytes long, n_tokens long")
    long = docs.where(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    counted = long_counts(long.groupBy("key").agg(F.first("text").alias("text")), tokenizer_path, chunk, overlap)
    long = long.drop("text").join(counted, "key").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(long).withColumn("over_limit", F.col("n_tokens") > limit)
