"""Removal of every byte covered by a 200-byte string that also starts elsewhere in the corpus.

Finding what could repeat: each 200-byte window of a text is named by the smallest hash among the 32-byte strings in it,
so equal windows have equal names wherever they stand. Neighbouring windows mostly take the name from the same place; such a
run and the text under it is the unit of work. A name that occurs once repeats nothing, and where all runs of a name hold the same text all
of it repeats. What remains, names with several different texts, is dealt by name to shards of bounded size; each shard
gets a suffix array by induced sorting and permuted common prefixes, which show the windows that occur in two texts. Where a
name has more different texts than a shard should hold, the windows of those texts are named again by the smallest hash of
longer strings, whose length goes half of the way to the window's each time, until every name fits into a shard: at the length of the
window all texts of a name are the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewarden.llm import suffix_sort
from tradewarden.llm.common import parts, stored, text_of
from tradewarden.llm.minhash import _BYTE, _STEP, _UNSTEP, _mix, _powers

SPAN = 200
GRAM = 32
SHARD_TEXTS = 8_192
#: Different texts of one name, beyond which their windows are named again.
HOT_TEXTS = 8_192
#: Bytes that are hashed at a time.
STRETCH = 1 << 19


def _windows(raw: np.ndarray, span: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """The name of the window that starts at each byte: the smallest hash of a string of `gram` bytes in it; and whether the
    string with that hash stands at the window's start."""
    h, w, p = _BYTE[raw], 1, _STEP
    while 2 * w <= gram:
        h[:-w] = h[:-w] * np.uint64(p) + h[w:]
        w, p = 2 * w, p * p % 2 ** 64
    if w < gram:  # two overlapping halves
        h[:w - gram] = _mix(h[:w - gram]) * np.uint64(_STEP) + h[gram - w:]
    own, width = _mix(h), span - gram + 1
    least = own.copy()
    w = 1
    while 2 * w <= width:
        least[:-w] = np.minimum(least[:-w], least[w:])
        w *= 2
    if width > w:
        least[:w - width] = np.minimum(least[:w - width], least[width - w:])
    return least, own == least


def _hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of raw[start:end] for each pair."""
    sums = np.append(np.uint64(0), np.cumsum(_BYTE[raw] * _powers(_STEP, len(raw)), dtype=np.uint64))
    return _mix((sums[ends] - sums[starts]) * _powers(_UNSTEP, len(raw) + 1)[starts] + (ends - starts).astype(np.uint64))


def runs(texts: list[bytes], span: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """text index, start, windows, name, hash of the text under it, for each run of windows with one name from one place."""
    sizes = np.array([len(x) for x in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if not len(raw):
        return tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    name, at_start = _windows(raw, span, gram)
    room = np.repeat(ends, sizes) - np.arange(len(raw))
    inside = room >= span
    # A run ends where the name changes or comes from the next place with that hash, so that two equal windows, in a text
    # that repeats itself, are always in two runs.
    new = inside & np.concatenate([[True], (name[1:] != name[:-1]) | at_start[:-1] | ~inside[:-1]])
    starts = np.flatnonzero(new)
    held = np.flatnonzero(inside)
    windows = np.bincount(np.searchsorted(starts, held, side="right") - 1, minlength=len(starts)) if len(starts) else starts
    of = np.searchsorted(ends, starts, side="right")
    return of, starts - (ends - sizes)[of], windows, name[starts], _hashes(raw, starts, starts + windows + span - 1)


def _text_runs(texts: list[bytes], span: int) -> list[tuple[np.ndarray, ...]]:
    """Runs of each text; texts are hashed together up to STRETCH bytes, longer ones in overlapping stretches."""
    out: list[tuple[np.ndarray, ...]] = []
    group: list[bytes] = []

    def flush() -> None:
        if group:
            of, *cols = runs(group, span)
            cuts = np.searchsorted(of, np.arange(1, len(group)))
            out.extend(zip(*[np.split(c, cuts) for c in cols], strict=True))
            group.clear()
    for text in texts:
        if len(text) <= STRETCH:
            if sum(map(len, group)) + len(text) > STRETCH:
                flush()
            group.append(text)
        else:
            flush()
            found = []
            for at in range(0, len(text) - span + 1, STRETCH):
                _, start, *cols = runs([text[at:at + STRETCH + span - 1]], span)
                found.append((start + at, *cols))
            out.append(tuple(map(np.concatenate, zip(*found, strict=True))))
    flush()
    return out


SCANNED = ("uid long, doc_id long, n_bytes long, sha string, body binary, "
           "runs array<struct<start:int,windows:int,name:long,same:long,k:int>>, own array<struct<start:long,end:long>>")
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merged(start: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """The maximal stretches that the intervals cover."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.append(True, start[1:] > reach[:-1])
    return list(zip(start[new].tolist(), reach[np.append(new[1:], True)].tolist(), strict=True))


def _distinct(found: tuple[np.ndarray, ...], span: int) -> tuple[tuple[np.ndarray, ...], list[tuple[int, int]]]:
    """One run of each kind with its number in the text, and the stretches under runs that the text itself repeats. A text
    that says the same over and over has few kinds of runs, however long it is."""
    start, windows, name, same = found
    if len(np.unique(name)) == len(name):
        return (*found, np.ones(len(name), dtype=np.int64)), []
    order = np.lexsort((start, same, name))
    new = np.append(True, (name[order][1:] != name[order][:-1]) | (same[order][1:] != same[order][:-1]))
    kind = np.cumsum(new) - 1
    k = np.bincount(kind)
    again = order[k[kind] > 1]
    spans = _merged(start[again], start[again] + windows[again] + span - 1) if len(again) else []
    first = order[new]
    return (start[first], windows[first], name[first], same[first], k.astype(np.int64)), spans


def _scan(span: int):
    kinds = [("start", pa.int32()), ("windows", pa.int32()), ("name", pa.int64()), ("same", pa.int64()), ("k", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [x.encode() for x in part.column("text").to_pylist()]
                found, own = zip(*[_distinct(x, span) for x in _text_runs(texts, span)], strict=True)
                offsets = np.cumsum([0, *(len(x[0]) for x in found)])
                flat = [np.concatenate(c) for c in zip(*found, strict=True)]
                flat = [c.view(np.int64).astype(t.to_pandas_dtype()) for c, (_, t) in zip(flat, kinds, strict=True)]
                listed = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(c, t) for c, (_, t) in zip(flat, kinds, strict=True)], names=[n for n, _ in kinds]))
                carried = [n for n in part.schema.names if n == "carried"]
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                     pa.array([hashlib.sha256(x).hexdigest() for x in texts]), pa.array(map(pack, texts), pa.binary()), listed,
                     pa.array([[{"start": a, "end": b} for a, b in x] for x in own], _SPANS), *(part.column(n) for n in carried)],
                    names=["uid", "doc_id", "n_bytes", "sha", "body", "runs", "own", *carried])
    return run


def _slices(span: int):
    """Texts under runs (name, same, n and the text) from whole documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for body, wanted in zip(batch.column("body"), batch.column("wanted"), strict=True):
                text, wanted = unpack(body.as_py()), wanted.values
                start, windows = wanted.field("start").to_numpy(), wanted.field("windows").to_numpy()
                cut = [text[a:a + w + span - 1] for a, w in zip(start.tolist(), windows.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([wanted.field("name"), wanted.field("same"), wanted.field("n"), wanted.field("hot"),
                                                  pa.array(cut, pa.binary())], names=["name", "same", "n", "hot", "cut"])
    return run


FOUND = "name long, same long, first int, last int"


def _shard(span: int):
    """Per text of a shard with repeated windows: the first and the last of them. A text that occurs more than once
    repeats as a whole."""
    def run(rows: pa.Table) -> pa.Table:
        texts, n = rows["cut"].to_pylist(), rows["n"].to_numpy()
        first = np.full(len(texts), np.iinfo(np.int32).max, dtype=np.int32)
        last = np.full(len(texts), -1, dtype=np.int32)
        which, low, high = suffix_sort.repeated(texts, span)
        first[which], last[which] = low, high
        often = np.flatnonzero(n > 1)
        first[often], last[often] = 0, [len(texts[i]) - span for i in often]
        hit = last >= 0
        return pa.table([rows["name"].filter(pa.array(hit)), rows["same"].filter(pa.array(hit)), pa.array(first[hit]), pa.array(last[hit])],
                        names=["name", "same", "first", "last"])
    return run


def _named_again(span: int, gram: int):
    """Runs of the texts of hot names, by the smallest hash of `gram` bytes, with the text under each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                cuts = part.column("cut").to_pylist()
                of, start, windows, name, same = runs(cuts, span, gram)
                rows = pa.array(of)
                text = [cuts[i][a:a + w + span - 1] for i, a, w in zip(of.tolist(), start.tolist(), windows.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("name").take(rows), part.column("same").take(rows), part.column("n").take(rows), pa.array(start, pa.int32()),
                     pa.array(windows, pa.int32()), pa.array(name.view(np.int64)), pa.array(same.view(np.int64)), pa.array(text, pa.binary())],
                    names=["name", "same", "n", "at", "windows", "name2", "same2", "cut"])
    return run


def _in_shards(texts: DataFrame, span: int, shard_texts: int) -> DataFrame:
    """FOUND for texts (name, same, n, cut) whose names all fit into a shard."""
    shards = parts(texts.sparkSession, texts.count(), shard_texts)
    return (texts.select("name", "same", "n", "cut", F.pmod(F.xxhash64("name"), F.lit(shards)).alias("shard")).groupBy("shard")
            .applyInArrow(_shard(span), FOUND))


def _of_hot_names(hot: DataFrame, span: int, gram: int, shard_texts: int, hot_texts: int) -> DataFrame:
    """(name, same, first, last) for texts (name, same, n, cut): repeated windows from the first to the last of each run under finer
    names. Equal windows have equal names at every length, so nothing is missed."""
    finer = stored(hot.mapInArrow(_named_again(span, gram), "name long, same long, n long, at int, windows int, name2 long, same2 long, cut binary"),
                   "finer-runs")
    texts = finer.groupBy("name2", "same2").agg(F.sum("n").alias("n"), F.first("windows").alias("windows"), F.first("cut").alias("cut")).select(
        F.col("name2").alias("name"), F.col("same2").alias("same"), "n", "windows", "cut")
    texts = stored(texts, "finer-texts")
    kinds = texts.groupBy("name").agg(F.count("*").alias("kinds"), F.sum("n").alias("k"))
    texts = stored(texts.join(kinds.where("k > 1"), "name"), "finer-kinds")
    whole = texts.where("kinds = 1").select("name", "same", F.lit(0).alias("first"), (F.col("windows") - 1).alias("last"))
    fits = F.lit(gram >= span) | (F.col("kinds") <= hot_texts)
    found = whole.unionByName(_in_shards(texts.where((F.col("kinds") > 1) & fits), span, shard_texts))
    still = texts.where((F.col("kinds") > 1) & ~fits)
    if not still.isEmpty():
        found = found.unionByName(_of_hot_names(still, span, _longer(gram, span), shard_texts, hot_texts))
    found = found.withColumnsRenamed({"name": "name2", "same": "same2"})
    return finer.join(found, ["name2", "same2"]).select("name", "same", (F.col("at") + F.col("first")).alias("first"),
                                                        (F.col("at") + F.col("last")).alias("last"))


def _longer(gram: int, span: int) -> int:
    return gram + (span - gram + 1) // 2


def covered(scanned: DataFrame, span: int, shard_texts: int = SHARD_TEXTS, hot_texts: int = HOT_TEXTS) -> DataFrame:
    """uid, start, end: stretches of documents whose windows repeat, possibly overlapping."""
    spark = scanned.sparkSession
    flat = scanned.select("uid", F.explode("runs").alias("r")).select("uid", "r.*")
    # Stored before they are joined, so that both sides of a join are shuffled and a hot name can be split.
    shared = stored(flat.groupBy("name").agg(F.sum("k").alias("k")).where("k > 1").select("name"), "shared-names")
    flat = stored(flat.join(shared, "name"), "shared-runs")
    # Different texts of a name, with one place where each stands.
    texts = stored(flat.groupBy("name", "same").agg(F.sum("k").alias("n"), F.min("uid").alias("uid")), "run-texts")
    kinds = stored(texts.groupBy("name").agg(F.count("*").alias("kinds")), "name-kinds")
    whole = kinds.where("kinds = 1").select("name")
    all_of = flat.join(whole, "name").select("uid", "start", (F.col("start") + F.col("windows") + span - 1).alias("end"))

    mixed = texts.join(kinds.where("kinds > 1"), "name").withColumn("hot", F.col("kinds") > hot_texts)
    places = (flat.join(mixed.select("name", "same", "uid", "n", "hot"), ["name", "same", "uid"])
              .groupBy("name", "same", "uid").agg(F.min("start").alias("start"), F.first("windows").alias("windows"),
                                                  F.first("n").alias("n"), F.first("hot").alias("hot")))
    wanted = places.groupBy("uid").agg(F.collect_list(F.struct("start", "windows", "name", "same", "n", "hot")).alias("wanted"))
    cut = stored(scanned.select("uid", "body").join(wanted, "uid").select("body", "wanted").mapInArrow(
        _slices(span), "name long, same long, n long, hot boolean, cut binary"), "cuts")
    found, hot = _in_shards(cut.where("not hot"), span, shard_texts), cut.where("hot")
    if not hot.isEmpty():
        found = found.unionByName(_of_hot_names(hot, span, _longer(GRAM, span), shard_texts, hot_texts))
    part_of = flat.join(found, ["name", "same"]).select(
        "uid", (F.col("start") + F.col("first")).alias("start"), (F.col("start") + F.col("last") + span).alias("end"))
    own = scanned.select("uid", F.explode("own").alias("o")).select("uid", F.col("o.start").alias("start"), F.col("o.end").alias("end"))
    return all_of.unionByName(part_of).unionByName(own)


def _apply(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out: dict[str, list] = {"n_removed": [], "spans": [], "kept_sha256": []} | ({"text": []} if with_text else {})
            for body, sha, gone in zip(batch.column("body"), batch.column("sha"), batch.column("gone"), strict=True):
                if gone.values is None or not len(gone.values):
                    out["n_removed"].append(0)
                    out["spans"].append([])
                    out["kept_sha256"].append(sha.as_py())
                    if with_text:
                        out["text"].append(unpack(body.as_py()).decode())
                    continue
                start, end = gone.values.field("start").to_numpy(), gone.values.field("end").to_numpy()
                spans = _merged(start, end)
                text, kept, at = unpack(body.as_py()), [], 0
                for a, b in spans:
                    kept.append(text[at:a])
                    at = b
                left = b"".join([*kept, text[at:]])
                out["n_removed"].append(len(text) - len(left))
                out["spans"].append([{"start": a, "end": b} for a, b in spans])
                out["kept_sha256"].append(hashlib.sha256(left).hexdigest())
                if with_text:
                    # A character that lost some of its bytes goes as a whole.
                    out["text"].append(b"".join([*kept, text[at:]]).decode(errors="ignore"))
            arrays = {"n_removed": pa.array(out["n_removed"], pa.int64()),
                      "spans": pa.array(out["spans"], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                      "kept_sha256": pa.array(out["kept_sha256"], pa.string())}
            arrays |= {"text": pa.array(out["text"], pa.string())} if with_text else {}
            arrays |= {n: batch.column(n) for n in batch.schema.names if n == "carried"}
            yield pa.RecordBatch.from_arrays([batch.column("uid"), batch.column("doc_id"), batch.column("n_bytes"), *arrays.values()],
                                             names=["uid", "doc_id", "n_bytes", *arrays])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                   uid_col: str | None = None, with_text: bool = False, carry: Column | None = None, shard_texts: int = SHARD_TEXTS,
                   hot_texts: int = HOT_TEXTS) -> DataFrame:
    """uid, doc_id, n_bytes, n_removed, spans (maximal removed runs), kept_sha256 and, if wanted, text and a column `carried`
    with what `carry` is for the row: one row per row.

    All copies of a repeated string go, the first one too; matches never cross documents, and overlapping strings and
    those in the same document count. A NULL text is empty, and texts under `span` bytes stay. Rows that repeat an id, or
    have none, are documents of their own. An empty table gives an empty result; other columns are ignored, whatever their
    names. uid tells rows apart: column `uid_col` if given, else a number made here."""
    uid = F.col(f"`{uid_col}`").cast("long") if uid_col else F.monotonically_increasing_id()
    carried = [] if carry is None else [carry.alias("carried")]
    plain = docs.select(uid.alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"), *carried)
    extra = plain.schema.fields[3:]
    scanned = stored(plain.mapInArrow(_scan(span), T.StructType([*T.StructType.fromDDL(SCANNED).fields, *extra])), "scanned")
    gone = (covered(scanned, span, shard_texts, hot_texts)
            .groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("gone")))
    ddl = "uid long, doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    schema = T.StructType([*T.StructType.fromDDL(ddl + (", text string" if with_text else "")).fields, *extra])
    return (scanned.drop("runs", "own").join(gone, "uid", "left").select("uid", "doc_id", "n_bytes", "sha", "body", "gone", *[f.name for f in extra])
            .mapInArrow(_apply(with_text), schema))
