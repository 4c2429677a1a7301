"""SentencePiece encoding and decoding with a relational lattice.

A text is the sequence of its units, each a run of word marks with what follows up to the next one, and a unit that of its
segments: it is cut wherever two characters follow each other that do so in no piece. No piece of the model reaches over a
segment's end, so each distinct segment is encoded once. Its substrings of bounded length are exploded and joined with the table
of pieces, and the edges found are grouped by segment into a lattice. A fold over the lattices of many segments at once, in array steps, takes the best-scored edge that spans exactly one cut, the leftmost among equals, until none is left.
That is the order in which this kind of model merges; the best sum of scores over a lattice, which other models ask for,
would give other pieces. Characters without a piece become bytes.
"""

from __future__ import annotations

import hashlib
import re
import sys
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import chain, islice, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewarden.llm.common import heaviest, parts, stored, text_of

MARK = "▁"
#: Segments of more characters have more cuts than a long has bits and go through the library.
FOLDED = 61
HEAD_UNITS, HEAD_BYTES = 200_000, 64
#: The segments that every task of `encode_whole` has at hand are told by about so many texts.
SAMPLE_ROWS, SAMPLE_UNITS = 30_000, 400_000
MEMO_UNITS = 300_000
TASK_UNITS, TASK_ROWS = 10_000, 1_000
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")


def units(text: str) -> list[str]:
    """The units of a text, each without its first mark."""
    if not text:
        return []
    if text[0] == " " or "  " in text or MARK in text:
        return [u[1:] for u in _UNIT.findall(MARK + text.replace(" ", MARK))]
    return text.split(" ")


def _model(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


@cache
def _links(path: str) -> tuple[np.ndarray, np.ndarray]:
    """A number for each character of the pieces, 0 for all others, and which two numbers follow each other in some piece."""
    model = _model(path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    letters = sorted(set("".join(names)))
    number = np.zeros(sys.maxunicode + 1, dtype=np.int32)
    number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
    linked = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
    for a, b in {name[i:i + 2] for name in names for i in range(len(name) - 1)}:
        linked[number[ord(a)], number[ord(b)]] = True
    return number, linked


def segments(words: list[str], path: str) -> tuple[list[str], np.ndarray]:
    """The segments of units (none empty, with all their marks), one after the other, and how many each has.

    A merge always makes a piece, so two characters that follow each other in no piece are never merged."""
    number, linked = _links(path)
    whole = "".join(words)
    kinds = number[np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)]
    ends = np.cumsum([0, *map(len, words)])
    cut = np.ones(len(whole) + 1, dtype=bool)
    cut[1:-1] = ~linked[kinds[:-1], kinds[1:]]
    cut[ends] = True
    places = np.flatnonzero(cut)
    return [whole[a:b] for a, b in pairwise(places.tolist())], np.diff(np.searchsorted(places, ends))


def piece_table(spark: SparkSession, path: str) -> DataFrame:
    """piece, id, rank (smaller merges first) of the model's ordinary pieces. Its size is the vocabulary's."""
    model = _model(path)
    rows = [(model.id_to_piece(i), i, int(-model.get_score(i))) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return spark.createDataFrame(rows, "piece string, id int, rank long")


def _by_library(path: str):
    """The library's ids of a single segment."""
    model, number = _model(path), _links(path)[0]
    # What stands before a segment in a text is never merged with it; neither is a character that no piece has.
    other = chr(0xE000 + int(np.flatnonzero(number[0xE000:] == 0)[0]))
    before = len(model.encode(other))
    return lambda unit: model.encode(other + unit.replace(MARK, " "))[before:]


def _fold(byte0: int, path: str):
    """The ids of each unit from its lattice, for all units of a batch at once, beside the unit's other columns.

    A unit's state is the set of cuts between its characters, as bits. Each round every unit takes its best-ranked edge that
    spans exactly one cut, the leftmost among equals, and drops that cut; it is done when there is no such edge. A unit too long
    for this has one edge and gets the library's ids."""
    one = np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = None
        for batch in batches:
            words, kept_names = batch.column("unit").to_pylist(), [c for c in batch.schema.names if c != "edges"]
            lists = batch.column("edges")
            flat = lists.flatten()
            start, length, rank = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("start", "length", "rank"))
            ids = flat.field("id").fill_null(-1).to_numpy(zero_copy_only=False)
            unit = np.repeat(np.arange(len(words)), np.diff(lists.offsets.to_numpy()))
            left, right = start.astype(np.uint64), (start + length).astype(np.uint64)
            ends, inner = (one << left) | (one << right), (one << right) - (one << (left + one))
            cuts = (one << (np.minimum(np.fromiter(map(len, words), dtype=np.uint64, count=len(words)), np.uint64(FOLDED)) + one)) - one
            going = np.lexsort((start, rank, unit))
            going = going[length[going] > 1]
            while len(going):
                at = unit[going]
                fits = going[((cuts[at] & ends[going]) == ends[going]) & (np.bitwise_count(cuts[at] & inner[going]) == 1)]
                moved, first = np.unique(unit[fits], return_index=True)
                cuts[moved] &= ~inner[fits[first]]
                alive = np.zeros(len(words), dtype=bool)
                alive[moved] = True
                going = going[alive[at]]
            kept = np.flatnonzero(((cuts[unit] & ends) == ends) & ((cuts[unit] & inner) == 0))
            kept = kept[np.lexsort((start[kept], unit[kept]))]
            spelled = {}
            for k, e in enumerate(kept.tolist()):
                word = words[unit[e]]
                if len(word) > FOLDED:
                    library = library or _by_library(path)
                    spelled[k] = library(word)
                elif ids[e] < 0:
                    spelled[k] = [byte0 + x for x in word[start[e]].encode()]
            many = np.ones(len(kept), dtype=np.int64)
            many[list(spelled)] = [len(x) for x in spelled.values()]
            out = np.repeat(ids[kept], many)
            place = np.cumsum(many) - many
            for k, found in spelled.items():
                out[place[k]:place[k] + len(found)] = found
            offsets = np.append(0, np.cumsum(np.bincount(unit[kept], weights=many, minlength=len(words)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, kept_names), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(out, pa.int32()))],
                names=[*kept_names, "ids"])
    return run


def lattices(distinct: DataFrame, path: str) -> DataFrame:
    """unit, edges of distinct segments (unit). Dealt by unit, they stay where they are: the join with the pieces and the grouping of
    the edges move nothing."""
    model = _model(path)
    pieces = piece_table(distinct.sparkSession, path)
    longest = max(len(model.id_to_piece(i)) for i in range(model.get_piece_size()) if not model.is_byte(i))
    folded = F.length("unit") <= FOLDED
    starts = distinct.withColumn("size", F.when(folded, F.length("unit")).otherwise(1))
    starts = starts.withColumn("start", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    spans = starts.withColumn("length", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.col("size") - F.col("start")))))
    spans = spans.withColumn("piece", F.expr("substring(unit, start + 1, length)"))
    # The piece table is as large as the vocabulary of the model, whatever the corpus.
    edges = spans.join(F.broadcast(pieces), "piece", "left").where("id is not null or length = 1")
    return edges.groupBy("unit").agg(F.collect_list(F.struct("start", "length", "rank", "id")).alias("edges"))


def fold(lattice: DataFrame, path: str) -> DataFrame:
    """The columns of `lattice`, with ids in place of edges."""
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in lattice.schema if f.name != "edges"]
    rows = lattice.select(*[c for c in lattice.columns if c != "edges"], "edges")
    return rows.mapInArrow(_fold(_model(path).piece_to_id("<0x00>"), path), ", ".join([*kept, "ids array<int>"]))


def encode_units(counted: DataFrame, path: str) -> DataFrame:
    """unit, ids for distinct segments (unit)."""
    dealt = counted.select("unit").repartition(parts(counted.sparkSession, counted.count(), TASK_UNITS), "unit")
    return fold(lattices(dealt, path), path)


def _cut(text: str, path: str) -> list[str]:
    words = [MARK + u for u in units(text)]
    return segments(words, path)[0] if words else []


def _count(path: str):
    def rows(found: Counter) -> pa.RecordBatch:
        cut, many = segments([MARK + u for u in found], path) if found else ([], [])
        added: Counter = Counter()
        for unit, n in zip(cut, np.repeat(list(found.values()), many).tolist(), strict=True):
            added[unit] += n
        return pa.RecordBatch.from_arrays([pa.array(added.keys(), pa.string()), pa.array(added.values(), pa.int64())], names=["unit", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for text in (x.as_py() for batch in batches for x in batch.column("text")):
            found.update(units(text))
            if len(found) > MEMO_UNITS:
                yield rows(found)
                found = Counter()
        yield rows(found)
    return run


def count_units(texts: DataFrame, path: str) -> DataFrame:
    """unit, n: all distinct segments of `texts` (text) with their numbers of occurrences."""
    return texts.select("text").mapInArrow(_count(path), "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def dictionary(texts: DataFrame, path: str) -> DataFrame:
    """unit, n, ids of all distinct segments of `texts` (text)."""
    counted = stored(count_units(texts, path), "units")
    return encode_units(counted, path).join(counted, "unit")


def decode(ids: Column, path: str) -> Column:
    """The text of an array of ids: pieces and bytes joined, marks as blanks, without the blank that stands before a text."""
    model = _model(path)
    hexes = [("" if model.is_control(i) else f"{int(model.id_to_piece(i)[3:5], 16):02X}" if model.is_byte(i)
              else model.id_to_piece(i).encode().hex().upper()) for i in range(model.get_piece_size())]
    table = F.split(F.lit(",".join(hexes)), ",")
    joined = F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")
    return F.regexp_replace(F.replace(F.decode(F.unhex(joined), "utf-8"), F.lit(MARK), F.lit(" ")), "^ ", "")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the encoded texts, one row per row of `docs`, as the library encodes them. NULL and empty texts have no
    ids. Rows with NULL or repeated ids stay; an empty table gives an empty result; other columns are ignored."""
    texts = stored(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                               text_of(text_col).alias("text")), "texts")
    known = stored(dictionary(texts, path).select("unit", "ids"), "unit-dictionary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = _cut(text, path)
                yield pa.RecordBatch.from_arrays([pa.array([uid] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()),
                                                  pa.array(found, pa.string())], names=["uid", "at", "unit"])
    placed = texts.select("uid", "text").mapInArrow(run, "uid long, at int, unit string").join(known, "unit")
    joined = placed.groupBy("uid").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "ids"))), lambda x: x["ids"])).alias("ids"))
    return texts.select("uid", "doc_id").join(joined, "uid", "left").select(
        "doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))


_TAIL = pa.list_(pa.struct([("unit", pa.string()), ("k", pa.int32())]))
SCANNED = ("uid long, doc_id long, n_bytes long, n_units long, pieces long, bytes long, ids long, wrong long, "
           "tail array<struct<unit:string,k:int>>")


def _scan(head, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, sums = head.value
        index = {u: i for i, u in enumerate(known)}
        get, none = index.get, len(known)
        sums = np.vstack([sums, np.zeros((1, 4), dtype=np.int64)])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                split = [_cut(t, path) for t in texts]
                flat = np.array([get(u, none) for us in split for u in us], dtype=np.int64)
                ends = np.cumsum([len(us) for us in split])
                total = np.vstack([np.zeros((1, 4), dtype=np.int64), np.cumsum(sums[flat], axis=0)])
                added = total[ends] - total[np.append(0, ends[:-1])]
                tails = []
                for a, b, us in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), split, strict=True):
                    rest = np.flatnonzero(flat[a:b] == none)
                    tails.append([{"unit": u, "k": k} for u, k in Counter(us[i] for i in rest.tolist()).items()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("doc_id"), part.column("n_bytes"), pa.array([len(units(t)) for t in texts], pa.int64()),
                     *(pa.array(added[:, i]) for i in range(4)), pa.array(tails, _TAIL)],
                    names=["uid", "doc_id", "n_bytes", "n_units", "pieces", "bytes", "ids", "wrong", "tail"])
    return run


def summarise(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", head_units: int = HEAD_UNITS) -> DataFrame:
    """doc_id, n_bytes, n_units, n_pieces, n_byte_pieces, id_sum, round_trip: the encoding of each whole text in figures.

    round_trip: every segment's ids decode to the segment again. The most frequent segments go to every task as a table of bounded
    size, all others are joined. NULL and empty texts have no pieces; rows with NULL or repeated ids stay; an empty table
    gives an empty result; other columns are ignored, whatever their names."""
    spark, text = docs.sparkSession, text_of(text_col)
    model = _model(path)
    byte0 = model.piece_to_id("<0x00>")
    plain = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    known = dictionary(plain, path)
    back = F.regexp_replace(F.replace("unit", F.lit(MARK), F.lit(" ")), "^ ", "")
    figures = known.select(
        "unit", "n", F.size("ids").cast("long").alias("pieces"),
        F.size(F.filter("ids", lambda i: i.between(byte0, byte0 + 255))).cast("long").alias("bytes"),
        F.aggregate("ids", F.lit(0).cast("long"), lambda s, i: s + i).alias("ids"),
        (~decode(F.col("ids"), path).eqNullSafe(back)).cast("long").alias("wrong"))
    figures = stored(figures, "unit-figures")
    head = heaviest(figures.where(F.octet_length("unit") <= HEAD_BYTES), "n", head_units)
    head = head.select("unit", "pieces", "bytes", "ids", "wrong").toArrow()
    sums = np.column_stack([head[c].to_numpy() for c in ("pieces", "bytes", "ids", "wrong")]).astype(np.int64)
    shipped = spark.sparkContext.broadcast((head["unit"].to_pylist(), sums))
    scanned = stored(plain.mapInArrow(_scan(shipped, path), SCANNED), "unit-scanned")
    tail = scanned.select("uid", F.explode("tail").alias("t")).select("uid", "t.unit", "t.k").join(figures, "unit")
    cols = ("pieces", "bytes", "ids", "wrong")
    more = tail.groupBy("uid").agg(*[F.sum(F.col("k") * F.col(c)).alias(f"more_{c}") for c in cols])
    whole = scanned.drop("tail").join(more, "uid", "left").withColumns(
        {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in cols})
    return whole.select("doc_id", "n_bytes", "n_units", F.col("pieces").alias("n_pieces"), F.col("bytes").alias("n_byte_pieces"),
                        F.col("ids").alias("id_sum"), (F.col("wrong") == 0).alias("round_trip"))


PLACED = "uid long, doc_id long, n_bytes long, sha256 binary, size long, ids binary, holes array<int>, tail array<string>"


def pack(numbers: np.ndarray, bounds: np.ndarray) -> tuple[list[bytes], list[int]]:
    """Each stretch of the numbers between two bounds in few bytes, and how many bytes that are when they are unpacked: seven bits
    a byte, the smallest first, in a byte of their own if below 128."""
    many = 1 + (numbers >= 1 << 7) + (numbers >= 1 << 14) + (numbers >= 1 << 21)
    ends = np.append(0, np.cumsum(many))
    out = np.empty(ends[-1], dtype=np.uint8)
    for k in range(4):
        at = np.flatnonzero(many > k)
        out[ends[at] + k] = (numbers[at] >> 7 * k) & 127 | (many[at] > k + 1) << 7
    raw, codec = out.tobytes(), pa.Codec("zstd", compression_level=3)
    cuts = ends[bounds]
    return [codec.compress(raw[a:b], asbytes=True) for a, b in pairwise(cuts.tolist())], np.diff(cuts).tolist()


def unpack(packed: list[bytes], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all stretches, one after the other, and their bounds."""
    raw = np.frombuffer(b"".join(pa.decompress(x, n, codec="zstd", asbytes=True) for x, n in zip(packed, sizes, strict=True)), dtype=np.uint8)
    ends = np.append(0, np.flatnonzero(raw < 128) + 1)
    shift = np.arange(len(raw)) - np.repeat(ends[:-1], np.diff(ends))
    bits = (raw & 127).astype(np.int32) << 7 * shift.astype(np.int32)
    return np.add.reduceat(bits, ends[:-1]) if len(raw) else bits, np.searchsorted(ends, np.append(0, np.cumsum(sizes)))


def _place(head, path: str):
    """The ids of each text in order, packed as numbers, 0 where a segment isn't in the table; for each such place the index of
    its segment among the text's distinct ones that aren't.

    A task keeps the ids of the units it has met, and forgets them when they are too many."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ends, values, numbers = head.value
        get = {u: i for i, u in enumerate(known)}.get
        ends, values = [0, *ends.tolist()], array("i", numbers[values].tolist())
        met, open_units, sizes, found = {}, {}, array("q"), array("i")

        def meet(new: list[str]) -> None:
            cut, many = segments([MARK + u for u in new], path)
            rest = iter(cut)
            for u, n in zip(new, many.tolist(), strict=True):
                size, unknown = len(found), []
                for piece in islice(rest, n):
                    if (at := get(piece)) is None:
                        found.append(0)
                        unknown.append(piece)
                    else:
                        found.extend(values[ends[at]:ends[at + 1]])
                if unknown:
                    open_units[len(met)] = unknown
                met[u] = len(met)
                sizes.append(len(found) - size)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                split, coded = [units(t) for t in texts], [t.encode() for t in texts]
                if len(met) > MEMO_UNITS:
                    met, open_units, sizes, found = {}, {}, array("q"), array("i")
                every = list(chain.from_iterable(split))
                if new := list(set(every).difference(met)):
                    meet(new)
                flat = np.fromiter(map(met.__getitem__, every), dtype=np.int64, count=len(every))
                bounds = np.append(0, np.cumsum([len(us) for us in split]))
                size, value = np.array(sizes, dtype=np.int64), np.array(found, dtype=np.int32)
                many = size[flat]
                place = np.append(0, np.cumsum(many))
                ids = value[np.repeat((np.cumsum(size) - size)[flat] - place[:-1], many) + np.arange(place[-1])]
                is_open = np.zeros(len(size), dtype=bool)
                is_open[list(open_units)] = True
                open_at = np.flatnonzero(is_open[flat])
                holes, tails = [], []
                for a, b in pairwise(np.searchsorted(open_at, bounds).tolist()):
                    index: dict[str, int] = {}
                    holes.append([index.setdefault(x, len(index)) for k in flat[open_at[a:b]].tolist() for x in open_units[k]])
                    tails.append(list(index))
                packed, raw_sizes = pack(ids, place[bounds])
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("doc_id"), pa.array([len(t) for t in coded], pa.int64()),
                     pa.array([hashlib.sha256(t).digest() for t in coded], pa.binary()),
                     pa.array(raw_sizes, pa.int64()), pa.array(packed, pa.binary()),
                     pa.array(holes, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.string()))],
                    names=["uid", "doc_id", "n_bytes", "sha256", "size", "ids", "holes", "tail"])
    return run


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        tail = batch.column("tail")
        ends = tail.offsets.to_numpy()
        many = np.diff(ends)
        uid, at = np.repeat(batch.column("uid").to_numpy(), many), np.arange(many.sum()) - np.repeat(ends[:-1] - ends[0], many)
        place = pa.StructArray.from_arrays([pa.array(uid, pa.int64()), pa.array(at, pa.int32())], names=["uid", "at"])
        yield pa.RecordBatch.from_arrays([place, tail.flatten()], names=["place", "unit"])


def _splice(table: list[bytes], ranked: np.ndarray):
    """The ids with the joined ones in their places, and whether they decode to the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                size, packed, order, tail, rest, digest = (
                    part.column(c).to_pylist() for c in ("size", "ids", "holes", "tail", "rest", "sha256"))
                numbers, bounds = unpack(packed, size)
                missing = numbers == 0
                counts = np.diff(np.append(0, np.cumsum(missing))[bounds]).tolist()
                if counts != [len(x) for x in order] or any(len(r or []) != len(t) for r, t in zip(rest, tail, strict=True)):
                    raise ValueError("a segment of a text has no ids")
                found = [r[k] for ks, r in zip(order, rest, strict=True) for k in ks]
                many = np.ones(len(numbers), dtype=np.int64)
                many[missing] = [len(x) for x in found]
                whole = np.repeat(ranked[numbers - 1], many)
                whole[np.repeat(missing, many)] = list(chain.from_iterable(found))
                offsets = np.append(0, np.cumsum(many))[bounds]
                names, same = list(map(table.__getitem__, whole.tolist())), []
                for a, b, x in zip(offsets[:-1].tolist(), offsets[1:].tolist(), digest, strict=True):
                    text = b"".join(names[a:b]).replace(MARK.encode(), b" ").removeprefix(b" ")
                    same.append(hashlib.sha256(text).digest() == x)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.ListArray.from_arrays(
                        pa.array(offsets, pa.int32()), pa.array(whole, pa.int32())), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_bytes", "ids", "round_trip"])
    return run


def encode_whole(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", head_units: int = SAMPLE_UNITS) -> DataFrame:
    """doc_id, n_bytes, ids, round_trip: the encoding of each whole text, one row per row of `docs`, as the library encodes it.

    round_trip: the ids, decoded together, give the text again, byte for byte; a word mark in a text comes back as a blank.
    Segments that are frequent in a sample of the texts go to every task as a table of bounded size; all others, whatever their
    number, are looked up by a join and put in their places, so the sample has no part in the result. NULL and empty texts have no ids; rows with NULL or repeated ids stay; an empty table gives an empty result; other columns are
    ignored, whatever their names."""
    spark, model = docs.sparkSession, _model(path)
    plain = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        text_of(text_col).alias("text"))
    n_rows = docs.count()
    some = stored(count_units(plain.sample(min(1.0, SAMPLE_ROWS / max(1, n_rows)), 1), path), "units")
    head = heaviest(some.where(F.octet_length("unit") <= HEAD_BYTES), "n", head_units)
    head = encode_units(head, path).join(some, "unit").select("unit", "ids", "n").toArrow().combine_chunks()
    many = np.array([len(x) for x in head["ids"].to_pylist()], dtype=np.int64)
    values = np.array([i for x in head["ids"].to_pylist() for i in x], dtype=np.int64)
    # Ids that are frequent in the sample get small numbers, which take less room.
    used = np.bincount(values, weights=np.repeat(head["n"].to_numpy(), many), minlength=model.get_piece_size())
    ranked = np.argsort(-used, kind="stable").astype(np.int32)
    shipped = spark.sparkContext.broadcast((head["unit"].to_pylist(), np.cumsum(many), values, np.argsort(ranked) + 1))
    # The ids move once, packed, to where the missing ones come to them. Both branches below read this one exchange, so both
    # take all of its columns; so do the two that read `missing`.
    placed = plain.mapInArrow(_place(shipped, path), PLACED).repartition("uid")
    missing = placed.mapInArrow(_tails, "place struct<uid:long,at:int>, unit string").repartition(parts(spark, n_rows, TASK_ROWS), "unit")
    lattice = lattices(missing.groupBy("unit").agg(F.count("place").alias("n")).where("n > 0").select("unit"), path)
    places = missing.groupBy("unit").agg(F.collect_list("place").alias("places"))
    known = fold(lattice.join(places.hint("shuffle_hash"), "unit"), path)
    rest = known.select(F.explode("places").alias("p"), F.col("ids").alias("found")).select(F.col("p.uid").alias("of"), "p.at", "found")
    rest = rest.repartition("of").groupBy("of").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "found"))), lambda x: x["found"]).alias("rest"))
    table = [b"" if model.is_control(i) else bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i)
             else model.id_to_piece(i).encode() for i in range(model.get_piece_size())]
    return placed.join(rest, F.col("uid") == F.col("of"), "left").mapInArrow(
        _splice(table, ranked), "doc_id long, n_bytes long, ids array<int>, round_trip boolean")
