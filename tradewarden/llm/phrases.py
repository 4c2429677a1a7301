"""Collocations: frequent phrases of two and three words with an association score, per language.

Counting is a multikey three-way quicksort of suffix pointers, word by word to the depth of three. Each position of a text is a
pointer to the phrase that begins there. Pointers are first added up within a slice of text, then routed globally to
shards by their leading words: by the first; where that is hot by the first two; where both are hot by all three. A word is
hot beyond a number of occurrences that leaves a bounded list, so the pointers of one route are bounded too, whatever a word's or
a phrase's share of the corpus. A shard sorts its pointers: all partitions of a round are split at once around a pivot word
into less, equal and greater, equal partitions go one word deeper, their sizes are the counts, and a partition of fewer than the least
frequency is abandoned with all phrases in it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.llm.common import stored, text_of
from tradewarden.operators.joins import keyed_join

LEAST, WORDS, TOP = 10, 3, 2_000
#: At most so many words are hot; a word below HOT_COUNT occurrences never is.
HOT_WORDS, HOT_COUNT = 500_000, 1_000_000
#: Pointers of a shard, on average, and bytes of text that are counted at a time.
SHARD_POINTERS, SLICE = 500_000, 2 << 20
#: Shards that a slice is dealt to at once; more shards are dealt in a second step.
FAN_OUT = 10_000
#: Counts that are sent to every task, and parts of a language that are ranked before the language is.
BROADCAST_ROWS, RANK_PARTS = 100_000, 64
NO_LANG = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"]] = _BREAK[0x0A:0x0E] = True
_LETTER = ~_BREAK
_LETTER[[0x20, 0x09]] = False

_POINTERS = pa.schema([("partial", pa.bool_()), ("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()),
                       ("n", pa.int64())])


class Slice:
    """Words of a stretch of lower-cased text: `word` indexes `known`, `piece` and `row` tell where a word stands."""

    def __init__(self, raw: np.ndarray, begins: np.ndarray, rows: np.ndarray, start: int):
        letter = _LETTER[raw]
        edge = np.diff(letter.astype(np.int8), prepend=0)
        at, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        offsets = np.append(0, np.cumsum(end - at)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(raw[letter])).dictionary_encode()
        self.known, self.word = words.dictionary, words.indices.to_numpy().astype(np.int64)
        self.piece = np.cumsum(_BREAK[raw], dtype=np.int32)[at]
        self.row = rows[np.searchsorted(begins, at + start, side="right") - 1]


def slices(texts: Iterator[tuple[int, str]]) -> Iterator[Slice]:
    """The words of numbered texts, a bounded stretch at a time; long texts are cut at the end of a piece."""
    waiting, rows, size = [], [], 0
    for row, text in texts:
        waiting.append(text.encode() + b"\n")
        rows.append(row)
        size += len(waiting[-1])
        if size >= SLICE:
            yield from _stretches(waiting, rows)
            waiting, rows, size = [], [], 0
    if waiting:
        yield from _stretches(waiting, rows)


def _stretches(encoded: list[bytes], rows: list[int]) -> Iterator[Slice]:
    begins = np.cumsum([0, *map(len, encoded)])[:-1]
    whole = b"".join(encoded)
    lo = 0
    while lo < len(whole):
        raw = _LOWER[np.frombuffer(whole, np.uint8, min(2 * SLICE, len(whole) - lo), lo)]
        while not _BREAK[raw[-1]]:
            further = np.frombuffer(whole, np.uint8, min(SLICE, len(whole) - lo - len(raw)), lo + len(raw))
            end = np.flatnonzero(_BREAK[further])
            raw = np.append(raw, _LOWER[further[:end[0] + 1 if len(end) else len(further)]])
        yield Slice(raw, begins, np.array(rows), lo)
        lo += len(raw)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Slice, list[str], np.ndarray]]:
    """Slices with the languages of the batch and the language's number for each word."""
    for batch in batches:
        if len(batch):
            coded = batch.column("lang").dictionary_encode()
            for part in slices((i, x.as_py()) for i, x in enumerate(batch.column("text"))):
                if len(part.word):
                    yield part, coded.dictionary.to_pylist(), coded.indices.to_numpy()[part.row].astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, langs, lang in _batches(batches):
        size = len(part.known)
        key, n = np.unique(lang * size + part.word, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()).take(pa.array(key // size)), part.known.take(pa.array(key % size)),
                                          pa.array(n, pa.int64())], names=["lang", "word", "n"])


def _combined(keys: list[np.ndarray], sizes: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct tuples of the keys, sorted, and how often each occurs."""
    found = np.zeros(len(keys[0]), np.int64)
    for key, size in zip(keys, sizes, strict=True):
        _, first, found = np.unique(found * size + key, return_index=True, return_inverse=True)
    return [k[first] for k in keys], np.bincount(found)


def _payloads(rows: pa.Table, shard: np.ndarray) -> pa.RecordBatch:
    """The pointers of each shard packed into one value."""
    order = np.argsort(shard, kind="stable")
    rows, shard = rows.take(pa.array(order)).combine_chunks(), shard[order]
    cuts = np.append(0, np.flatnonzero(np.diff(shard)) + 1) if len(shard) else np.empty(0, np.int64)
    press = zstandard.ZstdCompressor(level=3)
    packed = [press.compress(pa.record_batch([c.combine_chunks() for c in rows.slice(lo, hi - lo).columns], schema=_POINTERS).serialize())
              for lo, hi in zip(cuts, np.append(cuts[1:], len(shard)))]
    return pa.RecordBatch.from_arrays([pa.array(shard[cuts], pa.int64()), pa.array(packed, pa.binary())], names=["shard", "pointers"])


def _unpacked(packed: bytes) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(zstandard.decompress(packed)), _POINTERS)


def _routed(rows: pa.Table, hot: set[tuple[str, str]], shards: int) -> np.ndarray:
    """The shard of each pointer, by the leading words that its route needs."""
    if not rows.num_rows:
        return np.empty(0, np.int64)
    langs = rows.column("lang").combine_chunks().dictionary_encode()
    lang_names = langs.dictionary.to_pylist()
    lang = langs.indices.to_numpy()
    mark = np.array([zlib.crc32(x.encode()) for x in lang_names], np.uint64)[lang]
    more = np.ones(rows.num_rows, dtype=bool)
    for c in ("w1", "w2", "w3"):
        words = rows.column(c).combine_chunks().dictionary_encode()
        names, word = words.dictionary.to_pylist(), words.indices.to_numpy()
        code = np.array([zlib.crc32(x.encode()) for x in names], np.uint64)[word]
        mark = np.where(more, (mark ^ code) * np.uint64(0x9E3779B97F4A7C15) ^ (mark >> np.uint64(29)), mark)
        if c == "w1":
            more = np.array([[(x, w) in hot for w in names] for x in lang_names])[lang, word]
        elif c == "w2":  # only of the pairs of two hot words are the triples routed further
            more &= rows.column("partial").combine_chunks().to_numpy(zero_copy_only=False)
    return ((mark >> np.uint64(11)) % np.uint64(shards)).astype(np.int64)


def _deal(hot, shards: int, coarse: int):
    """Pointers of all positions with a word behind them, added up within a slice, to their shards.

    Where the first two words are hot, the pair is a pointer of its own and the triple a partial one, which counts as a triple only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_hot = hot.value
        for part, langs, lang in _batches(batches):
            n, size = len(part.word), len(part.known)
            same = np.append(part.piece[1:] == part.piece[:-1], False)
            at = np.flatnonzero(same)
            if not len(at):
                continue
            third = np.where(np.append(same[1:], False)[at], part.word[np.minimum(at + 2, n - 1)], size)
            (first, *ids), times = _combined([lang[at] * size + part.word[at], part.word[at + 1], third], [len(langs) * size, size, size + 1])
            lang_of, ids = first // size, [first % size, *ids]
            words = pa.concat_arrays([part.known, pa.array([""], pa.string())])
            rows = pa.table([pa.array(np.zeros(len(times), bool)), pa.array(langs, pa.string()).take(pa.array(lang_of)),
                             *[words.take(pa.array(i)) for i in ids], pa.array(times, pa.int64())], schema=_POINTERS)
            if known_hot:
                names = part.known.to_pylist()
                is_hot = np.array([[(x, w) in known_hot for w in names] for x in langs])
                both = is_hot[lang_of, ids[0]] & is_hot[lang_of, ids[1]]
                if both.any():
                    triples = rows.filter(pa.array(both & (ids[2] < size)))
                    triples = triples.set_column(0, "partial", pa.array(np.ones(len(triples), bool)))
                    sums = rows.filter(pa.array(both)).group_by(["lang", "w1", "w2"]).aggregate([("n", "sum")])
                    pairs = pa.table([pa.array(np.zeros(len(sums), bool)), sums["lang"], sums["w1"], sums["w2"], pa.array([""] * len(sums), pa.string()),
                                      sums["n_sum"]], schema=_POINTERS)
                    rows = pa.concat_tables([rows.filter(pa.array(~both)), triples, pairs]).combine_chunks()
            yield _payloads(rows, _routed(rows, known_hot, shards) // coarse)
    return run


def _deal_again(hot, shards: int):
    """Pointers of coarse shards to their shards, some payloads at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([_unpacked(x) for x in batch.column("pointers").to_pylist()], _POINTERS)
            yield _payloads(rows, _routed(rows, hot.value, shards))
    return run


def frequent(keys: np.ndarray, weight: np.ndarray, least: int, seed: int = 1) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort: (depth, a pointer, count) of all prefixes of the key columns, from 0 on, that occur at
    least `least` times. `keys` has a row per depth and a column per pointer.

    Each round splits every open partition around the key of one of its pointers, chosen at random."""
    rng, last = np.random.default_rng(seed), len(keys) - 1
    pointer = np.arange(keys.shape[1])
    size, depth = np.array([len(pointer)]), np.zeros(1, np.int64)
    found = []
    if weight.sum() < least:
        return found
    while len(size):
        start = np.cumsum(size) - size
        pivot = pointer[start + rng.integers(size)]
        part = np.repeat(np.arange(len(size)), size)
        side = np.sign(keys[depth[part], pointer] - keys[depth, pivot][part]).astype(np.int64) + 1
        cell = 3 * part + side
        count = np.bincount(cell, minlength=3 * len(size))
        total = np.bincount(cell, weights=weight[pointer], minlength=3 * len(size)).astype(np.int64)
        place = np.cumsum(count) - count
        moved = np.empty_like(pointer)
        for s in range(3):
            mine, n = np.flatnonzero(side == s), count[s::3]
            moved[np.repeat(place[s::3] - (np.cumsum(n) - n), n) + np.arange(len(mine))] = pointer[mine]
        equal = np.arange(len(size)) * 3 + 1
        enough = total >= least
        for d in range(last + 1):
            hit = equal[(depth == d) & enough[equal]]
            if len(hit):
                found.append((d, moved[place[hit]], total[hit]))
        deeper = np.repeat(depth, 3)
        deeper[equal] += 1
        keep = enough & (deeper <= last)
        pointer = moved[np.repeat(keep, count)]
        size, depth = count[keep], deeper[keep]
    return found


def _sorted_shard(rows: pa.Table, least: int) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    coded = [rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy() for c in ("lang", "w1", "w2", "w3")]
    partial = rows.column("partial").combine_chunks().to_numpy(zero_copy_only=False)
    keys = np.stack([2 * coded[0] + partial, *coded[1:]]).astype(np.int32)
    third = pc.not_equal(rows.column("w3"), "").to_numpy()
    out = []
    for depth, pointer, n in frequent(keys, rows.column("n").to_numpy(), least):
        ok = ~partial[pointer] if depth == 2 else third[pointer] if depth == 3 else np.zeros(len(pointer), bool)
        if ok.any():
            at = pa.array(pointer[ok])
            w3 = rows.column("w3").take(at) if depth == 3 else pa.nulls(int(ok.sum()), pa.string())
            out.append(pa.table([rows.column(c).take(at) for c in ("lang", "w1", "w2")] + [w3, pa.array(n[ok])], names=["lang", "w1", "w2", "w3", "a"]))
    schema = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("a", pa.int64())])
    return pa.concat_tables(out).combine_chunks() if out else schema.empty_table()


def _sort_shards(least: int):
    """Frequent phrases from payloads that are sorted by shard, a shard at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, rows = None, []
        for batch in batches:
            for s, packed in zip(batch.column("shard").to_pylist(), batch.column("pointers").to_pylist(), strict=True):
                if s != shard and rows:
                    yield from _sorted_shard(pa.Table.from_batches(rows), least).to_batches()
                    rows = []
                shard = s
                rows.append(_unpacked(packed))
        if rows:
            yield from _sorted_shard(pa.Table.from_batches(rows), least).to_batches()
    return run


def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, word, n) over all texts."""
    return _texts(docs, lang_col, text_col).mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n"))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    return docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"), text_of(text_col).alias("text"))


def frequent_phrases(docs: DataFrame, words: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(lang, w1, w2, w3, a): the phrases of two words (w3 NULL) and three with their number of occurrences, at least `least`;
    `words` is what word_counts returns."""
    spark = docs.sparkSession
    everything = words.agg(F.coalesce(F.sum("n"), F.lit(0))).collect()[0][0]
    bound = max(HOT_COUNT, everything // HOT_WORDS)
    # No more than HOT_WORDS words can lie beyond the bound.
    hot = spark.sparkContext.broadcast({(r.lang, r.word) for r in words.where(F.col("n") > bound).toLocalIterator()})
    shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-everything // SHARD_POINTERS))
    coarse = -(-shards // FAN_OUT)
    packed = "shard long, pointers binary"
    dealt = _texts(docs, lang_col, text_col).mapInArrow(_deal(hot, shards, coarse), packed).repartition(min(shards, FAN_OUT), "shard")
    if coarse > 1:
        dealt = dealt.mapInArrow(_deal_again(hot, shards), packed)
    return dealt.sortWithinPartitions("shard").mapInArrow(_sort_shards(least), "lang string, w1 string, w2 string, w3 string, a long")


def _known(phrases: DataFrame, counts: DataFrame, names: list[str], out: str) -> DataFrame:
    """Add the count of the words in `names`; words of very many phrases are split."""
    return keyed_join(phrases, counts.toDF("lang", *names, out), ["lang", *names], out, "phrase", broadcast_rows=BROADCAST_ROWS)


def _score(whole: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * whole ** 2 / (left * right)) in decimals of 38 digits."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * wide(whole) * wide(whole), wide(left) * wide(right)).cast("long")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP,
                 share: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line breaks, and pieces into words at blanks and tabs. Phrases
    are two or three words of a piece with at least `least` occurrences (a). The score is a million times a * a / (l * r), floored, at the cut
    of the phrase into parts of l and r occurrences where it is lowest; of equal cuts the first. A phrase inside a longer
    one that makes up `share` percent of its occurrences is dropped. n counts all words of the language. Ranks go by score, then
    occurrences, largest first, then the phrase in byte order.

    A NULL language is `und`, a NULL text is empty; repeated rows count each time; other columns are left out, whatever their
    names; an empty table gives an empty table. Texts of any length are counted whole."""
    words = stored(word_counts(docs, lang_col, text_col), "words")
    found = stored(frequent_phrases(docs, words, lang_col, text_col, least).withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3")), "phrases")
    single = stored(words.where(F.col("n") >= least), "frequent-words")
    pairs, triples = found.where(F.col("w3").isNull()).drop("w3"), found.where(F.col("w3").isNotNull())
    two = pairs.select("lang", "w1", "w2", "a")

    inside = triples.select("lang", "a", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"))
    longest = inside.groupBy("lang", "p.w1", "p.w2").agg(F.max("a").alias("longer"))
    free = pairs.join(longest, ["lang", "w1", "w2"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a")))

    scored2 = _known(_known(free, single, ["w1"], "l"), single, ["w2"], "r").select(
        "lang", "phrase", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    cuts = _known(_known(_known(_known(triples, single, ["w1"], "l1"), single, ["w3"], "r2"), two, ["w1", "w2"], "l2"), two, ["w2", "w3"], "r1")
    options = [F.struct(_score(F.col("a"), F.col(f"l{k}"), F.col(f"r{k}")).alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r"))
               for k in (1, 2)]
    scored3 = cuts.select("lang", "phrase", "a", F.least(*options).alias("c")).select("lang", "phrase", "a", "c.l", "c.r", "c.score")
    # A language's best are among the best of its parts, so one task sees no more than RANK_PARTS * top rows of it.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = scored2.unionByName(scored3).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    for keys in (["lang", "part"], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(words.groupBy("lang").agg(F.sum("n").alias("n")), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
