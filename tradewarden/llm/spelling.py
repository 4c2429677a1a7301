"""Spelling variants: words one insertion, deletion or replacement apart, found by asymmetric q-chunks.

The shorter word of a pair (or, of equal lengths, the one that sorts first) contributes two disjoint chunks, its halves; the
other contributes positional grams. One edit leaves one of the two chunks whole, and the gram equal to it stands within a shift of
one from the chunk's place, the shift being the difference of the lengths. So of all positional grams only those of lengths and
places that some chunk can have are formed, keyed by chunk, place and length, and met by an equi-join, whose pairs are verified.

A key that many words share (a common beginning or ending) is not joined but split by the same method: what the kept
chunk leaves open is halved again, so the key grows by one of two further chunks. At the last step the open stretch is a single
letter, where the alphabet bounds a word's partners, so the work stays in proportion to the words and their links.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewarden.llm.common import stored, text_of

LEAST_LETTERS, LEAST_COUNT = 7, 2
#: Rows of the gram side that a key may hold before it is split.
CROWD = 32
#: A form is at least this many times as frequent as its variant.
FORM_RATIO = 10
#: Words that a task counts before it hands them on.
COUNTED_WORDS = 200_000
#: One of so many runs loses a letter, by its hash.
SLIP = 31


def _words(least: int):
    """Counts of words, added up over many texts before anything is shuffled."""
    run = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def packed(total: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column("id"), batch.column("text")):
                start = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(run.findall(text.as_py().encode().lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % SLIP == 0:
                        cut = h % len(word)
                        word = word[:cut] + word[cut + 1:]
                        if len(word) < least:
                            continue
                    total[word] += n
                if len(total) >= COUNTED_WORDS:
                    yield packed(total)
                    total = Counter()
        yield packed(total)
    return read


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_letters: int = LEAST_LETTERS,
          least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): words of at least `least_letters` letters with at least `least_count` occurrences, slips included."""
    rows = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), text_of(text_col).alias("text"))
    counted = rows.mapInArrow(_words(least_letters), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _key(length: Column, prefix: Column, suffix: Column) -> Column:
    return F.xxhash64(length, F.col("lo"), F.col("hi"), prefix, F.lit("|"), suffix)


def _split(rows: DataFrame) -> DataFrame:
    """Both halves of the open stretch [lo, hi) of the chunk side's word, as the new open stretch; the other half joins the key.

    `shift` is what a gram's word is longer than the chunk's. Prefix and suffix around the open stretch are the kept chunks, one
    of them moved by the shift."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct(F.col("lo").alias("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi").alias("hi")))
    open_ = rows.withColumn("_h", F.explode(halves)).withColumns({"lo": F.col("_h.lo"), "hi": F.col("_h.hi")}).drop("_h")
    prefix = F.substr("word", F.lit(1), F.col("lo"))
    suffix = F.substr("word", F.col("hi") + F.col("shift") + 1)
    return open_.withColumn("key", _key(F.length("word") - F.col("shift"), prefix, suffix))


def _meet(rows: DataFrame) -> DataFrame:
    """(a, na, b, nb): verified pairs of words that share a key. Where an inserted letter leaves both chunks whole, only the
    stretch that holds the first difference reports the pair."""
    chunk = rows.where("chunk").select("key", "hi", F.col("word").alias("a"), F.col("n").alias("na"))
    gram = rows.where("NOT chunk").select("key", "shift", F.col("word").alias("b"), F.col("n").alias("nb"))
    first = (F.col("hi") == F.length("a")) | (F.substr("a", F.lit(1), F.col("hi")) != F.substr("b", F.lit(1), F.col("hi")))
    one_edit = F.levenshtein("a", "b", 1) == 1
    apart = ((F.col("shift") == 1) | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b"))
    return chunk.join(gram, (chunk["key"] == gram["key"]) & apart & first & one_edit).select("a", "na", "b", "nb")


def near_words(vocabulary: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, na, b, nb): each pair of words of (word, n) that differ by exactly one inserted, deleted or replaced code point, once."""
    length = F.length("word")
    sides = F.array(*[F.struct(F.lit(c).alias("chunk"), F.lit(s).alias("shift")) for c, s in ((True, 0), (False, 0), (False, 1))])
    rows = vocabulary.withColumn("_s", F.explode(sides)).select(
        "word", "n", "_s.*", F.lit(0).alias("lo"), (length - F.col("_s.shift")).cast("int").alias("hi"))
    found = []
    while True:
        # Stored before they meet their counts, so that both sides are shuffled and the rows of a crowded key can be split.
        split = stored(_split(rows), "split")
        sizes = split.groupBy("key").agg(F.count_if("chunk").alias("chunks"), F.count_if(~F.col("chunk")).alias("grams"))
        # A word meets itself; a key with nothing else is of no use.
        rows = stored(split.join(sizes.where("chunks > 0 AND chunks + grams > 2"), "key"), "chunks")
        crowded = (F.col("grams") > crowd) & (F.col("hi") - F.col("lo") > 1)
        found.append(_meet(rows.where(~crowded)))
        rows = rows.where(crowded).drop("key", "chunks", "grams")
        if rows.isEmpty():
            return reduce(DataFrame.unionAll, found)


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each word's way along (word, form). Ways are doubled in each round, and a way of k steps needs
    10 ** k occurrences of its last word, so there are few."""
    ways = stored(forms.select("word", F.col("form").alias("root")), "ways")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = stored(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                             F.col("further").isNotNull().alias("moved")), "ways")
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        ways = longer.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the documents, see `words`.

    `n_near` counts the words one edit away; `form` is the most frequent of them, the smallest in code-point order of several,
    where it is at least ten times as frequent as the word; `root` is where the forms lead. A NULL text holds no words; a NULL id
    counts as an empty one; repeated rows count each time; other columns are left out, whatever their names. Runs of letters of any length are words.
    An empty table gives an empty table."""
    vocabulary = stored(words(docs, id_col, text_col), "words")
    links = stored(near_words(vocabulary, crowd), "near")
    both = links.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionAll(
        links.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("w"))).alias("_b"))
    known = stored(vocabulary.join(best, "word", "left").withColumns({
        "_f": F.when(-F.col("_b.n") >= FORM_RATIO * F.col("n"), F.col("_b")), "n_near": F.coalesce("n_near", F.lit(0))}).select(
        "word", "n", "n_near", F.col("_f.w").alias("form"), (-F.col("_f.n")).alias("form_n")), "forms")
    roots = _roots(known.where(F.col("form").isNotNull()))
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
