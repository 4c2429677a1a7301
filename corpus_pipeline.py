"""The corpus pipeline: stages of tradewarden.llm over `documents`, each on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewarden.llm import minhash, packing, quality, suffix_dedup
from tradewarden.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _others(docs: DataFrame) -> Column:
    """All columns but the text in one, which goes through an operator with its row: no text is then stored or shuffled
    just to be joined with them again."""
    named = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != "text"]
    return F.struct(F.col("text").isNull().alias("missing"), *named)


def _whole(found: DataFrame, docs: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """The columns of `docs` again, from `carried` and `changed`."""
    return found.select(*[changed.get(c, F.col(f"carried.c{i}")).alias(c) for i, c in enumerate(docs.columns)])


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier, learnt from the labels of those at hand, doesn't reject. A NULL text is scored as
    an empty one; without labels of both kinds all documents have one score; texts of any length are scored whole."""
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id. Documents without words, NULL included, stay;
    rows that repeat an id are documents of their own, and one without an id stays only if no row of its group has one."""
    kept = minhash.one_of_each(docs, _others(docs))
    return _whole(kept, docs, {"text": F.when(~F.col("carried.missing"), F.col("text"))})


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages that repeat, here or in another; n_chars is that of the text that is left. A NULL text
    stays NULL, with no characters; a text that only repeats becomes empty and stays."""
    found = suffix_dedup.remove_repeats(docs, with_text=True, carry=_others(docs))
    return _whole(found, docs, {"text": F.when(~F.col("carried.missing"), F.col("text")), "n_chars": F.length("text").cast("long")})


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their training sequences; a NULL or empty text is the end token alone."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents), ("near_duplicates", distinct_documents), ("repeated_passages", without_repeats), ("packing", packed)]

# Learned scores, suffix arrays and tokenizers are out of SQL's reach; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written as Parquet and reread as the next stage's documents. An empty table, or
    one of which the classifier keeps nothing, gives no pieces; further columns of `documents` are carried along."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
