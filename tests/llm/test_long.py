"""Documents of some megabytes through every operator on texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tradewarden.llm import chat, common, lm, minhash, packing, phrases, pieces, quality, spelling, suffix_dedup, token_counts, warc


@pytest.fixture(scope="module")
def texts():
    r = random.Random(31)
    words = ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    return [" ".join(r.choice(words) + r.choice(["", "", ".", ","]) for _ in range(800_000)), "x" * 1_000_000, " " * 500_000,
            "ab" * 200_000 + " " + "日本語" * 50_000, "a short one", None, ""]


@pytest.fixture(scope="module")
def long_docs(spark, texts):
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    assert max(len(t or "") for t in texts) > 5_000_000
    return common.stored(df, "long")


def test_counts_and_packing(long_docs, texts):
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(long_docs, public_tokenizers.path("word_bpe_49k.json")).collect()}
    assert got == {i: (len((t or "").encode()), len(words.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts)}
    coded = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packed = packing.pack(long_docs, public_tokenizers.path("byte_bpe_50k.json")).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in packed} == {i: len(coded.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}


def test_repeats_and_near_copies(long_docs, texts):
    removed = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.remove_repeats(long_docs).collect()}
    assert [removed[i] for i in (0, 1, 2, 4, 5, 6)] == [(len(texts[0]), 0), (10 ** 6, 10 ** 6), (500_000, 500_000), (11, 0), (0, 0), (0, 0)]
    sets = {r.doc_id: r.n_shingles for r in minhash.near_duplicates(long_docs).collect()}
    words = texts[0].split()
    assert sets[0] == len(set(zip(*(words[k:] for k in range(5))))) and [sets[i] for i in range(1, 7)] == [1, 0, 1, 1, 0, 0]


def test_scores(spark, long_docs, texts):
    got = {r.doc_id: r.n_tokens for r in lm.score(long_docs, steps=20).collect()}
    assert got == {i: len((t or "").split()) + 1 for i, t in enumerate(texts)}
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, 0), (4, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.score(long_docs, quality.fit(long_docs, labels)).collect())


def test_words_and_phrases(long_docs, texts):
    found = {r.word: r.n for r in spelling.variants(long_docs).collect()}
    assert all(n >= 2 for n in found.values()) and len(found) > 500
    best = phrases.collocations(long_docs, least=2).collect()
    assert len(best) == 2000 and {r.n for r in best} == {sum(len(t.replace(".", " ").replace(",", " ").split()) for t in texts if t)}


def test_pages_turns_and_pieces(spark, long_docs, texts):
    pages = long_docs.selectExpr("doc_id AS page_id", "concat('http://a.org/', doc_id) AS url", "text AS html")
    assert {r.page_id: r.payload_bytes for r in warc.archive(pages).collect()} == {i: len((t or "").encode()) for i, t in enumerate(texts)}
    turns = long_docs.selectExpr("doc_id % 2 AS conv_id", "doc_id AS turn", "'assistant' AS role", "text")
    read = {r.conv_id: r.loss_chars for r in chat.read_back(chat.format_conversations(turns)).collect()}
    assert read == {k: sum(len(t or "") for t in texts[k::2]) for k in (0, 1)}
    assert all(r.round_trip for r in pieces.encode_whole(long_docs.where("doc_id > 3"), public_tokenizers.path("piece_bpe_32k.model")).collect())
