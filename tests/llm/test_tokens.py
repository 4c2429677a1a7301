"""Token counts, pieces and packing against the libraries."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tradewarden.llm import packing, pieces, queries, token_counts

WORD, BYTE, PIECE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))


def library(path):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize(("chunk", "overlap"), [(32_768, 1_024), (500, 60), (100, 2)])
def test_token_counts(docs, rows, chunk, overlap):
    got = token_counts.count_tokens(docs, WORD, chunk=chunk, overlap=overlap, limit=1000).collect()
    ids = library(WORD)
    want = [(str(i), len((t or "").encode()), n := len(ids(t)), n > 1000) for i, t in rows]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(want)


def test_overlaps_widen_until_they_hold_a_boundary(spark):
    text = "word " * 30 + "y" * 700 + " and " + "é" * 900 + " end"
    one = spark.createDataFrame([("k", text)], "key string, text string")
    assert token_counts.splice(one, WORD, 100, 10).first().n_tokens is None
    assert token_counts.long_counts(one, WORD, 100, 10).first().n_tokens == len(library(WORD)(text))


def test_units_of_a_byte_level_text():
    ids, r = packing.Ids(BYTE), random.Random(1)
    letters = [chr(c) for c in range(0x21, 0x180)] + ["\n", "\t", "\x85", "\xa0", "'s", "12", "日", "🙂", " ", "  "]
    for _ in range(300):
        text = " ".join("".join(r.choice(letters) for _ in range(r.randint(0, 12))) for _ in range(8))
        assert ids.encode([text])[0] == ids.whole(text), repr(text)


@pytest.mark.parametrize("size", [1024, 16])
def test_packing(docs, rows, size):
    got = packing.pack(docs, BYTE, size=size).collect()
    ids = library(BYTE)
    coded = {}
    for i, t in rows:
        coded.setdefault(i, []).append(np.array([*ids(t), 0], dtype="<u4"))
    for r in got:
        assert any(r.doc_tokens == len(x) and zlib.crc32(x[r.start:r.start + r.length].tobytes()) == r.ids_crc32 for x in coded[r.doc_id])
    for i, xs in coded.items():
        assert sum(r.length for r in got if r.doc_id == i) == sum(map(len, xs))
        assert sorted(r.start for r in got if r.doc_id == i) == sorted(s for x in xs for s in range(0, len(x), size))
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert {r.sequence_tokens for r in members} == {at} and at <= size
        assert {r.padded_tokens for r in members} == {at if at & (at - 1) == 0 else size}


def test_patterns_use_each_piece_once_and_pad_little():
    r = random.Random(2)
    histogram = {n: r.randint(0, 40) for n in range(1, 65)}
    histogram = {k: v for k, v in histogram.items() if v}
    patterns = packing.pack_histogram(histogram, 64)
    used = {}
    for count, lengths in patterns:
        assert sum(lengths) <= 64
        for n in lengths:
            used[n] = used.get(n, 0) + count
    assert used == histogram
    assert sum(k * v for k, v in histogram.items()) >= 0.95 * 64 * sum(c for c, _ in patterns)


def test_pieces_as_the_library(docs, rows):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = pieces.encode(docs, PIECE)
    assert sorted((str(r.doc_id), list(r.ids)) for r in got.collect()) == sorted((str(i), model.encode(t or "")) for i, t in rows)
    back = got.withColumn("text", pieces.decode(got["ids"], PIECE)).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), t or "") for i, t in rows)


@pytest.mark.parametrize("head", [200_000, 3])
def test_piece_figures(docs, rows, head):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = []
    for i, t in rows:
        ids = model.encode(t or "")
        want.append((str(i), len((t or "").encode()), len(ids), sum(map(model.is_byte, ids)), sum(ids), True))
    got = pieces.summarise(docs, PIECE, head_units=head).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_pieces, r.n_byte_pieces, r.id_sum, r.round_trip) for r in got) == sorted(want)


@pytest.mark.parametrize("head", [200_000, 3])
def test_whole_texts_as_the_library(docs, rows, head):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    want = sorted((str(i), len((t or "").encode()), model.encode(t or ""), True) for i, t in rows)
    got = pieces.encode_whole(docs, PIECE, head_units=head).collect()
    assert sorted((str(r.doc_id), r.n_bytes, list(r.ids), r.round_trip) for r in got) == want


def test_the_query_returns_the_ids_of_whole_texts(spark, tmp_path):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = [(1, "one two  three "), (2, " three two one"), (3, "a ▁ mark"), (4, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_sentencepiece(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, list(r.ids), r.round_trip) for r in got) == [(i, model.encode(t or ""), i != 3) for i, t in rows]


def test_empty_tables(no_docs):
    assert token_counts.count_tokens(no_docs, WORD).count() == 0
    assert packing.pack(no_docs, BYTE).count() == 0
    assert pieces.summarise(no_docs, PIECE).count() == 0 and pieces.encode(no_docs, PIECE).count() == 0


def test_whole_texts_of_an_empty_table(no_docs):
    assert pieces.encode_whole(no_docs, PIECE).count() == 0


def test_units_are_cut_where_no_piece_reaches(spark):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    cut, many = pieces.segments(["▁end.\nThe", "▁²x", "▁"], PIECE)
    assert "".join(cut) == "▁end.\nThe▁²x▁" and many.sum() == len(cut) and cut[0] == "▁end" and cut[-1] == "▁"
    rows = [(1, "thein" * 40 + "².x"), (2, "a " + "on" * 50 + "▁" * 70 + "y"), (3, " " * 200), (4, "日本" * 80)]
    got = pieces.encode_whole(spark.createDataFrame(rows, "doc_id long, text string"), PIECE, head_units=0).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == [(i, model.encode(t)) for i, t in rows]


def test_packed_numbers():
    numbers = np.array([0, 127, 128, 5, 16_383, 16_384, 3_000_000, 1], dtype=np.int32)
    packed, sizes = pieces.pack(numbers, np.array([0, 3, 3, 8]))
    back, bounds = pieces.unpack(packed, sizes)
    assert back.tolist() == numbers.tolist() and bounds.tolist() == [0, 3, 3, 8] and sizes == [4, 0, 11]
