"""run() of the corpus pipeline against shingle sets, windows and library ids worked out by themselves."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tradewarden.llm import common, quality

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 8)))
    prose = lambda n: " ".join(word() + r.choice(["", "", "", ",", ".", " é"]) for _ in range(n))
    junk = lambda: " ".join([r.choice(["$$$", "click", "buy now"])] * r.randint(100, 300))
    texts = [prose(r.randint(20, 400)) for _ in range(60)]
    passage = prose(80) + " ü"
    texts += [prose(30) + passage + prose(30) for _ in range(4)]
    near = texts[5].split(" ")
    near[len(near) // 2] = "changed"
    texts += [" ".join(near), texts[6], texts[6].upper(), texts[7] + " tail", None, "", "one", prose(3000)]
    good = len(texts)
    texts += [junk() for _ in range(40)]
    rows = [(3 * i + 1, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return rows, [(3 * i + 1, int(i < good), 0) for i in range(0, len(texts))]


def distinct(kept):
    """The documents with the smallest id of each component of near copies."""
    sets = {}
    for i, t in kept:
        words = (t or "").encode().lower().split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((root(i), root(j)))
                    up[b] = a
    return [(i, t) for i, t in kept if root(i) == i]


def without(texts):
    """Texts without the bytes of repeated 200-byte strings; a character that lost some of its bytes goes whole."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + 200] for t in raw for i in range(len(t) - 199))
    out = []
    for t in raw:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - 199):
            if seen[t[i:i + 200]] > 1:
                gone[i:i + 200] = True
        out.append(bytes(np.frombuffer(t, np.uint8)[~gone]).decode(errors="ignore"))
    return out


def test_run_against_brute_force(spark, tmp_path):
    rows, labels = corpus()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = common.table(spark, str(tmp_path), "documents")
    verdicts = {r.doc_id: r.predicted for r in quality.score(docs, quality.fit(docs, common.table(spark, str(tmp_path), "labels"))).collect()}
    kept = sorted((i, t) for i, t, *_ in rows if verdicts[i])
    assert 50 < len(kept) < len(rows)

    single = distinct(kept)
    left = without([t for _, t in single])
    assert len(single) < len(kept) and sum(map(len, left)) < sum(len(t or "") for _, t in single)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for (i, _), t in zip(single, left)}

    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == ids.keys()
    placed: dict[int, list] = {}
    for i, tokens in ids.items():
        own = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces if r.doc_id == i)
        assert sum(n for _, n, _, _ in own) == len(tokens) and {t for *_, t in own} == {len(tokens)}
        at = 0
        for start, n, crc, _ in own:
            assert start == at and crc == zlib.crc32(np.array(tokens[start:start + n], dtype="<u4").tobytes())
            at += n
    for r in pieces:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in placed.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:])) and spans[-1][0] + spans[-1][1] <= 1024


@pytest.mark.parametrize("some_labels", [True, False])
def test_run_on_an_empty_table(spark, tmp_path, some_labels):
    spark.createDataFrame([], COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(1, 1, 0), (2, 0, 0)] if some_labels else []
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_steps_are_removed(spark, tmp_path):
    common.remove_steps(spark)
    df = common.stored(spark.range(5), "five")
    assert df.count() == 5 and common.remove_steps(spark) == 1 and common.remove_steps(spark) == 0
    with pytest.raises(Exception, match="(?i)not.exist|not found"):
        common.stored(spark.range(3), "three").unionByName(df).count()
