"""Collocations against plain counts of all phrases."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tradewarden.llm import phrases


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows, least=10, top=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\v\f\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    candidates = {p for p, c in f.items() if len(p) > 2 and c >= least}
    longer = defaultdict(int)
    for p in candidates:
        if len(p) == 4:
            for q in (p[:3], (p[0], *p[2:])):
                longer[q] = max(longer[q], f[p])
    found = defaultdict(list)
    for p in candidates:
        if len(p) == 3 and p in longer and 100 * longer[p] >= 50 * f[p]:
            continue
        cuts = [(10 ** 6 * f[p] ** 2 // (f[p[:k + 1]] * f[(p[0], *p[k + 1:])]), k, f[p[:k + 1]], f[(p[0], *p[k + 1:])]) for k in range(1, len(p) - 1)]
        score, _, left, right = min(cuts)
        found[p[0]].append((-score, -f[p], " ".join(p[1:]).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, best in found.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(best)[:top]))


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(8)
    words = ["The", "of", "é", "ab", "Zq", "x", "日本", "a b"]
    rows = []
    for i in range(120):
        text = "".join(r.choice(words) + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "! "]) for _ in range(r.randint(1, 200)))
        rows.append((r.choice(["en", "de", None, "und"]), text))
    rows += [("en", None), ("en", ""), (None, " .,\n"), ("de", "one TWO three. " * 30), ("de", "one two " * 5), ("fr", "un deux"), ("fr", "un deux")]
    return rows + [("en", "new york city, " * 50 + "a very long piece without an end " * 3000)] + [("es", "la la la la la la la la la la la la la")] * 2


SCHEMA = "word string, lang string, text string, shard int, n int, phrase string"


@pytest.mark.parametrize("limits", [{}, {"HOT_COUNT": 60, "HOT_WORDS": 10 ** 9}, {"HOT_COUNT": 0, "HOT_WORDS": 10 ** 9, "SHARD_POINTERS": 300, "FAN_OUT": 3, "BROADCAST_ROWS": 0}])
def test_collocations(spark, corpus, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(phrases, name, value)
    df = spark.createDataFrame([("w", lang, text, 1, 2, "p") for lang, text in corpus], SCHEMA).repartition(6)
    got = sorted(map(tuple, phrases.collocations(df).collect()))
    assert got == expected(corpus) and len(got) > 100


def test_top_and_least(spark, corpus):
    df = spark.createDataFrame(corpus, "lang string, text string")
    got = sorted(map(tuple, phrases.collocations(df, least=12, top=7).collect()))
    assert got == expected(corpus, 12, 7)


def test_empty(spark):
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0


def test_long_texts_are_cut_between_pieces(monkeypatch, corpus):
    texts = [t or "" for _, t in corpus]

    def words():
        return [(r, w.as_py(), (i, p)) for i, part in enumerate(phrases.slices(enumerate(texts)))
                for r, w, p in zip(part.row.tolist(), part.known.take(pa.array(part.word)), part.piece.tolist())]
    whole = words()
    monkeypatch.setattr(phrases, "SLICE", 50)
    cut = words()
    assert [x[:2] for x in cut] == [x[:2] for x in whole]
    assert [a[2] == b[2] for a, b in zip(cut, cut[1:])] == [a[2] == b[2] for a, b in zip(whole, whole[1:])]


def test_sort_counts_every_prefix():
    rng = np.random.default_rng(2)
    for high, size in ((2, 500), (6, 2000), (1, 50), (40, 300)):
        keys, weight = rng.integers(0, high, (3, size)).astype(np.int32), rng.integers(1, 4, size)
        for least in (1, 5, 60):
            want = Counter()
            for column, w in zip(keys.T.tolist(), weight.tolist()):
                for d in range(3):
                    want[tuple(column[:d + 1])] += w
            got = {tuple(keys[:d + 1, p].tolist()): n for d, pointer, total in phrases.frequent(keys, weight, least) for p, n in zip(pointer, total.tolist())}
            assert got == {k: v for k, v in want.items() if v >= least}
