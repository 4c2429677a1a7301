"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from tradewarden.llm import spelling


def counted(rows):
    n = Counter()
    for key, text in rows:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", lowered):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= 2}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(n):
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        yield w, form[w], root, n[w], len(near[w]), n.get(form[w])


def garbled(r, word):
    i, c = r.randrange(len(word)), r.choice("abcé")
    return r.choice([word[:i] + word[i + 1:], word[:i] + c + word[i + 1:], word[:i] + c + word[i:], word + c, word])


@pytest.fixture(scope="module")
def typos():
    r = random.Random(5)
    base = ["".join(r.choice("abcé") for _ in range(r.randint(7, 12))) for _ in range(40)] + ["aaaaaaa", "aaaaaaaa", "prefix" + "a" * 30]
    rows = [(1, " ".join(base * 130)), (2, " ".join(garbled(r, w) for w in base * 12)), (3, " ".join(garbled(r, garbled(r, w)) for w in base * 6))]
    rows += [(i, " ".join(("shared" * 3) + garbled(r, "abcabca") for _ in range(30))) for i in range(10, 20)]
    return rows + [(4, None), (4, ""), (None, "NoIdNoId ÀÉÎÕÜàéîõü x×÷yzabcd " * 3), (5, "short words only"), (6, "q" * 5000 + " " + "q" * 5000 + " " + "q" * 4999),
                   (7, "q" * 4999), (8, "chainedw " * 300 + "chainedx " * 25 + "chainexx chainexx "), (8, "Chainedx"), (1, "repeated row"), (1, "repeated row")]


@pytest.mark.parametrize("crowd", [spelling.CROWD, 1, 0])
def test_variants(spark, typos, crowd):
    df = spark.createDataFrame([("w", "k", *r, 1) for r in typos], "word string, key string, doc_id long, text string, n int").repartition(3)
    got = [tuple(r) for r in spelling.variants(df, crowd=crowd).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = sorted(expected(counted(typos)))
    assert sorted(got) == want and sum(w[4] for w in want) > 300
    roots = {w[0]: w[2] for w in want}
    assert roots["chainexx"] == "chainedw" != dict((w[0], w[1]) for w in want)["chainexx"]


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None)], "doc_id long, text string")).count() == 0
