"""Operators on whole texts against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import zstandard

from tradewarden.llm import common, lm, minhash, quality, suffix_dedup, suffix_sort


def held(doc_id, folds, which):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == which


# ---- suffix arrays and repeated passages


@pytest.mark.parametrize("letters", [1, 2, 4, 60])
@pytest.mark.parametrize("n", [1, 2, 3, 40, 700])
def test_suffix_array_and_common_prefixes(n, letters):
    t = np.random.default_rng(n * letters).integers(0, letters, n).astype(np.uint8)
    raw = t.tobytes()
    want = sorted(range(n), key=lambda i: raw[i:])
    order = suffix_sort.suffix_array(t)
    assert order.tolist() == want
    phi, common = suffix_sort.common_prefixes(t, order)
    for a, b in zip(want, want[1:]):
        same = next((k for k in range(n) if max(a, b) + k >= n or raw[a + k] != raw[b + k]), n)
        assert phi[b] == a and common[b] == same


def cover(texts: list[bytes], span: int) -> list[tuple[int, int, int, str]]:
    seen = Counter(t[i:i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - span + 1):
            if seen[t[i:i + span]] > 1:
                gone[i:i + span] = b"\1" * span
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("limits", [{}, {"hot_texts": 2, "shard_texts": 3}])
def test_repeats_go_and_nothing_else(docs, rows, limits):
    got = suffix_dedup.remove_repeats(docs, with_text=True, **limits).collect()
    texts = [(t or "").encode() for _, t in rows]
    want = sorted((str(i), *c) for (i, _), c in zip(rows, cover(texts, 200)))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    passage = by_id[6]
    assert passage.text.startswith("start ") and passage.spans[0].start <= 6 and len(passage.text.encode()) == passage.n_bytes - passage.n_removed
    assert by_id[14].n_removed == by_id[14].n_bytes and by_id[17].n_removed == 0


@pytest.mark.parametrize("hot_texts", [1, 3, 8192])
def test_hot_passages_in_many_contexts(spark, hot_texts):
    """One passage in many texts, with different bytes around it, at lengths about the span; hot names are named again and again."""
    r = random.Random(12)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passages = [word(n) for n in (40, 120, 199, 200, 203, 420)]
    texts = [word(r.randint(0, 150)) + p + (word(3) if i % 3 else p[:30]) + word(r.randint(0, 150)) for p in passages for i in range(14)]
    texts += [t[:-1] + "é" for t in texts[::5]] + texts[::9]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), hot_texts=hot_texts)
    found = sorted((x.doc_id, x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256) for x in got.collect())
    assert found == [(i, *c) for i, c in enumerate(cover([t.encode() for t in texts], 200))]


def test_names_of_any_length_agree_on_equal_windows():
    r = random.Random(13)
    common = bytes(r.choice(b"ab") for _ in range(300))
    texts = [bytes(r.choice(b"ab") for _ in range(n)) + common for n in (0, 17, 300)]
    for gram in (32, 33, 64, 116, 158, 199, 200):
        names = []
        for t in texts:
            found = {}
            for _, start, windows, name, _ in zip(*suffix_dedup.runs([t], 200, gram), strict=True):
                found |= {t[i:i + 200]: int(name) for i in range(start, start + windows)}
            assert len(found) == len({t[i:i + 200] for i in range(len(t) - 199)})
            names.append(found)
        for i in range(101):
            assert len({f[common[i:i + 200]] for f in names}) == 1


@pytest.mark.parametrize("limits", [{}, {"shard_texts": 1}])
def test_common_passages_around_the_span(spark, limits):
    """Tables whose texts share less than the span, just the span, or a little more; no window of a shard need repeat."""
    r = random.Random(11)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    for common in (31, 32, 150, 199, 200, 201):
        for n in (2, 5):
            shared = word(common)
            texts = [word(r.randint(200, 500)) + shared + word(r.randint(200, 500)) for _ in range(n)]
            got = suffix_dedup.remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **limits)
            found = sorted((x.doc_id, x.n_bytes, x.n_removed, len(x.spans), x.kept_sha256) for x in got.collect())
            assert found == [(i, *c) for i, c in enumerate(cover([t.encode() for t in texts], 200))]


def test_long_text_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 1000)
    r = random.Random(3)
    raw = [bytes(r.choice(b"abcdefgh ") for _ in range(n)) for n in (2500, 999, 1000, 1001, 150)]
    raw += [raw[0][700:1500] + raw[1], b"", raw[2][:199]]
    for t, found in zip(raw, suffix_dedup._text_runs(raw, 200), strict=True):
        assert found[1].sum() == max(0, len(t) - 199)  # every window belongs to one run
    names = [{(int(n), t[s:s + w + 199]) for s, w, n, _ in zip(*f)} for t, f in zip(raw, suffix_dedup._text_runs(raw, 200), strict=True)]
    assert {n for n, _ in names[0]} & {n for n, _ in names[5]} and not {n for n, _ in names[0]} & {n for n, _ in names[3]}


# ---- near-duplicates


def shingle_sets(rows):
    out = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return out


def linked(sets, percent=75):
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    return [root(i) for i in range(len(sets))]


@pytest.mark.parametrize("block", [128, 2])
def test_near_duplicates(docs, rows, block):
    got = minhash.near_duplicates(docs, block=block).collect()
    sets = shingle_sets(rows)
    roots = linked(sets)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (least.get(r), i) != (None, None) else None
    want = sorted((str(i), len(s), str(least[r] if s else i), i == (least[r] if s else i)) for (i, _), s, r in zip(rows, sets, roots))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == want
    assert len({r.group for r in got}) == len(set(roots))


def test_a_large_group_of_near_copies_is_one_component(spark):
    r = random.Random(1)
    base = [f"w{i}" for i in range(150)]
    copies = []
    for i in range(120):
        w = list(base)
        for at in r.sample(range(150), 3):
            w[at] = f"e{i}.{at}"
        copies.append((i, " ".join(w)))
    rows = copies + [(1000 + i, " ".join(f"o{i}.{k}" for k in range(40))) for i in range(40)]
    got = {x.doc_id: x.component_id for x in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=16).collect()}
    roots = linked(shingle_sets(rows))
    want = {i: min(j for (j, _), s in zip(rows, roots) if s == q) for (i, _), q in zip(rows, roots)}
    assert got == want


@pytest.mark.parametrize("block", [1024, 8])
def test_similar_pairs_in_buckets_whose_smallest_member_is_unlike_both(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BUCKET_BLOCK", block, raising=False)
    r = random.Random(8)
    shared = [f"s{k}" for k in range(80)]
    plain = [shared + [f"o{i}.{k}" for k in range(120)] for i in range(60)]  # some 0.24 alike
    pairs = [w[:150] + [f"n{i}"] + w[151:] for i, w in enumerate(plain[30:])]
    texts = [" ".join(w) for w in plain + pairs]
    sets = shingle_sets(list(enumerate(texts)))
    roots = linked(sets)
    assert len(set(roots)) == 60 and all(0.15 < len(sets[0] & x) / len(sets[0] | x) < 0.3 for x in sets[1:])
    hashed = [minhash.shingles([w.encode() for w in t.split()]) for t in texts]
    # All meet in two buckets and nowhere else, as documents of a few templates do in a large table.
    rows = [(i, i, i, i, len(h), minhash.signature(minhash.minima(h)).view(np.int64).tolist(), [1, 2], bytearray(zstandard.compress(t.encode())))
            for i, (t, h) in enumerate(zip(texts, hashed))]
    r.shuffle(rows)
    got = {x.doc_id: x.component_id for x in minhash.groups(spark.createDataFrame(rows, minhash.SIGNED), 75, 5, 128).collect()}
    assert got == {i: i if i < 60 else i - 30 for i in range(90)}


def test_estimates_agree_with_the_sets():
    r = random.Random(5)
    a = [f"w{i}" for i in range(600)]
    b = a[:450] + [f"v{r.random()}" for _ in range(150)]
    sets = [minhash.shingles([w.encode() for w in x]) for x in (a, b)]
    sigs = [minhash.signature(minhash.minima(s))[None] for s in sets]
    exact = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert abs(minhash._estimates(*sigs)[0, 0] - exact) < 0.1 and minhash._estimates(sigs[0], sigs[0])[0, 0] == 1


# ---- scores


@pytest.mark.parametrize("head", [200_000, 5])
def test_unigram_counts_and_scores(docs, rows, head):
    got = lm.score(docs, head_words=head, steps=20).collect()
    counts = Counter()
    for i, t in rows:
        if not held(i, 7, 2):
            counts.update([*(t or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), None]
        want.append((str(i), held(i, 7, 2), len(w), sum(x in counts for x in w), n,
                     round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def plain_score(model, counts, text):
    """log10 probability of a text, token by token from the parts of the model."""
    n, groups = model["classes"].n, model["classes"].groups
    place = {w: i for i, w in enumerate(model["words"])}
    group_of = dict(zip(model["anchors"], model["group_of_anchor"].tolist()))
    words = [*(text or "").encode().lower().split(), b""]
    votes = [Counter(group_of[w] for w in words[a:a + lm.STRETCH] if w in group_of) for a in range(0, len(words), lm.STRETCH)]
    whole = sum(votes, Counter())
    lead = [min(v or whole or {0: 1}, key=lambda g, v=v: (-(v or whole)[g], g)) for v in votes]

    def kind(i):
        if words[i] in place:
            return int(model["class_of"][place[words[i]]])
        return int(model["classes"].tails[lead[i // lm.STRETCH]])
    end = int(model["class_of"][place[b""]]) if b"" in place else 0
    total = 0.0
    for i, w in enumerate(words):
        row = model["table"][kind(i - 2) if i > 1 else end, kind(i - 1) if i > 0 else end]
        if w in counts:
            own = kind(i) if w in place else int(model["classes"].tails[counts[w][1]])
            total += float(row[own]) + math.log10((counts[w][0] + 1) / model["held"][own])
        else:
            total += float(row[n])
    return total


@pytest.mark.parametrize("head", [200_000, 40])
def test_scores_against_a_plain_loop(spark, docs, rows, head):
    texts = docs.select("text").fillna("")
    model = lm.fit(texts, head_words=head, steps=60)
    counts = {bytes(r.word): (r.c, r.g) for r in model["counts"].collect()}
    assert len(model["words"]) <= min(head + lm.ANCHORS, len(counts)) and set(model["anchors"]) <= set(model["words"])
    # All words and the unseen one share out one whole after any two classes.
    held, n = model["held"], model["classes"].n
    own = {w: (int(model["class_of"][model["words"].index(w)]) if w in model["words"] else int(model["classes"].tails[g])) for w, (_, g) in counts.items()}
    for two, one in ((0, 0), (1, 2), (n - 1, 5)):
        row = 10.0 ** model["table"][two, one].astype(float)
        assert abs(sum(row[own[w]] * (c + 1) / held[own[w]] for w, (c, _) in counts.items()) + row[n] + sum(
            row[k] for k in range(n) if k not in own.values() and k <= model["classes"].anchors) - 1) < 1e-3
    texts = [t for _, t in rows] + ["words that were never seen before " * 40, "ABCDE abcde", "x"]
    plain = spark.createDataFrame([(i, i, True, t or "") for i, t in enumerate(texts)], "uid long, doc_id long, held_out boolean, text string")
    for r in lm.score_with(model, plain).collect():
        assert abs(r.score - plain_score(model, counts, texts[r.doc_id])) < 1e-3 * max(1, r.n_tokens / 100), r.doc_id


def test_held_out_perplexity_is_a_third_below_the_base(spark):
    got = lm.score(common.table(spark, "/root/testdata/sf0.01", "documents")).where("held_out")
    n, base, model = got.selectExpr("sum(n_tokens)", "sum(base_score)", "sum(score)").first()
    assert 10 ** (-model / n) < 2 / 3 * 10 ** (-base / n)


def test_training_in_rounds(spark):
    """Events in several tasks, averaged, teach what all events at hand do."""
    rng = np.random.default_rng(0)
    n, follow = 8, rng.permutation(8)
    own = rng.integers(0, n, 4000)
    codes, counts = np.unique((rng.integers(0, n, 4000) * n + own) * n + follow[own], return_counts=True)
    events = spark.createDataFrame(list(zip(codes.tolist(), counts.tolist())), "code long, n long")
    table = lm.train_in_rounds(events, n, steps=200, task_events=20)
    assert np.allclose((10 ** table).sum(axis=2), 1) and table[:, np.arange(n), follow].mean() > np.log10(0.5)
    assert np.allclose((10 ** lm.train_in_rounds(events.limit(0), n, steps=5)).sum(axis=2), 1)


def test_predictions_are_normalised_and_learn():
    rng = np.random.default_rng(0)
    n, follow = 8, rng.permutation(8)
    own = rng.integers(0, n, 4000)
    code = (rng.integers(0, n, 4000) * n + own) * n + follow[own]
    codes, counts = np.unique(code, return_counts=True)
    table = lm.train(codes, counts, n, steps=300, batch=512)
    assert np.allclose((10 ** table).sum(axis=2), 1)
    right = table[:, np.arange(n), follow]
    assert right.mean() > np.log10(0.5)
    flat = lm.train(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), n)
    assert np.allclose((10 ** flat).sum(axis=2), 1)


def labelled(spark, n=300):
    r = random.Random(9)
    texts, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        w = ["".join(r.choice(("the", "re", "on", "an", "is")) for _ in range(2)) for _ in range(r.randint(20, 120))]
        texts.append((i, " ".join(w) if good else " ".join(f"{x}{r.choice('$%&#')}{r.randint(0, 99)}" for x in w)))
        labels.append((i, int(good), "en", 0))
    return (spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, text string, score int"))


def test_quality_on_texts_it_has_not_learnt(spark, docs, rows):
    known, labels = labelled(spark)
    model = quality.fit(known, labels)
    got = quality.score(known, model).join(labels.select("doc_id", "quality"), "doc_id").collect()
    out = [r for r in got if r.held_out]
    assert {r.doc_id for r in out} == {r.doc_id for r in got if held(r.doc_id, 5, 0)}
    assert sum(r.predicted == r.quality for r in out) >= 0.95 * len(out) and all(0 <= r.score <= 1 for r in got)
    odd = quality.score(docs, model).collect()
    assert sorted(str(r.doc_id) for r in odd) == sorted(str(i) for i, _ in rows) and all(0 <= r.score <= 1 for r in odd)
    kept = quality.keep(known, model)
    assert kept.columns == known.columns and kept.count() == sum(r.predicted for r in got)
    assert quality.keep(docs, model).columns == docs.columns


def test_quality_against_one_text_at_a_time(spark, docs, rows):
    """Scores from the stored model by fresh compressors and the written-out curve."""
    good = [(100 + i, " ".join(words_(i, 200))) for i in range(30)]
    bad = [(200 + i, "buy now cheap " * (20 + i)) for i in range(30)]
    known = spark.createDataFrame(good + bad, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    model = quality.fit(known, labels)
    kind = zstandard.DICT_TYPE_AUTO if model["trained"] else zstandard.DICT_TYPE_RAWCONTENT

    def size(text, given):
        extra = {"dict_data": zstandard.ZstdCompressionDict(given, dict_type=kind)} if given else {}
        coder = zstandard.ZstdCompressor(level=quality.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False, **extra)
        return len(coder.compress(text))

    def plain(text):
        raw = (text or "").encode()
        with_good, with_bad, alone = (size(raw, d) for d in (model["good"], model["bad"], None))
        rate, length = with_good / (len(raw) + 8), math.log1p(len(raw))
        features = [(with_bad - with_good) / alone, rate, rate * rate, length, rate * length, 1.0]
        z = sum(w * x for w, x in zip(model["curve"], features))
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, z))))
    want = sorted((str(i), round(plain(t), 9)) for i, t in rows)
    assert sorted((str(r.doc_id), round(r.score, 9)) for r in quality.score(docs, model).collect()) == want


def words_(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(n)]


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([(1, None), (None, 1), (2, 1)], "doc_id long, quality int")
    model = quality.fit(docs, none)
    assert {round(r.score, 6) for r in quality.score(docs, model).collect()} == {round(model["constant"], 6)}


def test_empty_tables(spark, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    assert minhash.near_duplicates(no_docs).count() == 0
    assert lm.score(no_docs, steps=1).count() == 0
    assert quality.score(no_docs, quality.fit(no_docs, labels)).count() == 0


@pytest.mark.parametrize("far", [0.5, 3.0, 50.0])
def test_the_curve_is_found_however_far_the_labels_are_apart(far):
    rng = np.random.default_rng(6)
    y = np.repeat([0.0, 1.0], 300)
    rate = rng.uniform(0.05, 0.6, 600)
    x = np.column_stack([rng.normal(size=600) + far * y, rate, rate ** 2, rng.normal(7, 1, 600), rate * 7])
    w = quality._logistic(x, y)
    right = ((quality._curve(x @ w[:-1] + w[-1]) >= 0.5) == y).mean()
    assert np.isfinite(w).all() and right >= (0.55 if far < 1 else 0.9 if far < 10 else 1)
