"""Operators on vectors against brute force."""

from __future__ import annotations

import numpy as np
import pytest

from tradewarden.llm import components, embedding_dedup, flat_graph, topk

NAN = float("nan")


def best(rows, k, share):
    out = []
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors[i, tuple(np.floor(64 * np.array(v)).astype(np.int64).tolist())] = None
    for i, q in vectors:
        if i % share == 0:
            found = sorted((-int(np.dot(q, x)), j) for j, x in vectors if j != i and len(x) == len(q))
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [{}, {"block_rows": 7, "block_queries": 3}])
def test_top_k(spark, blocks):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 16))
    v[40:80] = v[40]  # ties
    v[80:120] = v[80] + rng.normal(scale=0.01, size=(40, 16))
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(1000, None), (1020, [NAN] * 16), (1040, [None] * 16), (None, rows[0][1]), (1060, [1.0, 2.0]), (1061, [2.0, -1.0]), (40, rows[40][1]),
             (1080, []), (1100, [float("inf")] * 16)]
    df = spark.createDataFrame([(i, x, "a", 1) for i, x in rows], "vec_id long, embedding array<double>, score string, block int")
    got = topk.top_k(df, k=5, **blocks).collect()
    assert sorted(tuple(r) for r in got) == best(rows, 5, 20)


def test_bounds_hold_and_large_numbers_stay_exact():
    rng = np.random.default_rng(2)
    x = rng.integers(-100, 100, (50, 12))
    for segments in (1, 3, 5):
        s = topk._statistics(x.astype(float), segments)
        assert (s @ s.T >= (x @ x.T) - 1e-6).all()
    big = np.array([[2 ** 40, 3]])
    assert topk._products(big, big)[0, 0] == 2 ** 63 - 1 and topk._products(big, np.array([[2 ** 20 + 1, 1]]))[0, 0] == 2 ** 60 + 2 ** 40 + 3


def test_bounds_leave_a_fifth_of_structured_vectors():
    """Vectors near a few directions, hidden in a turned space: exact results, and few exact products."""
    rng = np.random.default_rng(3)
    turn = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    centres = rng.normal(size=(40, 6)) @ turn[:6]
    x = np.floor(64 * (centres[rng.integers(0, 40, 6000)] + 0.1 * rng.normal(size=(6000, 64)))).astype(np.int64)
    ids, tally = np.arange(6000), []
    q, vec, score = topk.search(ids[::20], x[::20], ids, x, 20, tally=tally)
    pairs, exact = map(sum, zip(*tally))
    assert exact < pairs / 5
    products = x[::20] @ x.T
    for i in range(300):
        want = sorted((-s, j) for j, s in enumerate(products[i].tolist()) if j != 20 * i)[:20]
        assert [(-s, j) for s, j in want] == list(zip(score[q == 20 * i].tolist(), vec[q == 20 * i].tolist()))


def test_resolutions_cover_all_axes():
    for d in (1, 2, 3, 16, 64, 1000):
        for leading in (1, 2, 8, 24):
            cuts = topk._resolution(d, leading)
            assert cuts[0] == 0 and cuts[-1] == d and (np.diff(cuts) > 0).all()


def near(rows, least=0.98):
    n = len(rows)
    unit = [None if label is None or v is None or not all(x is not None and np.isfinite(x) for x in v) or not np.any(v)
            else (w := np.array(v, dtype=float) / np.abs(v).max()) / np.linalg.norm(w) for _, v, label in rows]
    links, up = [0] * n, list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) \
                    and unit[i] @ unit[j] >= least:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    roots = [root(i) for i in range(n)]
    smallest = {r: min((rows[i][0] for i in range(n) if roots[i] == r and rows[i][0] is not None), default=None) for r in set(roots)}
    return sorted(((str(rows[i][0]), links[i], str(smallest[roots[i]]), rows[i][0] == smallest[roots[i]]) for i in range(n)))


@pytest.mark.parametrize("sizes", [{}, {"size": 24, "tile": 8}])
def test_vectors_in_shards_and_crowds(spark, sizes):
    rng = np.random.default_rng(3)
    rows = []
    for label in (1, 2):
        v = rng.normal(size=(150, 16))
        v[20:60] = v[20] + rng.normal(scale=0.02, size=(40, 16))  # a crowd
        v[60:65] = v[60]
        v[70] = 3 * v[60]
        v[90:100] = v[100:110] + rng.normal(scale=0.03, size=(10, 16))
        rows += [(len(rows) + i, [float(x) for x in r], label) for i, r in enumerate(v)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [NAN] * 16, 1), (903, rows[0][1], None), (904, [None] * 16, 1), (905, [1.0], 1),
             (906, [2.0], 1), (None, rows[0][1], 1), (5, rows[200][1], 2), (907, [], 2), (908, [1e300] * 16, 2), (909, [1e300] * 16, 2)]
    df = spark.createDataFrame([(i, v, k, 7) for i, v, k in rows], "vec_id long, embedding array<double>, label int, node int")
    got = sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in embedding_dedup.near_duplicates(df, **sizes).collect())
    want = near(rows)
    assert len(got) == len(want)
    assert sum(min(a[1], b[1]) for a, b in zip(got, want)) >= 0.95 * sum(b[1] for b in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want))  # no link that isn't one
    if not sizes:
        assert got == want


def test_graph_search_finds_what_is_in_range():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(400, 12))
    v[100:140] = v[100] + rng.normal(scale=0.03, size=(40, 12))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    lists = flat_graph.build(unit)
    assert max(map(len, lists)) <= flat_graph.DEGREE
    found = flat_graph.within(unit, flat_graph.padded(lists), np.arange(400), flat_graph.medoid(unit), 0.98)
    exact = unit @ unit.T >= 0.98
    assert not (found & ~exact).any() and (found & exact).sum() >= 0.95 * exact.sum()


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2)) if a != b] + [(i, i + 1) for i in range(500, 560)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i
    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: root(i) for i in list(up)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_audit_acts_on_a_broken_graph(spark, monkeypatch):
    """A search that finds nothing ends in exact tiles; one that works is kept."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(30, 16))
    rows = [(i, (centre[i % 30] + 0.02 * rng.normal(size=16)).tolist(), i % 2) for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    real, calls = embedding_dedup.links, []

    def broken(*given, exact=False):
        calls.append(exact)
        found = real(*given, exact=exact)
        return found if exact else found.limit(0)
    monkeypatch.setattr(embedding_dedup, "links", broken)
    got = embedding_dedup.near_duplicates(df, size=64).collect()
    assert calls == [False] * embedding_dedup.ROUNDS + [True]
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == near(rows)


def test_the_audit_looks_until_it_has_seen_links(spark):
    """Rare links, and a node with very many copies, which count once."""
    rng = np.random.default_rng(6)
    unit = rng.normal(size=(900, 32))
    unit[1::90] = unit[0::90] + 0.01 * rng.normal(size=(10, 32))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    nodes = spark.createDataFrame([(i, str(i // 450), 32, u.tolist(), 5000 if i < 2 else 1) for i, u in enumerate(unit)],
                                  "node long, label string, dim int, unit array<double>, weight long")
    links = [(i, 1) for k in range(0, 900, 90) for i in (k, k + 1)]
    for kept, share in ((links, 1.0), (links[:2], 0.1), ([], 0.0)):
        found = spark.createDataFrame(kept, "node long, apart long")
        assert embedding_dedup.audit(nodes, found, 0.98, size=5, seen=1000, most=2000) == (share, 20)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert topk.top_k(none).count() == 0 and embedding_dedup.near_duplicates(none).count() == 0
