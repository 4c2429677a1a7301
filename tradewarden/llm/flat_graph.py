"""A robust-pruned proximity graph over unit vectors in numpy: building it, and searching it for all vectors in a range."""

from __future__ import annotations

import numpy as np

DEGREE = 16
ALPHA = 1.2
BEAM = 12


def build(unit: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> list[np.ndarray]:
    """Neighbours of each vector: again and again the nearest one left, without those that are `alpha` times nearer to it
    than to the vector itself."""
    n = len(unit)
    square = np.maximum(2 - 2 * (unit @ unit.T), 0)
    left = square.copy()
    np.fill_diagonal(left, np.inf)
    everyone, out = np.arange(n), []
    for _ in range(min(degree, n - 1)):
        nearest = left.argmin(axis=1)
        open_ = np.isfinite(left[everyone, nearest])
        out.append(np.where(open_, nearest, -1))
        left[everyone, nearest] = np.inf
        left[(alpha * alpha * square[nearest] <= square) & open_[:, None]] = np.inf
    chosen = np.column_stack(out) if out else np.empty((n, 0), dtype=np.int64)
    return [row[row >= 0] for row in chosen]


def padded(neighbours: list[np.ndarray]) -> np.ndarray:
    """The lists as one array, filled up with -1."""
    width = max([1, *map(len, neighbours)])
    out = np.full((len(neighbours), width), -1, dtype=np.int64)
    for i, row in enumerate(neighbours):
        out[i, :len(row)] = row
    return out


def medoid(unit: np.ndarray) -> int:
    return int((unit @ unit.mean(axis=0)).argmax())


def within(unit: np.ndarray, neighbours: np.ndarray, queries: np.ndarray, start: int, least: float, beam: int = BEAM) -> np.ndarray:
    """Which vectors each query (an index) finds with a product of at least `least`: greedy search from `start` with a beam,
    after which everything found in range is expanded until nothing new turns up."""
    q, n = len(queries), len(unit)
    seen = np.zeros((q, n), dtype=bool)
    product = np.full((q, n), -2.0)
    done = np.zeros((q, n), dtype=bool)

    def visit(rows: np.ndarray, nodes: np.ndarray) -> None:
        to = neighbours[nodes]
        r = np.repeat(rows, to.shape[1])
        to = to.ravel()
        keep = to >= 0
        r, to = r[keep], to[keep]
        new = ~seen[r, to]
        r, to = r[new], to[new]
        seen[r, to] = True
        product[r, to] = np.einsum("ij,ij->i", unit[queries[r]], unit[to])

    seen[:, start] = True
    product[:, start] = unit[queries] @ unit[start]
    k = min(beam, n)
    while True:
        best = np.argpartition(-product, k - 1, axis=1)[:, :k]
        value = np.take_along_axis(product, best, axis=1)
        value[np.take_along_axis(done, best, axis=1) | (value < -1.5)] = -2
        pick = value.argmax(axis=1)
        rows = np.flatnonzero(value[np.arange(q), pick] > -1.5)
        if not len(rows):
            break
        nodes = best[rows, pick[rows]]
        done[rows, nodes] = True
        visit(rows, nodes)
    while True:
        rows, nodes = np.nonzero((product >= least) & ~done)
        if not len(rows):
            return product >= least
        for at in range(0, len(rows), 1 << 15):
            part = slice(at, at + (1 << 15))
            done[rows[part], nodes[part]] = True
            visit(rows[part], nodes[part])
