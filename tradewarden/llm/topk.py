"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector cut into segments is summed up by each segment's mean and deviation. For two vectors the squared differences of
those, times the segment's length, never exceed the squared distance, so by |q - x|^2 = |q|^2 + |x|^2 - 2 q.x they bound
the inner product from above, and finer segments bound it closer. Candidates that a coarse bound puts below the k-th best
exact score so far are gone before finer bounds, and at last the exact products, are computed for the rest. Raw components
have no order that segments could use, so a block is turned first: by an orthonormal basis of its own, longest axes first,
which keeps inner products. The scores are the integer products of the vectors as they are. Thresholds begin with each
query's k-th best score among a few rows.

Queries and candidates are dealt to blocks of bounded size. A task gets one block of each, and the best of all its
pairs are merged per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.llm.common import parts, stored

K = 20
SCALE = 64
QUERY_SHARE = 20
#: Axes that each resolution holds one by one.
LEVELS = (2, 8, 24)
#: Rows of the first pass, which every task with queries holds.
FIRST_ROWS = 2_048
#: Below this share of survivors each query's products are computed by themselves.
SPARSE = 0.2
BLOCK_ROWS = 8_192
BLOCK_QUERIES = 16_384
QUERIES_AT_ONCE = 128
#: From this product of norms on, sums of products are no longer exact in doubles.
EXACT = 2.0 ** 52


def _statistics(v: np.ndarray, segments: int | np.ndarray) -> np.ndarray:
    """Mean and deviation of each segment, times the root of its length: their products bound the inner product. Segments are
    given by their cuts, or as a number of even ones."""
    cuts = np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(int) if isinstance(segments, int) else segments
    length = np.diff(cuts).astype(float)
    mean = np.add.reduceat(v, cuts[:-1], axis=1) / length
    square = np.add.reduceat(v * v, cuts[:-1], axis=1) / length
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.concatenate([mean, deviation], axis=1) * np.sqrt(np.concatenate([length, length]))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products; beyond the range of a long, the nearest long."""
    norms = np.sqrt((q.astype(float) ** 2).sum(axis=1).max(initial=0)) * np.sqrt((x.astype(float) ** 2).sum(axis=1).max(initial=0))
    if norms < EXACT:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    exact = q.astype(object) @ x.astype(object).T
    return np.clip(exact, -(2 ** 63), 2 ** 63 - 1).astype(np.int64) if exact.size else exact.astype(np.int64)


def _basis(x: np.ndarray) -> np.ndarray:
    """An orthonormal basis with the axes along which the rows of `x` are longest first; it keeps inner products."""
    _, axes = np.linalg.eigh(x.T @ x)
    return axes[:, ::-1]


def _resolution(d: int, leading: int) -> np.ndarray:
    """Cuts of segments: the leading axes one by one, and behind them segments that double in length."""
    ahead = min(leading, d)
    return np.unique(np.concatenate([np.arange(ahead + 1), np.minimum(ahead * 2 ** np.arange(1, 64 - max(1, ahead).bit_length()), d), [d]]))


def search(q_ids: np.ndarray, q: np.ndarray, x_ids: np.ndarray, x: np.ndarray, k: int, levels: tuple[int, ...] = LEVELS,
           least_of: np.ndarray | None = None, tally: list | None = None):
    """(query id, vec id, score) arrays: the k best of `x` for each of `q`, ties to the smaller id, own ids left out.

    `least_of` are scores that each query's k-th best is known to reach. `tally` gets (pairs, exact products) per batch."""
    order = np.argsort(x_ids, kind="stable")
    x_ids, x = x_ids[order], x[order]
    plain = x.astype(float)
    basis = _basis(plain) if plain.shape[1] and np.isfinite(plain.T @ plain).all() else np.eye(plain.shape[1])
    turned = plain @ basis
    coarse = [(_statistics(turned, cuts), cuts) for cuts in (_resolution(x.shape[1], s) for s in levels) if len(cuts) - 1 < x.shape[1]]
    room = np.sqrt((plain ** 2).sum(axis=1))
    out = []
    for at in range(0, len(q), QUERIES_AT_ONCE):
        ids, part = q_ids[at:at + QUERIES_AT_ONCE], q[at:at + QUERIES_AT_ONCE]
        alive = ids[:, None] != x_ids[None, :]
        pairs = int(alive.sum())
        slack = 1e-9 * (np.sqrt((part.astype(float) ** 2).sum(axis=1))[:, None] * room[None, :]) + 1e-6
        least = np.full(len(part), -np.inf) if least_of is None else least_of[at:at + QUERIES_AT_ONCE].astype(float)
        columns = np.arange(len(x))
        for level, (stats, cuts) in enumerate(coarse):
            bound = _statistics(part.astype(float) @ basis, cuts) @ stats[columns].T + slack[:, columns]
            if level == 0 and len(columns) > 4 * k:
                # The exact scores of the candidates that look best are the first k-th best scores.
                first = np.argpartition(np.where(alive[:, columns], -bound, np.inf), 2 * k, axis=1)[:, :2 * k + 1]
                for i in range(len(part)):
                    scores = _products(part[i:i + 1], x[first[i][alive[i, first[i]]]])[0]
                    if len(scores) >= k:
                        least[i] = max(least[i], np.partition(scores, len(scores) - k)[len(scores) - k])
            alive[:, columns] &= bound >= least[:, None]
            columns = columns[alive[:, columns].any(axis=0)]
        live = alive[:, columns]
        # Survivors are few for each query or many for all: then one product of matrices is quicker than many small ones.
        single = live.sum() < SPARSE * live.size
        products = None if single else _products(part, x[columns])
        for i in range(len(part)):
            left = np.flatnonzero(live[i])
            scores = _products(part[i:i + 1], x[columns[left]])[0] if single else products[i, left]
            left, scores = left[scores >= least[i]], scores[scores >= least[i]]
            if len(left) > k:
                cut = np.partition(scores, len(left) - k)[len(left) - k]
                left, scores = left[scores >= cut], scores[scores >= cut]
            best = np.lexsort((x_ids[columns[left]], -scores))[:k]
            out.append((np.full(len(best), ids[i]), x_ids[columns[left[best]]], scores[best]))
        if tally is not None:
            tally.append((pairs, int(live.sum())))
    empty = np.empty(0, dtype=np.int64)
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [empty, empty, empty]


def _thresholds(sample, k: int):
    """A score that each query's k-th best reaches: its k-th best among the sample, the smallest long where that has fewer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = sample.value
        by_dim = {d: (np.array([i for i, v in zip(ids, vectors) if len(v) == d]), np.array([v for v in vectors if len(v) == d], dtype=np.int64))
                  for d in set(map(len, vectors)) if d}
        for batch in batches:
            least = []
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                scores = np.empty(0)
                if len(v) in by_dim:
                    of, x = by_dim[len(v)]
                    scores = _products(np.array([v], dtype=np.int64), x[of != i])[0]
                least.append(int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -(2 ** 63))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=[*batch.schema.names, "least"])
    return run


def _task(k: int):
    def rows(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = t["vec_id"].to_numpy()
        flat = t["v"].combine_chunks().flatten().to_numpy() if t.num_rows else np.empty(0, dtype=np.int64)
        return ids, flat.reshape(len(ids), -1) if len(ids) else flat.reshape(0, 0)

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        (q_ids, q), (x_ids, x) = rows(queries), rows(candidates)
        least = queries["least"].to_numpy()
        found = search(q_ids, q, x_ids, x, k, least_of=least) if len(q_ids) and len(x_ids) else [np.empty(0, dtype=np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, k: int = K, scale: int = SCALE, query_share: int = QUERY_SHARE, id_col: str = "vec_id",
          vector_col: str = "embedding", block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of all other rows for each row whose id `query_share` divides.

    Components are turned into floor(scale * component), the component as double. NULL vectors, vectors with NULL or
    non-finite components and rows without an id take no part; only vectors of one length are compared. Rows that agree in
    id and vector are one row, and other rows with the query's id count as the query's own. Scores beyond a long become the
    nearest long, as components do. An empty table gives an empty result; other columns are ignored, whatever their names."""
    spark = vectors.sparkSession
    limit = float(2 ** 63 - 1024)
    v = F.col("v").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("v"))
    rows = rows.withColumn("v", v).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))
    rows = rows.withColumn("v", F.transform("v", lambda c: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), c * float(scale)))).cast("long")))
    rows = stored(rows.withColumn("dim", F.size("v")).distinct(), "top-k-rows")
    is_query = F.col("vec_id") % query_share == 0
    total = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, groups = parts(spark, total.n, block_rows), -(-total.q // block_queries) or 1
    block, group = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)), F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(groups))
    every = lambda n, name: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)
    # The stated queries against all rows, in blocks: a query goes to each block of candidates, a candidate to each group of
    # queries, of which there is one per `block_queries`.
    candidates = rows.select("vec_id", "v", "dim", block.alias("block"), every(groups, "group"))
    # Thresholds from a first pass over a few rows, before any block is searched.
    first = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").select("vec_id", "v").limit(FIRST_ROWS).toArrow()
    sample = spark.sparkContext.broadcast((first["vec_id"].to_pylist(), first["v"].to_pylist()))
    asked = rows.where(is_query).mapInArrow(_thresholds(sample, k), "vec_id long, v array<long>, dim int, least long")
    queries = asked.select("vec_id", "v", "dim", "least", every(blocks, "block"), group.alias("group"))
    keys = ["dim", "block", "group"]
    found = queries.groupBy(*keys).cogroup(candidates.groupBy(*keys)).applyInArrow(_task(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
