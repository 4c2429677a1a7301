"""Near-duplicate vectors by a robust-pruned flat graph built on overlapping cluster shards.

Equal vectors are one node. Nodes are dealt to the pivots of their label that they are nearly nearest to, again and again
until a shard is small. Each shard builds its graph; a node's adjacency list is the union of its lists in all its shards.
Every shard then searches from its medoid for each of its nodes, along the united lists, which also lead to close nodes of
other shards, and expands all that lies in range. A link is verified in double precision and counted once, in the first
shard that both ends share. The result is audited: exact links of sampled nodes against those found, copies counted once,
over all labels alike, with more nodes until enough links were seen. If too few were found, all is done again with a wider
overlap, and after the last round by exact tiles. A crowd of nodes too close together to be split goes through exact tiles anyway.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tradewarden.llm import flat_graph
from tradewarden.llm.common import stored
from tradewarden.llm.components import components
from tradewarden.llm.minhash import _mix

LEAST = 0.98
SHARD = 512
PIVOTS = 64
#: A node joins every pivot whose cosine falls behind its best one's by no more than this.
OVERLAP = 0.08
#: Pivots closer together than this cosine count as one.
SPREAD = 0.9
#: A shard with more than this share of its parent's nodes is a crowd that pivots don't split.
STUCK = 0.7
TILE = 256
RECALL, ROUNDS = 0.95, 3
#: Nodes of the first audit, links to be seen, and nodes of the last audit if they aren't.
AUDITED, LINKS_SEEN, AUDITED_MOST = 200, 400, 3_200

MEMBER = "node long, shard long, unit array<double>"
#: kind 0: node a has n links counted here, m of them to different vectors; 1: a and b are connected; 2: a and b are linked and share no shard.
RESULT = "kind int, a long, b long, n long, m long"


def _matrix(t: pa.Table) -> np.ndarray:
    return t["unit"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)


def _deal(overlap: float, pivots: int, size: int):
    """The nodes of a part of a shard, dealt to the shards of its pivots; `above` is the number of nodes of the shard."""
    def run(given: pa.Table, members: pa.Table) -> pa.Table:
        pool, unit = _matrix(given), _matrix(members)
        n, parent = given["n"][0].as_py(), given["shard"][0].as_py()
        most = min(pivots, max(2, -(-8 * n // size)))
        chosen: list[int] = []
        for i in np.argsort(given["rank"].to_numpy()).tolist():
            if len(chosen) < most and (not chosen or (pool[chosen] @ pool[i]).max() < SPREAD):
                chosen.append(i)
        close = unit @ pool[chosen].T
        row, pivot = np.nonzero(close >= close.max(axis=1, keepdims=True) - overlap)
        ids = given["node"].to_numpy()[chosen].astype(np.uint64)
        child = _mix(_mix(ids + np.uint64(1)) + np.uint64(parent % 2 ** 64)).view(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1) * unit.shape[1], pa.int32()), pa.array(unit[row].ravel()))
        return pa.table([pa.array(members["node"].to_numpy()[row]), pa.array(child[pivot]), lists, pa.array(np.full(len(row), n))],
                        names=["node", "shard", "unit", "above"])
    return run


def shards(nodes: DataFrame, overlap: float, size: int = SHARD, pivots: int = PIVOTS) -> tuple[DataFrame, DataFrame]:
    """Members (MEMBER) of shards of up to `size` nodes, and of the crowds that pivots don't split."""
    members = stored(nodes.select("node", F.xxhash64("label", "dim").alias("shard"), "unit").withColumn("above", F.lit(2 ** 62)), "members")
    small, crowds = members.limit(0), members.limit(0)
    while True:
        counts = stored(members.groupBy("shard").agg(F.count("*").alias("n"), F.max("above").alias("above")), "shard-sizes")
        stuck = F.col("n") > STUCK * F.col("above")
        kind = F.when(F.col("n") <= size, "small").when(stuck, "crowd").otherwise("large")
        sorted_ = counts.select("shard", "n", kind.alias("kind"))
        members = members.drop("above").join(sorted_, "shard")
        small = small.unionByName(members.where("kind = 'small'").drop("n", "kind"), allowMissingColumns=True)
        crowds = crowds.unionByName(members.where("kind = 'crowd'").drop("n", "kind"), allowMissingColumns=True)
        if sorted_.where("kind = 'large'").isEmpty():
            return small.drop("above"), crowds.drop("above")
        large = members.where("kind = 'large'").drop("kind")
        first = Window.partitionBy("shard").orderBy(F.xxhash64("node"), "node")
        pool = large.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= 4 * pivots)
        salts = F.ceil(F.col("n") / size)
        pool = pool.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
        salted = large.withColumn("salt", F.pmod(F.xxhash64("node", F.lit(3)), salts))
        pool = pool.select(*[F.col(c).alias(c) for c in pool.columns])  # columns of its own, not those of the other side
        dealt = pool.groupBy("shard", "salt").cogroup(salted.groupBy("shard", "salt"))
        members = stored(dealt.applyInArrow(_deal(overlap, pivots, size), MEMBER + ", above long"), "members")


def _build(t: pa.Table) -> pa.Table:
    unit, nodes = _matrix(t), t["node"].to_numpy()
    lists = flat_graph.build(unit)
    a = np.repeat(np.arange(len(nodes)), [len(x) for x in lists])
    b = np.concatenate(lists).astype(np.int64)
    return pa.table([pa.array(nodes[a]), pa.array(nodes[b]), pa.array(np.einsum("ij,ij->i", unit[a], unit[b]))], names=["a", "b", "cosine"])


def _first_common(homes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest shard that holds both ends of each pair; the largest long where none does."""
    none = np.iinfo(np.int64).max
    out = np.empty(len(i), dtype=np.int64)
    for at in range(0, len(i), 1 << 14):
        x, y = homes[i[at:at + (1 << 14)]], homes[j[at:at + (1 << 14)]]
        both = (x[:, :, None] == y[:, None, :]).any(axis=2) & (x != none)
        out[at:at + (1 << 14)] = np.where(both, x, none).min(axis=1)
    return out


def _homes(t: pa.Table) -> np.ndarray:
    lists = t["homes"].to_pylist()
    out = np.full((len(lists), max(map(len, lists))), np.iinfo(np.int64).max)
    for i, x in enumerate(lists):
        out[i, :len(x)] = x
    return out


def _rows(shard: int, nodes: np.ndarray, weight: np.ndarray, homes: np.ndarray, i: np.ndarray, j: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """RESULT rows for links i -> j, given in both directions."""
    counted = _first_common(homes, i, j) == shard
    n = np.bincount(i[counted], weights=weight[j[counted]], minlength=len(nodes)).astype(np.int64)
    m = np.bincount(i[counted], minlength=len(nodes))
    has = np.flatnonzero(m)
    least, before = np.arange(len(nodes)), None
    while before is None or (least != before).any():
        before = least.copy()
        np.minimum.at(least, i, before[j])
    up = np.flatnonzero(least != np.arange(len(nodes)))
    none = np.zeros(len(up))
    return [(np.zeros(len(has)), nodes[has], nodes[has], n[has], m[has]), (np.ones(len(up)), nodes[up], nodes[least[up]], none, none)]


def _result(rows: list[tuple[np.ndarray, ...]]) -> pa.Table:
    kind, *rest = map(np.concatenate, zip(*rows, strict=True))
    return pa.table([pa.array(kind.astype(np.int32)), *(pa.array(c.astype(np.int64)) for c in rest)], names=["kind", "a", "b", "n", "m"])


def _search(least: float):
    """Links of a shard's members, to each other and to the close nodes of other shards."""
    def run(t: pa.Table) -> pa.Table:
        unit, nodes, homes = _matrix(t), t["node"].to_numpy(), _homes(t)
        weight, inside = t["weight"].to_numpy(), ~t["outside"].to_numpy(zero_copy_only=False)
        at = {x: i for i, x in enumerate(nodes.tolist())}
        near = [np.array([at[x] for x in (r or []) if x in at], dtype=np.int64) for r in t["near"].to_pylist()]
        members = np.flatnonzero(inside)
        start = members[flat_graph.medoid(unit[members])]
        hit = np.zeros((len(nodes), len(nodes)), dtype=bool)
        hit[members] = flat_graph.within(unit, flat_graph.padded(near), members, start, least)
        hit |= hit.T
        np.fill_diagonal(hit, False)
        i, j = np.nonzero(hit & inside[:, None] & inside[None, :])
        rows = _rows(t["shard"][0].as_py(), nodes, weight, homes, i, j)
        i, j = np.nonzero(hit & inside[:, None] & ~inside[None, :])
        apart = _first_common(homes, i, j) == np.iinfo(np.int64).max
        a, b = nodes[i[apart]], nodes[j[apart]]
        rows.append((np.full(len(a), 2), np.minimum(a, b), np.maximum(a, b), np.zeros(len(a)), np.zeros(len(a))))
        return _result(rows)
    return run


def _tile(least: float):
    """Links between two blocks of a crowd, or within one."""
    def run(t: pa.Table) -> pa.Table:
        unit, nodes, block = _matrix(t), t["node"].to_numpy(), t["block"].to_numpy()
        hit = unit @ unit.T >= least
        np.fill_diagonal(hit, False)
        if block.min() != block.max():
            hit &= block[:, None] != block[None, :]
        i, j = np.nonzero(hit)
        return _result(_rows(t["shard"][0].as_py(), nodes, t["weight"].to_numpy(), _homes(t), i, j))
    return run


def links(nodes: DataFrame, least: float, overlap: float, size: int, tile: int, exact: bool = False) -> DataFrame:
    """RESULT rows for nodes (node, label, dim, unit, weight), stored. `exact`: all nodes of a label are one crowd."""
    if exact:
        crowds = nodes.select("node", F.xxhash64("label", "dim").alias("shard"), "unit")
        small = crowds.limit(0)
    else:
        small, crowds = shards(nodes, overlap, size)
    small, crowds = stored(small, "shards"), stored(crowds, "crowds")
    edges = stored(small.groupBy("shard").applyInArrow(_build, "a long, b long, cosine double"), "graph")
    near = edges.groupBy("a").agg(F.collect_set("b").alias("near")).withColumnRenamed("a", "node")
    homes = small.select("node", "shard").unionByName(crowds.select("node", "shard")).groupBy("node").agg(
        F.sort_array(F.collect_list("shard")).alias("homes"))
    about = nodes.select("node", "weight").join(homes, "node")
    # Two nodes in range of a third are at most twice the angle apart: only such edges can lead out of a shard and back.
    close = edges.where(F.col("cosine") >= 2 * least * least - 1).select(F.col("a").alias("node"), "b").distinct()
    outside = (small.select("shard", "node").join(close, "node").select("shard", F.col("b").alias("node")).distinct()
               .join(small.select("shard", "node"), ["shard", "node"], "left_anti"))
    outside = outside.join(nodes.select("node", "unit"), "node").withColumns(
        {"outside": F.lit(True), "near": F.lit(None).cast("array<long>")})
    inside = small.join(near, "node", "left").withColumn("outside", F.lit(False))
    searched = inside.unionByName(outside).join(about, "node").groupBy("shard").applyInArrow(_search(least), RESULT)
    blocks = crowds.join(crowds.groupBy("shard").agg(F.ceil(F.count("*") / tile).alias("blocks")), "shard")
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    pair = [F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two")]
    tiled = blocks.join(about, "node").groupBy("shard", *pair).applyInArrow(_tile(least), RESULT)
    return stored(searched.unionByName(tiled), "links")


def _exact(sample: list, least: float):
    """Links of the sampled nodes, by comparing them with all nodes: a matrix product per label and batch."""
    by_label: dict = {}
    for r in sample:
        by_label.setdefault((r.label, r.dim), []).append(r)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = {k: (np.array([r.node for r in v]), np.array([r.unit for r in v])) for k, v in by_label.items()}
        for batch in batches:
            labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
            nodes, rows, found = batch.column("node").to_numpy(), {}, [np.empty(0, np.int64)]
            for i, key in enumerate(zip(labels, dims, strict=True)):
                rows.setdefault(key, []).append(i)
            for key in rows.keys() & given.keys():
                ids, units = given[key]
                unit = batch.column("unit").take(pa.array(rows[key])).flatten().to_numpy().reshape(len(rows[key]), -1)
                sampled, _ = np.nonzero((units @ unit.T >= least) & (ids[:, None] != nodes[rows[key]][None, :]))
                found.append(ids[sampled])
            node, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(n, pa.int64())], names=["node", "n"])
    return run


def audit(nodes: DataFrame, found: DataFrame, least: float, size: int = AUDITED, seen: int = LINKS_SEEN, most: int = AUDITED_MOST) -> tuple[float, int]:
    """The share of the exact links of sampled nodes that `found` (node, apart: links to different vectors) holds, and how many
    there are. Nodes are taken by a hash, from every label alike, at first `size` and then more until `seen` links were met, `most`
    nodes compared, or none is left. No links at all is a share of 1."""
    in_label = Window.partitionBy("label", "dim").orderBy(F.xxhash64("node", F.lit(7)), "node")
    ranked = nodes.select("node", "label", "dim", "unit", F.row_number().over(in_label).alias("rank")).where(F.col("rank") <= most)
    turn = ("rank", F.xxhash64("label", "dim", F.lit(7)), "node")
    pool = stored(ranked.orderBy(*turn).limit(most), "audited")
    while True:
        sample = pool.orderBy(*turn).limit(size).collect()
        exact = nodes.mapInArrow(_exact(sample, least), "node long, n long").groupBy("node").agg(F.sum("n").alias("n"))
        got = exact.join(found, "node", "left").agg(F.sum("n"), F.sum(F.least("n", F.coalesce("apart", F.lit(0))))).first()
        links_, held = int(got[0] or 0), int(got[1] or 0)
        if links_ >= seen or size >= most or len(sample) < size:
            return (held / links_ if links_ else 1.0), links_
        size = min(most, 4 * size)


def near_duplicates(vectors: DataFrame, least: float = LEAST, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", overlap: float = OVERLAP, size: int = SHARD, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of `vectors`.

    Rows with equal labels, not NULL, are linked from a cosine of `least` on; n_links counts the other rows linked directly,
    component_id is the smallest id that links reach, and kept is vec_id = component_id. Vectors that are NULL, zero, of
    another length, or that hold NULL or non-finite components are linked with nothing. A row without an id belongs to its
    component and is kept only if no row of it has an id; rows that repeat an id are vectors of their own. An empty table
    gives an empty result; other columns are ignored, whatever their names. No link found is below `least`; the share of
    all links that is found is audited, see `audit`: below RECALL the search is widened, and at last everything is compared."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"),
                          F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    largest = F.array_max(F.transform("v", F.abs))
    valid = F.col("label").isNotNull() & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))) & (largest > 0)
    rows = stored(rows.withColumn("valid", F.coalesce(valid, F.lit(False))).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    nodes = rows.where("valid").groupBy("label", "v").agg(F.min("uid").alias("node"), F.min("vec_id").alias("least"), F.count("*").alias("weight"))
    scaled = nodes.withColumn("u", F.transform("v", lambda c: c / largest))
    norm = F.sqrt(F.aggregate("u", F.lit(0.0), lambda s, c: s + c * c))
    nodes = stored(scaled.withColumn("norm", norm).withColumn("unit", F.transform("u", lambda c: c / F.col("norm")))
                   .select("node", "least", "label", "v", F.size("v").alias("dim"), "unit", "weight"), "vector-nodes")
    for round_ in range(ROUNDS + 1):
        found = links(nodes, least, overlap, size, tile, exact=round_ == ROUNDS)
        across = found.where("kind = 2").select("a", "b").distinct()
        weight = nodes.select(F.col("node").alias("b"), F.col("weight").alias("n"))
        both = across.unionByName(across.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(weight, "b").select(
            "a", "n", F.lit(1).cast("long").alias("m"))
        counts = found.where("kind = 0").select("a", "n", "m").unionByName(both).groupBy("a").agg(
            F.sum("n").alias("links"), F.sum("m").alias("apart"))
        counts = stored(counts.withColumnRenamed("a", "node"), "link-counts")
        if round_ == ROUNDS or audit(nodes, counts, least)[0] >= RECALL:
            break
        overlap *= 2
    groups = components(found.where("kind = 1").select("a", "b").unionByName(across))
    named = nodes.select("node", "least", "label", "v", "weight").join(counts, "node", "left").join(groups, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    reached = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(reached, "component").select(
        "label", "v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    linked = rows.where("valid").join(named, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not valid").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
