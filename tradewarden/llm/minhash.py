"""Near-duplicate documents by b-bit MinHash over word shingles.

Each document gets the minima of many hash functions over its shingles. Bands of minima give candidate buckets; of each
minimum only the low bits are kept, packed into longs, and the share of equal ones, corrected for chance collisions,
estimates the similarity. Documents that meet the smallest of a bucket and don't look unlike it form a cluster. In buckets
that still hold several clusters all members are compared by their signatures. In a cluster pairs with a high enough
estimate are compared on their full shingle sets, unless they are known to be connected. Equal texts are one node from the
start, and large buckets and clusters are worked through in tiles of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewarden.llm.common import stored, text_of
from tradewarden.llm.components import components

WORDS = 5
PERCENT = 75
ROWS_PER_BAND, BANDS, BITS = 6, 48, 4
# A pair of similarity s meets in no band with probability (1 - s ** 6) ** 48: below 1e-4 for 0.75. Edges to the smallest of
# a bucket are followed from an estimate of NEAR on. Any other pair of a bucket is followed, and any pair of a cluster
# compared on its full sets, from PERCENT / 100 - MARGIN on, over five standard deviations of the estimate.
NEAR, MARGIN = 0.4, 0.15
BLOCK, BUCKET_BLOCK = 128, 1024

_HASHES = ROWS_PER_BAND * BANDS
_LONGS = _HASHES * BITS // 64
_rng = np.random.default_rng(20)
_A = _rng.integers(0, 2 ** 31, _HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2 ** 32, _HASHES, dtype=np.uint32)
_BAND = _rng.integers(0, 2 ** 63, (BANDS, ROWS_PER_BAND), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_ADD = _rng.integers(0, 2 ** 63, BANDS, dtype=np.uint64)
_BYTE = _rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_UNSTEP = pow(_STEP, -1, 2 ** 64)
_PLACE = np.array([pow(0xD6E8FEB86659FD93, i, 2 ** 64) for i in range(64)], dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit polynomial hash of each word."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    raw = np.frombuffer(b"".join(words), dtype=np.uint8)
    up = _BYTE[raw] * _powers(_STEP, len(raw))
    return _mix(np.add.reduceat(up, starts) * _powers(_UNSTEP, len(raw))[starts] + lengths.astype(np.uint64))


def shingles(words: list[bytes], size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; of a shorter text, of the whole sequence."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = word_hashes(words)
    n = max(1, len(w) - size + 1)
    if len(w) < size:
        return _mix(np.array([(w * _PLACE[:len(w)]).sum() + np.uint64(len(w))], dtype=np.uint64))
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += w[k:k + n] * _PLACE[k]
    return np.unique(_mix(total + np.uint64(size)))


def minima(found: np.ndarray) -> np.ndarray:
    x = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(_HASHES, 2 ** 32 - 1, dtype=np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, (_A[:, None] * x[None, at:at + 1024] + _B[:, None]).min(axis=1), out=out)
    return out


def signature(least: np.ndarray) -> np.ndarray:
    """The low bits of the minima (after a fixed mixing step), packed into longs."""
    low = _mix(least.astype(np.uint64)) & np.uint64(2 ** BITS - 1)
    shifts = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(low.reshape(_LONGS, -1) << shifts, axis=1)


def bands(least: np.ndarray) -> np.ndarray:
    return _mix((least.reshape(BANDS, ROWS_PER_BAND).astype(np.uint64) * _BAND).sum(axis=1, dtype=np.uint64) + _BAND_ADD)


SIGNED = "uid long, doc_id long, h1 long, h2 long, n_shingles long, sig array<long>, bands array<long>, body binary"


def _sign(size: int):
    """Per document: a 128-bit hash of its words, the size of its set, signature, band keys, and its text, compressed."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = part.column("text").to_pylist()
                h, n, sigs, keys, bodies = [], [], [], [], []
                for text in texts:
                    raw = text.encode()
                    words = raw.lower().split()
                    found = shingles(words, size)
                    h.append(np.frombuffer(hashlib.blake2b(b" ".join(words), digest_size=16).digest(), dtype=np.int64))
                    n.append(len(found))
                    least = minima(found)
                    sigs.append(signature(least))
                    keys.append(bands(least))
                    bodies.append(pack(raw))
                h = np.array(h)
                lists = lambda x, k: pa.ListArray.from_arrays(
                    pa.array(np.arange(0, k * len(x) + 1, k), pa.int32()), pa.array(np.concatenate(x).view(np.int64)))
                carried = [x for x in part.schema.names if x == "carried"]
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid"), part.column("doc_id"), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(n, pa.int64()),
                     lists(sigs, _LONGS), lists(keys, BANDS), pa.array(bodies, pa.binary()), *(part.column(x) for x in carried)],
                    names=["uid", "doc_id", "h1", "h2", "n_shingles", "sig", "bands", "body", *carried])
    return run


def estimate(one: str, other: str):
    """Similarity by bit counts: the share of equal low bits, corrected for those equal by chance."""
    lowest = sum(1 << i for i in range(0, 64, BITS))

    def unequal(x, y):
        z = x.bitwiseXOR(y)
        folded = z
        for k in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(z, k))
        return F.bit_count(folded.bitwiseAND(F.lit(lowest)))
    apart = F.aggregate(F.zip_with(one, other, unequal), F.lit(0), lambda s, x: s + x)
    chance = 2.0 ** -BITS
    return (1 - apart / F.lit(float(_HASHES)) - chance) / (1 - chance)


def _estimates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The same for all pairs of two blocks of signatures (rows of longs)."""
    lowest = np.uint64(sum(1 << i for i in range(0, 64, BITS)))
    apart = np.zeros((len(a), len(b)))
    for k in range(a.shape[1]):
        z = a[:, k, None] ^ b[None, :, k]
        folded = z
        for s in range(1, BITS):
            folded = folded | (z >> np.uint64(s))
        apart += np.bitwise_count(folded & lowest)
    chance = 2.0 ** -BITS
    return (1 - apart / _HASHES - chance) / (1 - chance)


def _root(up: list[int], i: int) -> int:
    while up[i] != i:
        up[i] = up[up[i]]
        i = up[i]
    return i


def _verify(percent: int, size: int):
    """Links of one tile: rows of one block of a cluster, or of two. Pairs that the links found so far connect are left out."""
    def run(pdf: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        uid, block = pdf["uid"].to_numpy(), pdf["block"].to_numpy()
        sig = pdf["sig"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(uid), _LONGS)
        bodies, sets = pdf["body"].to_pylist(), {}

        def of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(unpack(bodies[i]).lower().split(), size)
            return sets[i]
        one = np.flatnonzero(block == block.min())
        two = np.flatnonzero(block == block.max())
        similar = _estimates(sig[one], sig[two])
        if block.min() == block.max():
            similar[np.tril_indices(len(one))] = -1
        i, j = np.nonzero(similar >= percent / 100 - MARGIN)
        order = np.argsort(-similar[i, j], kind="stable")
        up, links = list(range(len(uid))), []
        for x, y in zip(one[i[order]].tolist(), two[j[order]].tolist(), strict=True):
            if _root(up, x) != _root(up, y):
                a, b = of(x), of(y)
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    up[_root(up, x)] = _root(up, y)
                    links.append((uid[x], uid[y]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return run


def meetings(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of nodes (uid, sig, bands): (key, uid, b), the members of each bucket that holds several, with its smallest; and (a, b, near), each
    member and the smallest it meets anywhere, and whether the two look alike. Both stored."""
    keyed = nodes.select("uid", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("uid").alias("b"), F.max("uid").alias("most")).where("b <> most").drop("most")
    members = stored(keyed.join(shared, "key"), "bucket-members")
    met = members.where("uid <> b").select(F.col("uid").alias("a"), "b").distinct()
    sigs = nodes.select("uid", "sig")
    both = (met.join(sigs.select(F.col("uid").alias("a"), F.col("sig").alias("sa")), "a")
            .join(sigs.select(F.col("uid").alias("b"), F.col("sig").alias("sb")), "b"))
    return members, stored(both.select("a", "b", (estimate("sa", "sb") >= NEAR).alias("near")), "met")


def _meet(percent: int):
    """Edges of one tile of a bucket that join its clusters: pairs of different clusters with a high enough estimate."""
    def run(pdf: pa.Table) -> pa.Table:
        uid, block = pdf["uid"].to_numpy(), pdf["block"].to_numpy()
        sig = pdf["sig"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(uid), _LONGS)
        names, cluster = np.unique(pdf["cluster"].to_numpy(), return_inverse=True)
        one, two = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
        up, links = list(range(len(names))), []
        for at in range(0, len(one), 128):
            rows = one[at:at + 128]
            i, j = np.nonzero((_estimates(sig[rows], sig[two]) >= percent / 100 - MARGIN) & (cluster[rows][:, None] != cluster[two][None, :]))
            for x, y in zip(rows[i].tolist(), two[j].tolist(), strict=True):
                a, b = _root(up, cluster[x]), _root(up, cluster[y])
                if a != b:
                    up[a] = b
                    links.append((uid[x], uid[y]))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})
    return run


def clustered(nodes: DataFrame, percent: int, block: int) -> DataFrame:
    """node, component: clusters such that two nodes that share a bucket and look alike are always in the same one."""
    members, met = meetings(nodes)
    stars = stored(components(met.where("near").select("a", "b")), "star-clusters")
    # The smallest of a bucket has met all others. Where it looked unlike one that no other link brought into its cluster, the
    # bucket is open: its other members are compared with each other.
    of = [stars.select(F.col("node").alias(c), F.col("component").alias(f"c{c}")) for c in ("a", "b")]
    apart = met.where("not near").join(of[0], "a", "left").join(of[1], "b", "left").where(
        F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(F.col("a").alias("uid"), "b")
    open_ = members.join(apart, ["uid", "b"], "left_semi").select("key").distinct()
    left = stored(members.join(open_, "key", "left_semi").where("uid <> b"), "open-members")
    sizes = stored(left.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "open-buckets")
    left = left.join(sizes, "key").join(of[0].toDF("uid", "cluster"), "uid", "left").select(
        F.col("key").alias("component"), "uid", F.coalesce("cluster", "uid").alias("cluster"), F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = _dealt(left, "cluster")
    links = dealt.join(nodes.select("uid", "sig"), "uid").groupBy("tile").applyInArrow(_meet(percent), "a long, b long")
    edges = stars.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    return components(edges.unionByName(links))


def _dealt(rows: DataFrame, *more: str) -> DataFrame:
    """uid, block, tile, more: each row (component, uid, blocks) in every tile of its component that holds its block."""
    # Nodes are dealt to blocks at random, so the tiles of a component are even.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return (rows.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
            .select("uid", "component", "block", *more, other)
            .select("uid", "block", F.xxhash64("component", F.least("block", "other"), F.greatest("block", "other")).alias("tile"), *more))


def tiles(clusters: DataFrame, block: int) -> DataFrame:
    """uid, tile, block: each node of `clusters` (node, component) in every tile of its cluster that holds its block."""
    sizes = clusters.groupBy("component").agg(F.count("*").alias("n"))
    return _dealt(clusters.join(sizes, "component").select(
        "component", F.col("node").alias("uid"), F.ceil(F.col("n") / block).cast("int").alias("blocks")))


def sign(docs: DataFrame, id_col: str, text_col: str, size: int, carry: Column | None = None) -> DataFrame:
    """SIGNED rows of `docs`, stored, with a number `uid` each and, if wanted, a column `carried`."""
    carried = [] if carry is None else [carry.alias("carried")]
    plain = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        text_of(text_col).alias("text"), *carried)
    schema = T.StructType([*T.StructType.fromDDL(SIGNED).fields, *plain.schema.fields[3:]])
    return stored(plain.mapInArrow(_sign(size), schema), "signed")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                    size: int = WORDS, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, group, uid: one row per row of `docs`.

    A document's set holds the distinct `size`-word shingles of its text (ASCII letters lower-cased, words split at ASCII
    white space); a shorter text is one shingle. Documents are linked from `percent` % similarity of their sets on, and
    component_id is the smallest id that links reach. Texts without words, NULL included, have an empty set and are linked
    with nothing. kept: doc_id = component_id. A row without an id belongs to its component and is kept only if no row of
    it has an id; rows that repeat an id are documents of their own. An empty table gives an empty result; other columns
    are ignored, whatever their names. uid tells rows apart, and group components."""
    return groups(sign(docs, id_col, text_col, size), percent, size, block)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        texts = [unpack(b).decode() for b in batch.column("body").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column("carried")], names=["text", "carried"])


def one_of_each(docs: DataFrame, carry: Column, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                size: int = WORDS, block: int = BLOCK) -> DataFrame:
    """text and `carried`, what `carry` is for the row, of one row of each group: that with the smallest id. Texts without
    words are groups of their own."""
    signed = sign(docs, id_col, text_col, size, carry)
    found = groups(signed, percent, size, block)
    first = found.groupBy("group").agg(F.min_by("uid", F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("uid"))
    kept = signed.select("uid", "body", "carried").join(first.select("uid"), "uid", "left_semi").select("body", "carried")
    return kept.mapInArrow(_texts, T.StructType([T.StructField("text", T.StringType()), signed.schema["carried"]]))


def groups(signed: DataFrame, percent: int, size: int, block: int) -> DataFrame:
    """What near_duplicates returns, from signed documents."""
    classes = (signed.where("n_shingles > 0").groupBy("h1", "h2")
               .agg(F.min("uid").alias("node"), F.min("doc_id").alias("least")))
    classes = stored(classes, "classes")
    nodes = signed.select("uid", "sig", "bands").join(classes.select(F.col("node").alias("uid")), "uid")
    nodes = stored(nodes, "nodes")
    clusters = clustered(nodes, percent, BUCKET_BLOCK)
    dealt = stored(tiles(clusters, block), "tiles")
    members = (dealt.join(nodes.select("uid", "sig"), "uid")
               .join(signed.select("uid", "body").join(clusters.select(F.col("node").alias("uid")), "uid"), "uid"))
    links = members.groupBy("tile").applyInArrow(_verify(percent, size), "a long, b long")
    linked_nodes = components(links)
    named = classes.join(linked_nodes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select("h1", "h2", "component_id", F.col("component").alias("group"))
    rows = signed.select("uid", "doc_id", "n_shingles", "h1", "h2")
    linked = rows.where("n_shingles > 0").join(named, ["h1", "h2"])
    alone = rows.where("n_shingles = 0").withColumns({"component_id": F.col("doc_id"), "group": F.col("uid")})
    return (linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select("doc_id", "n_shingles", "component_id", "kept", "group", "uid"))
