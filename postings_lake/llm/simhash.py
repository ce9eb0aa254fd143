"""SimHash near-duplicates: fingerprints, vantage-point shards, components.

Fingerprint: A-Z lowered, words between ASCII white space, shingles of
``shingle`` words (repeats included), XXH64 with seed 42 of each; a bit is set
when more than half the hashes set it.

Search: two fingerprints within ``bits`` differing bits differ by at most
``bits // 2`` bits in one of their two halves. So each half is a metric space of
its own, searched with a small radius, where triangle bounds prune well. A
vantage-point tree over a bounded sample of fingerprints cuts each half-space
into shards of about ``SHARD`` members: a fingerprint lives in one shard and
also visits every shard that its ball reaches over a boundary. Inside a shard
the same recursion goes on down to small blocks, which are compared exactly on
all 64 bits. A shard emits a spanning forest of its links, never all pairs, and
large-star / small-star rounds join the forests to components.

Exact copies share a fingerprint, so only distinct fingerprints travel.

Defined cases: null, empty and wordless texts have fingerprint zero and link
like any other; rows with a null ``doc_id`` are linked but never name a
component, which is null if no member has an id; repeated rows keep their rows;
no rows, no result; extra columns, whatever their names, change nothing.
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings_lake.llm.common import Shared, aside, map_texts, stored
from postings_lake.llm.textarrays import strings

SHARD = 8192
HALVES = (np.uint64(0xFFFFFFFF00000000), np.uint64(0x00000000FFFFFFFF))


def fingerprint(raw: bytes, shingle: int, digest) -> int:
    """Signed 64-bit fingerprint of one text; ``digest`` is xxh64_intdigest."""
    words = raw.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words)) - 1
    spans = zip(starts[:len(words) - k].tolist(), ends[k:].tolist())
    hashes = np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 1 << 16):
        part = hashes[lo:lo + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprinter(shingle):
    from xxhash import xxh64_intdigest

    def run(batch):
        data, at = strings(batch.column("text"))
        return [[fingerprint(data[a:b].tobytes(), shingle, xxh64_intdigest) for a, b in zip(at, at[1:])]]

    return run


def fingerprints(documents: DataFrame, shingle: int = 3, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``fp`` (long, the 64 bits signed)."""
    return map_texts(documents, documents.columns if keep is None else keep, "fp long", _fingerprinter, (shingle,))


def distance(x: np.ndarray, y, mask) -> np.ndarray:
    return np.bitwise_count((x ^ y) & mask)


def split(x: np.ndarray, mask):
    """``(vantage, radius)`` that cuts ``x`` best in two by distance, or None."""
    best = None
    for v in x[np.linspace(0, len(x) - 1, min(4, len(x))).astype(np.int64)]:
        d = distance(x, v, mask)
        for mu in {int(np.median(d)), int(np.median(d)) - 1}:
            inside = int((d <= mu).sum())
            if 0 < inside < len(x) and (best is None or abs(2 * inside - len(x)) < best[0]):
                best = (abs(2 * inside - len(x)), v, mu)
    return best and best[1:]


class ShardTree:
    """Vantage-point tree over a sample; its leaves are shards."""

    def __init__(self, sample: np.ndarray, mask, leaves: int):
        self.mask, self.nodes, self.shards = mask, [], 0
        self._build(sample, max(1, math.ceil(len(sample) / leaves)))

    def _build(self, x: np.ndarray, size: int) -> int:
        cut = split(x, self.mask) if len(x) > size else None
        here = len(self.nodes)
        if cut is None:
            self.nodes.append((self.shards,))
            self.shards += 1
            return here
        self.nodes.append(None)
        inside = distance(x, cut[0], self.mask) <= cut[1]
        self.nodes[here] = (*cut, self._build(x[inside], size), self._build(x[~inside], size))
        return here

    def route(self, x: np.ndarray, radius: int):
        """Yields ``(shard, rows, at home)`` for all shards that x's balls reach."""
        todo = [(0, np.arange(len(x)), np.ones(len(x), bool))]
        while todo:
            node, rows, home = todo.pop()
            if not len(rows):
                continue
            if len(self.nodes[node]) == 1:
                yield self.nodes[node][0], rows, home
                continue
            v, mu, inner, outer = self.nodes[node]
            d = distance(x[rows], v, self.mask).astype(np.int64)
            near, far = d - radius <= mu, d + radius > mu
            todo += [(inner, rows[near], home[near] & (d[near] <= mu)), (outer, rows[far], home[far] & (d[far] > mu))]


class Forest:
    """Union-find on arrays; parents are kept one step from their roots."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.parent[a], self.parent[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.parent, np.maximum(ra, rb), np.minimum(ra, rb))
            while ((up := self.parent[self.parent]) != self.parent).any():
                self.parent = up


def local_links(x: np.ndarray, home: np.ndarray, mask, radius: int, bits: int) -> np.ndarray:
    """Root (an index) of each member after linking ``x`` with its home members."""
    forest = Forest(len(x))
    todo = [(np.flatnonzero(home), np.arange(len(x)))]
    pending, waiting = [], 0
    while todo:
        members, seekers = todo.pop()
        if not len(members) or not len(seekers):
            continue
        cut = split(x[members], mask) if len(members) * len(seekers) > 1 << 14 else None
        if cut:
            dm = distance(x[members], cut[0], mask).astype(np.int64)
            ds = distance(x[seekers], cut[0], mask).astype(np.int64)
            todo.append((members[dm <= cut[1]], seekers[ds - radius <= cut[1]]))
            todo.append((members[dm > cut[1]], seekers[ds + radius > cut[1]]))
            continue
        step = max(1, (1 << 18) // len(members))
        for lo in range(0, len(seekers), step):
            some = seekers[lo:lo + step]
            i, j = np.nonzero(np.bitwise_count(x[some][:, None] ^ x[members][None, :]) <= bits)
            a, b = some[i], members[j]
            apart = forest.parent[a] != forest.parent[b]
            if apart.any():
                pending.append((a[apart], b[apart]))
                waiting += int(apart.sum())
            if waiting > 1 << 18:
                forest.unite(*(np.concatenate(p) for p in zip(*pending)))
                pending, waiting = [], 0
    if pending:
        forest.unite(*(np.concatenate(p) for p in zip(*pending)))
    return forest.parent


def shard_links(distinct: DataFrame, bits: int, shard: int = SHARD) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp``: every pair within
    ``bits`` is connected by them, inside at least one shard."""
    spark = distinct.sparkSession
    n = distinct.count()
    leaves = max(1, math.ceil(n / shard))
    sample = [r[0] for r in distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(min(1 << 17, 64 * leaves)).collect()]
    sample = np.array(sample, np.int64).view(np.uint64)
    trees = [ShardTree(sample, mask, leaves) for mask in HALVES]
    shared, radius = Shared(spark, trees), bits // 2

    def deal(batches):
        import pyarrow as pa

        trees = shared.value
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            for half, tree in enumerate(trees):
                for s, rows, home in tree.route(fp.view(np.uint64), radius):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), 2 * s + half)), pa.array(fp[rows]), pa.array(home)],
                        names=["shard", "fp", "home"])

    def link(table):
        import pyarrow as pa

        fp, half = table.column("fp").to_numpy(), table.column("shard")[0].as_py() % 2
        root = local_links(fp.view(np.uint64), table.column("home").to_numpy(), HALVES[half], radius, bits)
        moved = np.flatnonzero(root != np.arange(len(root)))
        return pa.table({"a": fp[moved], "b": fp[root[moved]]})

    dealt = distinct.select("fp").mapInArrow(deal, "shard long, fp long, home boolean")
    return dealt.groupBy("shard").applyInArrow(link, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links (a, b)``; a root names itself.

    Large-star and small-star rounds until every node hangs on its root; each
    round is written to the shared folder.
    """
    def larger_first(df):
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()

    edges = stored(larger_first(links), "links")
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = larger_first(large)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        edges = stored(larger_first(small), "links")
        flat = edges.groupBy("a").count().filter("count > 1").isEmpty()
        if flat and edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b"), F.col("b")).distinct())


def component_of(fps: DataFrame, bits: int, shard: int = SHARD) -> DataFrame:
    """``(fp, component_id)`` of every distinct fingerprint of ``fps (doc_id, fp)``."""
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(shard_links(distinct, bits, shard))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return placed.join(named, "root").select("fp", "component_id")


def near_duplicates(documents: DataFrame, shingle: int = 3, bits: int = 3, shard: int = SHARD) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id``, the smallest ``doc_id`` reachable
    over links of at most ``bits`` bits, of every row."""
    fps = stored(fingerprints(documents, shingle, ["doc_id"]), "fingerprints")
    return fps.join(component_of(fps, bits, shard), "fp").select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame, shingle: int = 3, bits: int = 3, shard: int = SHARD) -> DataFrame:
    """``documents`` with one row of each component: that of its smallest
    ``doc_id``. Where no member has an id, one row of each fingerprint stays; of
    rows that repeat the id, the smallest by its columns."""
    packed, unpack = aside(documents)
    rows = stored(fingerprints(packed.withColumn("__id", F.coalesce("__doc_id", F.lit(-2**63))), shingle), "fingerprints")
    fps = rows.select(F.col("__doc_id").alias("doc_id"), "fp")
    first = fps.distinct().join(component_of(fps, bits, shard), "fp").filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.select(F.coalesce("doc_id", F.lit(-2**63)).alias("__id"), "fp")
    kept = rows.join(first, ["__id", "fp"], "left_semi")
    value = F.struct(*[c for c in kept.columns if c not in ("__id", "fp")])
    return unpack(kept.groupBy("__id", "fp").agg(F.min(value).alias("row")).select("row.*"))


def brute_force(rows: list[tuple], shingle: int = 3, bits: int = 3) -> dict:
    """``doc_id -> (fingerprint hex, component)`` by comparing all pairs (tests)."""
    from xxhash import xxh64_intdigest

    ids = [i for i, _ in rows]
    fps = [fingerprint((t or "").encode("utf-8", "surrogatepass"), shingle, xxh64_intdigest) % 2**64 for _, t in rows]
    label = dict(enumerate(ids))
    changed = True
    near = [[j for j in range(len(ids)) if (fps[i] ^ fps[j]).bit_count() <= bits] for i in range(len(ids))]
    while changed:
        changed = False
        for i, js in enumerate(near):
            low = min(label[j] for j in js)
            changed |= low < label[i]
            label[i] = low
    return {ids[i]: (f"{fps[i]:016x}", label[i]) for i in range(len(ids))}
