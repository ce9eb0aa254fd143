"""Hard negatives by a multiway hyperplane tree with distance ranges.

A row's score for an anchor is the inner product of their integer vectors. For each
anchor and each of its positives (the best rows of its label) the best rows of other
labels whose score lies in a window below the positive's score are returned.

**Metric.** Every vector gets one more coordinate that brings it to the length of the
longest, the anchor's being 0. Then the score fixes the angle between anchor and row,
angles are a metric, and a window of scores is an annulus of angles around the anchor.

**Tree.** A node holds up to ``DEGREE`` split points; a row belongs to the nearest
(hyperplanes between split points part the children). Each split point stores the least
and greatest angle to the rows of each sibling's subtree. With the anchor's angle to the
split point, the triangle inequality says which angles rows in the annulus may have; a
sibling whose range does not meet them is eliminated. Leaves are scored exactly, so
elimination never changes a result; how much it saves depends on the data (vectors
without clusters leave all ranges wide).

**Jobs.** Split points come from a sample of at most ``SAMPLE`` rows or
``SAMPLE_BYTES`` (the only sample); all rows are routed to leaves and stored ordered by
leaf (a large leaf is parted by id); the ranges are aggregated over all rows, their
number bounded by the tree. Anchors go through in blocks of about ``ANCHORS``, one block
after the other: a block's vectors travel to all tasks, which keep the best rows of each
anchor, first of the same label, then of others within the windows; what is shuffled is a few
rows for each anchor and task. More anchors are more blocks; no group is gathered.

Defined cases: rows whose id, label or vector is null, or whose vector holds a null or
non-finite component, take no part, nor do vectors whose squared integer length reaches
2**53 (scores could be inexact); an id held by several usable rows counts once, with the
smallest label and, of these, vector; vectors of different lengths are never compared;
empty vectors score 0 with each other; ties go to the smaller id; zero or negative
positives have the windows that the inequality gives (negative ones none); extra
columns, whatever their names, are ignored; an empty table gives no rows.
"""
from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings_lake.llm.common import Shared, shared_dir, stored

SAMPLE, SAMPLE_BYTES = 4096, 32 << 20
DEGREE, LEAF_SAMPLES, DEPTH = 12, 48, 6
ANCHORS, ANCHOR_BYTES = 8192, 32 << 20
CELLS = 1 << 20  # anchor-row pairs scored at a time
SLACK = 1e-6  # more than the rounding of any angle


def usable_rows(embeddings: DataFrame, scale: int) -> DataFrame:
    """``vec_id, label, q`` (``floor(scale * x)`` of each component), one row an id."""
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < float("inf"), F.lit(False)))
    scaled = F.transform("embedding", lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = rows.select("vec_id", "label", scaled.alias("q"))
    exact = F.aggregate("q", F.lit(0.0), lambda s, v: s + v * v) < float(2**53)
    once = rows.filter(exact).groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("r"))
    return once.select("vec_id", "r.label", "r.q")


def by_width(batch) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(row numbers, matrix)`` of each vector length in an Arrow batch."""
    column = batch.column(batch.schema.names.index("q"))
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(size) - size
    return [(rows, values[begin[rows][:, None] + np.arange(d)])
            for d in np.unique(size) for rows in (np.flatnonzero(size == d),)]


class Node:
    def __init__(self, splits: np.ndarray, children: list):
        self.splits, self.children = splits, children  # a child is a Node or a leaf number
        k = len(splits)
        self.low, self.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)


class Tree:
    """The splits for vectors of one length, from sampled vectors; ranges follow."""

    def __init__(self, sample: np.ndarray, longest: float):
        self.longest = max(float(longest), 1.0)  # greatest squared length of all rows
        self.nodes: list[Node] = []
        self.leaves = 0
        self.root = self._build(self.lifted(sample), 0)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors: with the coordinate that brings all rows to one length."""
        rest = np.sqrt(np.maximum(self.longest - (x**2).sum(1), 0))
        return np.concatenate([x, rest[:, None]], 1) / np.sqrt(self.longest)

    def _build(self, x: np.ndarray, depth: int):
        if len(x) <= LEAF_SAMPLES or depth == DEPTH or (x == x[0]).all():
            self.leaves += 1
            return self.leaves - 1
        chosen, nearest = [0], x @ x[0]
        while len(chosen) < DEGREE:  # each split point is the one farthest from those before
            far = int(nearest.argmin())
            if nearest[far] > 1 - 1e-9:
                break
            chosen.append(far)
            nearest = np.maximum(nearest, x @ x[far])
        if len(chosen) == 1:
            self.leaves += 1
            return self.leaves - 1
        node = Node(x[chosen], [])
        self.nodes.append(node)
        owner = (x @ node.splits.T).argmax(1)
        node.children = [self._build(x[owner == j], depth + 1) for j in range(len(chosen))]
        return node

    def route(self, x: np.ndarray, ranges: bool = False) -> np.ndarray:
        """Each row's leaf; with ``ranges`` every node on its way widens its ranges."""
        leaf, x = np.zeros(len(x), np.int64), self.lifted(x)
        todo = [(self.root, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not isinstance(node, Node):
                leaf[rows] = node
                continue
            near = x[rows] @ node.splits.T
            owner = near.argmax(1)
            for j, child in enumerate(node.children):
                mine = owner == j
                if mine.any():
                    if ranges:
                        angle = np.arccos(np.clip(near[mine], -1, 1))
                        node.low[:, j] = np.minimum(node.low[:, j], angle.min(0))
                        node.high[:, j] = np.maximum(node.high[:, j], angle.max(0))
                    todo.append((child, rows[mine]))
        return leaf

    def alive(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """(anchors, leaves): whether a leaf may hold a row whose score lies between
        ``low`` and ``high``, both (anchors, windows); a window of low > high is empty."""
        out = np.zeros((len(anchors), self.leaves), bool)
        length = np.sqrt((anchors**2).sum(1) * self.longest)
        some = (low <= high).any(1)
        zero = length == 0
        out[zero & some] = True  # no direction: nothing can be said
        todo = [(self.root, np.flatnonzero(some & ~zero))]
        safe = np.where(zero, 1, length)[:, None]
        with np.errstate(invalid="ignore"):
            near, far = (np.arccos(np.clip(s / safe, -1, 1)) for s in (high, low))
        near, far = np.where(low <= high, near, np.inf), np.where(low <= high, far, -np.inf)
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not isinstance(node, Node):
                out[rows, node] = True
                continue
            splits = node.splits[:, :-1] * np.sqrt(self.longest)
            angle = np.arccos(np.clip(anchors[rows] @ splits.T / length[rows][:, None], -1, 1))
            keep = np.zeros((len(rows), len(node.children)), bool)
            for w in range(low.shape[1]):
                t1, t2 = near[rows, w][:, None], far[rows, w][:, None]
                least = np.maximum(np.maximum(angle - t2, t1 - angle), 0) - SLACK
                most = np.minimum(angle + t2, 2 * np.pi - angle - t1) + SLACK
                meets = (node.high[None] >= least[:, :, None]) & (node.low[None] <= most[:, :, None])
                keep |= meets.all(1) & (t1 <= t2)
            for j, child in enumerate(node.children):
                todo.append((child, rows[keep[:, j]]))
        return out


class Best:
    """The ``k`` best rows found so far of each slot (an anchor's window): the highest
    scores, ties to smaller ids."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low.astype(float), high.astype(float), k  # (anchors, windows)
        self.bound = self.low.copy()
        self.slot, self.id, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, anchors: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` (len(anchors), len(ids)); -inf where a pair does not count."""
        windows = self.low.shape[1]
        new = []
        for w in range(windows):
            bound, high = self.bound[anchors, w][:, None], self.high[anchors, w][:, None]
            fits = (scores >= bound) & (scores <= high) & (scores > -np.inf)
            many = np.flatnonzero(fits.sum(1) > self.k)
            if len(many):
                inside = np.where(fits[many], scores[many], -np.inf)
                kth = np.partition(inside, inside.shape[1] - self.k, axis=1)[:, -self.k]
                fits[many] &= scores[many] >= kth[:, None]
            a, r = np.nonzero(fits)
            if len(a):
                new.append((anchors[a] * windows + w, ids[r], scores[a, r]))
        if not new:
            return
        slot, i, s = (np.concatenate([old, *[n[c] for n in new]]) for c, old in enumerate((self.slot, self.id, self.score)))
        order = np.lexsort((i, -s, slot))
        slot, i, s = slot[order], i[order], s[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        kept = rank < self.k
        self.slot, self.id, self.score = slot[kept], i[kept], s[kept]
        last = rank == self.k - 1
        self.bound[slot[last] // windows, slot[last] % windows] = s[last]


class Block:
    """Anchors of one vector length, and the scores each may still use."""

    def __init__(self, ids, labels, x, tree: Tree | None, low, high, same: bool, k: int):
        self.ids, self.labels, self.x, self.low, self.high, self.same, self.k = ids, labels, x, low, high, same, k
        self.alive = np.ones((len(ids), 1), bool) if tree is None else tree.alive(x, low, high)


def _search(rows: DataFrame, blocks: dict[int, Block], compared) -> tuple[DataFrame, Shared]:
    """Best rows of every slot, for each task: ``width, slot, vec_id, score``; and the
    broadcast to give up once they are read."""
    shared = Shared(rows.sparkSession, blocks)

    def run(batches):
        import pyarrow as pa

        asked, best = shared.value, {}
        for batch in batches:
            ids, labels, leaves = (batch.column(batch.schema.names.index(c)).to_numpy(zero_copy_only=False) for c in ("vec_id", "label", "leaf"))
            for which, x in by_width(batch):
                block = asked.get(x.shape[1])
                if block is None:
                    continue
                found = best.setdefault(x.shape[1], Best(block.low, block.high, block.k))
                order = np.argsort(leaves[which], kind="stable")
                which, x = which[order], x[order]
                cut = np.flatnonzero(np.diff(leaves[which])) + 1
                for lo, hi in zip([0, *cut.tolist()], [*cut.tolist(), len(which)]):
                    anchors = np.flatnonzero(block.alive[:, leaves[which[lo]]])
                    if not len(anchors):
                        continue
                    step = max(64, CELLS // len(anchors))
                    for p in range(lo, hi, step):
                        some = which[p:min(p + step, hi)]
                        scores = block.x[anchors] @ x[p:min(p + step, hi)].T
                        alike = block.labels[anchors][:, None] == labels[some][None, :]
                        counts = (alike if block.same else ~alike) & (block.ids[anchors][:, None] != ids[some][None, :])
                        scores[~counts] = -np.inf
                        compared.add(scores.size)
                        found.add(anchors, ids[some], scores)
        for width, found in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found.slot), width)), pa.array(found.slot), pa.array(found.id), pa.array(found.score.astype(np.int64))],
                names=["width", "slot", "vec_id", "score"])

    return rows.select("vec_id", "label", "leaf", "q").mapInArrow(run, "width long, slot long, vec_id long, score long"), shared


def _first(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("width", "slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)


def sample_rows(rows: DataFrame, size: int) -> list:
    """At most ``size`` rows, one of each hash cell; combined map-side."""
    h = F.xxhash64("vec_id")
    cells = rows.groupBy(F.pmod(h, F.lit(size)).alias("cell")).agg(
        F.min_by(F.struct("vec_id", "label", "q"), F.struct(F.xxhash64(h), F.col("vec_id"))).alias("r"))
    return [c["r"] for c in cells.select("r").collect()]


def build(rows: DataFrame) -> tuple[DataFrame, dict[int, Tree], list]:
    """Rows with their ``leaf``, stored in its order; the trees with their ranges; the sample."""
    widths = {r["width"]: r["longest"] for r in rows.groupBy(F.size("q").alias("width")).agg(
        F.max(F.aggregate("q", F.lit(0.0), lambda s, v: s + v * v)).alias("longest")).orderBy(F.desc(F.count(F.lit(1)))).limit(64).collect()}
    size = min(SAMPLE, max(64, SAMPLE_BYTES // (8 * max([1, *widths]))))
    sample = sample_rows(rows, size) if widths else []
    trees = {}
    for width, longest in widths.items():
        mine = np.array(sorted(r["q"] for r in sample if len(r["q"]) == width), float)
        if len(mine) and width:
            trees[width] = Tree(mine.reshape(len(mine), width), longest)
    shared = Shared(rows.sparkSession, trees)

    def route(batches):
        import pyarrow as pa

        known = shared.value
        for batch in batches:
            leaf = np.zeros(batch.num_rows, np.int64)
            for which, x in by_width(batch):
                if x.shape[1] in known:
                    leaf[which] = known[x.shape[1]].route(x)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])

    routed = rows.select("vec_id", "label", "q").mapInArrow(route, "vec_id long, label long, q array<double>, leaf long")
    index = stored(routed.repartitionByRange("leaf", "vec_id").sortWithinPartitions("leaf", "vec_id"), "hard-negative-index")

    def ranges(batches):
        import pyarrow as pa

        known = shared.value
        for batch in batches:
            for _, x in by_width(batch):
                if x.shape[1] in known:
                    known[x.shape[1]].route(x, ranges=True)
        out = [(w, n, i, j, node.low[i, j], node.high[i, j]) for w, t in known.items() for n, node in enumerate(t.nodes)
               for i in range(len(node.splits)) for j in range(len(node.splits)) if node.low[i, j] <= node.high[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 6, [pa.int64()] * 4 + [pa.float64()] * 2)],
            names=["width", "node", "i", "j", "low", "high"])

    seen = index.select("q").mapInArrow(ranges, "width long, node long, i long, j long, low double, high double")
    for r in seen.groupBy("width", "node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect():
        node = trees[r["width"]].nodes[r["node"]]
        node.low[r["i"], r["j"]], node.high[r["i"], r["j"]] = r["low"], r["high"]
    return index, trees, sample


def mine(embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80,
         high_percent: int = 100, scale: int = 256, anchors: int = ANCHORS, compared=None) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``embeddings`` holds ``vec_id, embedding, label``; ``is_anchor`` is a predicate on
    ``vec_id``. Negatives n of positive p satisfy ``low_percent * score(p) <= 100 *
    score(n) <= high_percent * score(p)``. ``compared``, an accumulator, counts the
    pairs scored.
    """
    spark = embeddings.sparkSession
    compared = spark.sparkContext.accumulator(0) if compared is None else compared
    rows = stored(usable_rows(embeddings, scale), "hard-negative-rows")
    index, trees, sample = build(rows)
    asked = index.filter(is_anchor)
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("q")), F.lit(1)).alias("width")).first()
    per_block = min(anchors, max(64, ANCHOR_BYTES // (8 * max(1, size["width"]))))
    n_blocks = max(1, -(-size["n"] // per_block))
    folder = f"{shared_dir(spark)}/hard-negatives-{uuid.uuid4().hex}"
    fields = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for b in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).select("vec_id", "label", "q").orderBy("vec_id").toArrow().combine_chunks()
        first = {}
        for batch in block.to_batches():
            ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            for which, x in by_width(batch):
                floor_ = _sampled_bound(ids[which], labels[which], x, sample, positives)
                first[x.shape[1]] = Block(ids[which], labels[which], x, trees.get(x.shape[1]), floor_[:, None],
                                          np.full((len(which), 1), np.inf), True, positives)
        found, shared = _search(index, first, compared)
        top = _first(found, positives).select("width", "slot", "rank", "vec_id", "score").toArrow()
        shared.packed.unpersist()
        asks, paired = {}, {}
        for width, f in first.items():
            got = top.filter(_equal(top.column("width"), width))
            slot, rank, score, ids = (got.column(c).to_numpy() for c in ("slot", "rank", "score", "vec_id"))
            low, high = np.ones((len(f.ids), positives)), np.zeros((len(f.ids), positives))
            low[slot, rank - 1] = -(-low_percent * score // 100)
            high[slot, rank - 1] = high_percent * score // 100
            asks[width] = Block(f.ids, f.labels, f.x, trees.get(width), low, high, False, negatives)
            paired[width] = f.ids[slot], ids, score, slot * positives + rank - 1
        pairs = [(int(w), int(s), int(a), int(p), int(v)) for w, (a_, p_, v_, s_) in paired.items() for a, p, v, s in zip(a_, p_, v_, s_)]
        named = spark.createDataFrame(pairs, "width long, slot long, anchor_id long, positive_id long, positive_score long")
        found, shared = _search(index, asks, compared)
        found = _first(found, negatives).join(named, ["width", "slot"])
        found.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                     F.col("score").alias("negative_score")).write.parquet(f"{folder}/{b}")
        shared.packed.unpersist()
    return spark.read.schema(fields).parquet(*[f"{folder}/{b}" for b in range(n_blocks)])


def _equal(column, value):
    import pyarrow.compute as pc

    return pc.equal(column, value)


def _sampled_bound(ids, labels, x, sample, k: int) -> np.ndarray:
    """A score that each anchor's ``k``-th best row of its label reaches at least,
    as the sampled rows show; -inf where they are too few."""
    mine = [r for r in sample if len(r["q"]) == x.shape[1]]
    out = np.full(len(ids), -np.inf)
    if len(mine) < k:
        return out
    s_ids, s_labels, s = np.array([r["vec_id"] for r in mine]), np.array([r["label"] for r in mine]), np.array([r["q"] for r in mine], float)
    for lo in range(0, len(ids), max(1, CELLS // len(mine))):
        part = slice(lo, lo + max(1, CELLS // len(mine)))
        scores = x[part] @ s.reshape(len(mine), x.shape[1]).T
        scores[(labels[part][:, None] != s_labels[None, :]) | (ids[part][:, None] == s_ids[None, :])] = -np.inf
        out[part] = np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
    return out


def brute_force(rows: list[tuple], is_anchor, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100) -> set[tuple]:
    """The same over ``(vec_id, label, integer vector)`` rows of distinct ids (tests)."""
    out = set()
    for a, label, x in rows:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, other, y in rows if i != a and len(x) == len(y))
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [(n, i) for n, i, other in scored if other != label and -low_percent * s <= -100 * n <= -high_percent * s]
            out |= {(a, p, k, i, -s, -n) for k, (n, i) in enumerate(fit[:negatives], 1)}
    return out
