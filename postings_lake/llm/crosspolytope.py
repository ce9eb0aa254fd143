"""Approximate nearest neighbours by cross-polytope hashing.

Each table turns unit vectors by a fast pseudo-random rotation (three rounds of
random signs and a Hadamard transform) and assigns them to the nearest signed
axis, one bucket of 2 * dimension. A query probes the ``probes`` nearest axes of
each of ``tables`` tables; rows that share a probed bucket in any table are its
candidates and are ranked by their exact Euclidean distance.

Rows stay where they are: the queries of a block (at most about ``QUERY_BLOCK``)
and their probed buckets go to every task, which hashes its rows batch by batch,
keeps the best of each query, and emits these once, at its end. More queries are
more blocks. So no bucket is ever gathered, however many rows (or copies of one
vector) fall into it, and what is shuffled is k rows a query and task. Queries
that found fewer than ``k`` are searched again over all rows.

Defined cases: rows whose id or vector is null, empty, zero, or holds null or
non-finite components take no part; vectors of different lengths are never
compared; a repeated id counts once for a query (at its least distance), and as
a query with its smallest usable vector; ties go to the smaller id; no rows, no result;
extra columns, whatever their names, are ignored.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postings_lake.llm.common import Shared, stored

QUERY_BLOCK = 8192
CELLS = 1 << 21  # query-row pairs compared at a time


def vectors(ids, lists) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(ids, matrix)`` of each vector length among usable rows of Arrow columns."""
    size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten()
    holes = flat.is_null().to_numpy(zero_copy_only=False) if flat.null_count else None
    values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64)
    if holes is not None:
        values = np.where(holes, np.nan, values)
    begin = np.cumsum(size) - size
    usable = ids.is_valid().to_numpy(zero_copy_only=False) & (size > 0)
    numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(size[usable]):
        rows = np.flatnonzero(usable & (size == d))
        x = values[begin[rows][:, None] + np.arange(d)]
        good = np.isfinite(x).all(1) & (x != 0).any(1)
        if good.any():
            out.append((numbers[rows[good]], x[good]))
    return out


def hadamard(x: np.ndarray) -> np.ndarray:
    """Normalised Walsh-Hadamard transform of the rows (length a power of two)."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


class Rotations:
    """The tables' pseudo-rotations for one vector length."""

    def __init__(self, dimension: int, tables: int, seed: int = 7):
        self.width = max(2, 1 << (dimension - 1).bit_length())
        self.signs = np.random.default_rng([seed, dimension]).choice([-1.0, 1.0], (tables, 3, self.width))

    def __call__(self, x: np.ndarray):
        """Coordinates on signed axes, (rows, 2 * width), table by table."""
        x = x / np.abs(x).max(1, keepdims=True)  # keeps the next line from over- or underflow
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        x = np.pad(x, ((0, 0), (0, self.width - x.shape[1])))
        for signs in self.signs:
            r = x
            for s in signs:
                r = hadamard(r * s)
            yield np.concatenate([r, -r], 1)


class QueryBlock:
    """Queries of one length and the buckets they probe in each table."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, tables: int, probes: int):
        self.ids, self.x, self.rotations = ids, x, Rotations(x.shape[1], tables)
        self.probed = []
        for axes in self.rotations(x):
            hit = np.zeros(axes.shape, bool)
            near = np.argsort(-axes, axis=1, kind="stable")[:, :probes or axes.shape[1]]
            np.put_along_axis(hit, near, True, axis=1)
            self.probed.append(hit)
        self.everything = not probes


class Best:
    """The ``k`` nearest rows found so far for each query of a block."""

    def __init__(self, block: QueryBlock, k: int):
        self.block, self.k = block, k
        self.q, self.id, self.d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.bound = np.full(len(block.ids), np.inf)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        b = self.block
        step = max(64, CELLS // len(b.ids))
        for lo in range(0, len(ids), step):
            self._add(ids[lo:lo + step], x[lo:lo + step])

    def _kth(self, ids, square) -> np.ndarray:
        """Each query's ``k``-th least among the least squares of distinct ids."""
        order = np.argsort(ids, kind="stable")
        begin = np.flatnonzero(np.append(True, ids[order][1:] != ids[order][:-1]))
        if len(begin) < len(ids):
            square = np.minimum.reduceat(square[:, order], begin, axis=1)
        if len(begin) <= self.k:
            return np.full(len(square), np.inf)
        return np.partition(square, self.k - 1, axis=1)[:, self.k - 1]

    def _add(self, ids, x) -> None:
        b = self.block
        candidate = np.full((len(b.ids), len(ids)), b.everything)
        if not b.everything:
            for hit, axes in zip(b.probed, b.rotations(x)):
                candidate |= hit[:, axes.argmax(1)]
        candidate &= b.ids[:, None] != ids[None, :]
        square = (b.x**2).sum(1)[:, None] + (x**2).sum(1)[None, :] - 2 * (b.x @ x.T)
        slack = 1e-9 * ((b.x**2).sum(1) + (x**2).sum(1).max())  # rounding of the line above
        square[~candidate] = np.inf
        near = self._kth(ids, square)
        limit = np.minimum(self.bound**2, near) + slack
        qi, ri = np.nonzero((square <= limit[:, None]) & candidate)
        if not len(qi):
            return
        d = np.concatenate([np.sqrt(((x[ri[p:p + 65536]] - b.x[qi[p:p + 65536]]) ** 2).sum(1)) for p in range(0, len(qi), 65536)])
        q, i, d = np.concatenate([self.q, qi]), np.concatenate([self.id, ids[ri]]), np.concatenate([self.d, d])
        order = np.lexsort((d, i, q))  # a repeated id counts once
        q, i, d = q[order], i[order], d[order]
        once = np.ones(len(q), bool)
        once[1:] = (q[1:] != q[:-1]) | (i[1:] != i[:-1])
        q, i, d = q[once], i[once], d[once]
        order = np.lexsort((i, d, q))
        q, i, d = q[order], i[order], d[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        kept = rank < self.k
        self.q, self.id, self.d = q[kept], i[kept], d[kept]
        full = rank == self.k - 1
        self.bound[q[full]] = d[full]


def _search(rows: DataFrame, blocks: list[QueryBlock], k: int) -> tuple[DataFrame, Shared]:
    shared = Shared(rows.sparkSession, blocks)

    def run(batches):
        import pyarrow as pa

        best = {b.x.shape[1]: Best(b, k) for b in shared.value}
        for batch in batches:
            for ids, x in vectors(batch.column(0), batch.column(1)):
                if x.shape[1] in best:
                    best[x.shape[1]].add(ids, x)
        for b in best.values():
            yield pa.RecordBatch.from_arrays(
                [pa.array(b.block.ids[b.q]), pa.array(b.id), pa.array(b.d)], names=["query_id", "vec_id", "score"])

    return rows.mapInArrow(run, "query_id long, vec_id long, score double"), shared


def nearest(embeddings: DataFrame, is_query: Column, k: int = 10, tables: int = 16, probes: int = 8,
            query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the rows that ``is_query`` marks."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    usable = F.forall("embedding", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))) & F.exists("embedding", lambda v: v != 0)
    queries = rows.filter(is_query & F.col("vec_id").isNotNull() & usable)
    queries = queries.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))

    def top(found: DataFrame) -> DataFrame:
        once = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
        by = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return once.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)

    def search(asked: DataFrame, n: int, probes: int) -> DataFrame:
        n_blocks = max(1, -(-n // query_block))
        found = None
        for b in range(n_blocks):
            block = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b).orderBy("vec_id").toArrow().combine_chunks()
            ready = [] if not block.num_rows else [
                QueryBlock(ids, x, tables, probes)
                for ids, x in vectors(block.column("vec_id").chunk(0), block.column("embedding").chunk(0))]
            part, shared = _search(rows, ready, k)
            if n_blocks > 1:  # one block after the other: its queries then leave the tasks
                part = stored(part, "neighbours-of-block")
                shared.packed.unpersist()
            found = part if found is None else found.union(part)
        return top(found)

    first = stored(search(queries, queries.count(), probes), "neighbours")
    full = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"))
    short = queries.join(full, "vec_id", "left_anti")
    missing = short.count()
    if missing:
        again = search(short, missing, 0)
        first = first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(rows: list[tuple[int, list[float]]], every: int = 100, k: int = 10) -> dict[int, list[tuple[int, float]]]:
    """``query -> [(vec_id, distance)]`` over all rows (tests)."""
    good = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    return {q: sorted(((i, float(np.linalg.norm(x - y))) for i, y in good if i != q and len(x) == len(y)),
                      key=lambda p: (p[1], p[0]))[:k] for q, x in good if q % every == 0}
