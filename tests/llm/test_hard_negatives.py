"""Hard negatives: the tree's elimination and the mined rows against brute force."""
from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postings_lake.llm import hardneg

SCHEMA = "vec_id long, embedding array<double>, label int"


def clustered(n, d, clusters, spread, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, d))
    x = centre[rng.integers(0, clusters, n)] + spread * rng.normal(size=(n, d))
    return [(i, [float(v) for v in x[i] / 4], int(rng.integers(0, 3))) for i in range(n)]


def scaled(rows):
    return [(i, label, [int(np.floor(256 * v)) for v in x]) for i, x, label in rows]


def mined(df, every=10, **kw):
    return {tuple(r) for r in hardneg.mine(df, F.col("vec_id") % every == 0, **kw).collect()}


@pytest.mark.parametrize("anchors", [8192, 7])
def test_equals_brute_force_and_eliminates(spark, monkeypatch, anchors):
    monkeypatch.setattr(hardneg, "LEAF_SAMPLES", 8)
    rows = clustered(600, 8, 25, 0.05)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("clash")).withColumn("leaf", F.lit("clash")).repartition(4)
    compared = spark.sparkContext.accumulator(0)
    got = mined(df, anchors=anchors, compared=compared)
    want = hardneg.brute_force(scaled(rows), lambda i: i % 10 == 0)
    assert got == want and len(want) > 500
    assert compared.value < 0.6 * 2 * 60 * 600  # two searches of 60 anchors over 600 rows


def test_vectors_without_clusters_lose_nothing(spark):
    rng = np.random.default_rng(9)
    rows = [(i, [float(v) for v in rng.normal(size=16) / 4], int(rng.integers(0, 4))) for i in range(500)]
    want = hardneg.brute_force(scaled(rows), lambda i: i % 10 == 0)
    assert mined(spark.createDataFrame(rows, SCHEMA).repartition(3)) == want and want


def test_ties_repeats_and_unusable_rows(spark):
    rows = [(i, [1.0, 0.5, 0.0], i % 3) for i in range(60)] + [(100 + i, [0.9, 0.5, i / 50], i % 2) for i in range(40)]
    bad = [(200, None, 1), (210, [1.0, None, 1.0], 1), (220, [float("nan"), 1.0, 1.0], 0), (230, [float("inf"), 0.0, 0.0], 1),
           (240, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (250, [1e30, 0.0, 0.0], 1)]
    other = [(260, [1.0, 2.0], 1), (261, [1.0, 2.0], 1), (262, [1.0, 1.9], 0), (270, [], 1), (271, [], 1), (272, [], 2),
             (280, [0.0, 0.0, 0.0], 1), (290, [-1.0, -1.0, -1.0], 0)]
    repeats = [rows[0], rows[0], (10, [3.0, 0.0, 0.0], 2), (20, [1.0, 0.5, 0.0], 5)]  # the smallest usable row of an id counts
    df = spark.createDataFrame(rows + bad + other + repeats, SCHEMA).repartition(4)
    want = hardneg.brute_force(scaled(rows + other), lambda i: i % 10 == 0)
    assert mined(df) == want
    assert {r[0] for r in want} >= {0, 10, 20, 260, 270}


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (2, [0.9, 0.0], 2)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == {(0, 1, 1, 2, 65536, 58880)}
    assert mined(spark.createDataFrame(rows[:1], SCHEMA)) == set()
    assert mined(spark.createDataFrame([], SCHEMA)) == set()


def test_windows_are_parameters(spark):
    rows = clustered(200, 6, 5, 0.3)
    df = spark.createDataFrame(rows, SCHEMA)
    kw = dict(positives=2, negatives=3, low_percent=50, high_percent=110)
    assert mined(df, **kw) == hardneg.brute_force(scaled(rows), lambda i: i % 10 == 0, **kw)


def test_no_leaf_with_a_row_in_the_window_is_eliminated():
    rng = np.random.default_rng(5)
    for seed in range(6):
        x = np.floor(256 * (rng.normal(size=(8, 10))[rng.integers(0, 8, 900)] + 0.1 * rng.normal(size=(900, 10))))
        if seed == 5:
            x[:300] = x[0]  # a large group of copies
        longest = (x**2).sum(1).max()
        tree = hardneg.Tree(x[::3], longest)
        leaf = tree.route(x, ranges=True)
        assert tree.leaves > 1
        a = x[:60]
        scores = a @ x.T
        high = np.quantile(scores, [0.99, 0.5, 0.1], axis=1).T
        low = high * 0.9
        alive = tree.alive(a, low, high)
        inside = ((scores[:, :, None] >= low[:, None]) & (scores[:, :, None] <= high[:, None])).any(2)
        assert alive[np.nonzero(inside)[0], leaf[np.nonzero(inside)[1]]].all()
        top = np.partition(scores, -5, axis=1)[:, -5:-4]
        near = tree.alive(a, top, np.full_like(top, np.inf))
        assert near[np.nonzero(scores >= top)[0], leaf[np.nonzero(scores >= top)[1]]].all()
        assert near.mean() < 0.7  # clusters are told apart
