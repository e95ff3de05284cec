"""Farthest pairs and mean distances of points in many dimensions: few rows travel, products agree with differences."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import distance as D
from tessera.plans import blocks as B
from tessera.plans import kernels as K
from tessera.plans import pairs as P


def frame(spark, X):
    return spark.createDataFrame(list(enumerate(np.asarray(X, float).tolist())), "id long, v array<double>")


def sphere(n, dim, seed):
    X = np.random.default_rng(seed).normal(size=(n, dim))
    return X / np.linalg.norm(X, axis=1, keepdims=True)


def test_boxes_that_tell_nothing_move_a_point_once_to_each_band(spark):
    n, X = 1500, sphere(1500, 24, 4)
    sq = ((X[:, None] - X[None]) ** 2).sum(axis=2)
    a, b = np.unravel_index(np.argmax(np.triu(sq)), sq.shape)
    with P.PairIndex(frame(spark, X).repartition(3), blocks=64) as index:
        assert index.farthest()[1:] == (a, b)
        first, jobs = index.compared, index.jobs
        # 64 blocks: not once to each of them
        assert len(index.subs) < 16 and index.moved < 3 * n * len(index.subs)
        index.use(int(a), int(b))
        sq[[a, b]] = sq[:, [a, b]] = 0
        assert index.farthest()[1:] == np.unravel_index(np.argmax(np.triu(sq)), sq.shape)
        # what was compared below the best is known: only pairs of blocks that lost their ends are opened again
        assert index.compared - first < first / 4 and index.jobs - jobs <= 4


def test_farthest_by_products_is_that_by_differences():
    ids = np.arange(200)[::-1]
    for X in (1e7 + sphere(200, 12, 1), np.repeat(sphere(4, 12, 2), 50, axis=0), np.full((200, 3), 5.0), 1e-160 * sphere(200, 9, 3), 1e200 * sphere(200, 3, 3)):
        with np.errstate(over="ignore"):
            sq = K.sq_dists(X, X)
            low, high = np.minimum(ids[:, None], ids), np.maximum(ids[:, None], ids)
            i, j = np.nonzero((sq == sq[np.triu_indices(200, 1)].max()) & (low < high))
            got = P.farthest_of(X, ids, X, ids, True, X[0])
        assert got[0] == sq[i[0], j[0]] and got[1:] == min(zip(low[i, j], high[i, j]))


@pytest.mark.parametrize("metric", ["euclidean", "sq_drop_last", "euclidean_2d"])
@pytest.mark.parametrize("shape", ["sphere", "far", "copies", "huge"])
def test_sums_by_products(monkeypatch, metric, shape):
    monkeypatch.setattr(B, "PRODUCT_TILE", (16, 32))
    X = {"sphere": sphere(90, 20, 1), "far": 1e6 + sphere(90, 20, 1), "copies": np.repeat(sphere(30, 20, 1), 3, axis=0), "huge": 1e160 * sphere(90, 20, 1)}[shape]
    Y = X[40:] + (0 if shape == "copies" else 1e-9)
    with np.errstate(over="ignore"):
        for Z, diagonal in ((X, True), (Y, False)):
            sq = B._sq_dists(X, Z, metric)
            d = sq if metric == "sq_drop_last" else np.sqrt(sq)
            want = float(d[np.triu_indices(90, 1)].sum() if diagonal else d.sum())
            assert B.sum_of_distances(X, Z, diagonal, metric) == pytest.approx(want, rel=1e-9)


def test_block_pairs_are_dealt_one_by_one(spark):
    df = frame(spark, sphere(300, 5, 6))
    rows = B._block_rows(df, 9, "id", "v")
    held = rows.select("bi", "bj", F.spark_partition_id().alias("p")).distinct().groupBy("p").count().collect()
    assert sum(r["count"] for r in held) == 45 and max(r["count"] for r in held) == math.ceil(45 / len(held))
    out = D.avg_pairwise_distance(df, blocks=9)
    want = np.mean([math.dist(v, w) for v, w in itertools.combinations(sphere(300, 5, 6).tolist(), 2)])
    assert out.first()[0] == pytest.approx(want, rel=1e-12)
    pairs = B.block_pair_sums(df, blocks=9)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
