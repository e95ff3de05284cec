"""Lloyd rounds with carried bounds: the same centres as plain rounds, with fewer comparisons."""

import random

import numpy as np
import pytest

from tessera.operators import kmedian as KM
from tessera.plans import kernels as K
from tessera.plans.cells import CentreCells


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<double>, w double")


def clouds(dim, n, seed, spots=6, spread=1.0, ties=False):
    rng = random.Random(seed)
    at = [[rng.uniform(-20, 20) for _ in range(dim)] for _ in range(spots)]
    rows = []
    for i in range(n):
        v = [x + rng.gauss(0, spread) for x in rng.choice(at)]
        rows.append((i, [float(round(x)) for x in v] if ties else v, float(1 + i % 3)))
    return rows


def same(a, b):
    assert a.keys() == b.keys()
    for s in a:
        np.testing.assert_allclose(np.array(a[s]), np.array(b[s]), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("dim,ties,shards", [(2, True, None), (3, False, 3), (12, False, None)])
def test_the_same_centres(spark, dim, ties, shards):
    rows = clouds(dim, 900, dim, spread=6.0, ties=ties)
    pts = KM.prepare(frame(spark, rows), shards, "w")
    centers = {s: [v for i, v, _ in rows if i % (shards or 1) == s][:7] for s in range(shards or 1)}
    plain, carried = {}, {}
    same(KM.lloyd(pts, centers, dim, 7, bool(shards), carry=True, stats=carried),
         KM.lloyd(pts, centers, dim, 7, bool(shards), stats=plain))
    assert {k: n for k, (_, n) in carried["sizes"].items()} == {k: n for k, (_, n) in plain["sizes"].items()}
    assert len(carried["compared"]) == 7


def test_bounds_save_comparisons_and_are_renewed(spark, monkeypatch):
    from tessera.plans import bounds as B
    rows = clouds(2, 3000, 4, spread=0.5)
    df = frame(spark, rows)
    for renew in (0.25, 0.0):
        monkeypatch.setattr(B, "RENEW", renew)
        stats = {}
        got = KM.kmedian_cluster(df, 6, 8, 42, w_col="w", carry=True, stats=stats)
        same(got, KM.kmedian_cluster(df, 6, 8, 42, w_col="w"))
        assert stats["compared"][0] == 3000 and sum(stats["compared"][1:]) < 0.3 * 7 * 3000


def test_empty_clusters_one_centre_and_no_points(spark):
    rows = clouds(2, 60, 1)
    pts = KM.prepare(frame(spark, rows), None, "w")
    far = {0: [rows[0][1], [1e6, 1e6], rows[0][1]]}
    stats = {}
    got = KM.lloyd(pts, far, 2, 3, carry=True, stats=stats)
    same(got, KM.lloyd(pts, far, 2, 3))
    assert got[0][1] == [1e6, 1e6] and (0, 1) not in stats["sizes"]
    same(KM.lloyd(pts, {0: [[0.0, 0.0]]}, 2, 2, carry=True), KM.lloyd(pts, {0: [[0.0, 0.0]]}, 2, 2))
    assert KM.lloyd(pts.limit(0), {0: [[0.0, 0.0]]}, 2, 2, carry=True) == {0: [[0.0, 0.0]]}
    # a shard without centres has no part in the sums
    two = KM.prepare(frame(spark, rows), 2, "w")
    same(KM.lloyd(two, {0: [[0.0, 0.0], [5.0, 5.0]]}, 2, 3, True, carry=True), KM.lloyd(two, {0: [[0.0, 0.0], [5.0, 5.0]]}, 2, 3, True))


def test_two_nearest_of_many():
    rng = np.random.default_rng(2)
    C, X = np.round(rng.normal(size=(900, 3)) * 5), np.round(rng.normal(size=(200, 3)) * 5)
    best, at, second = CentreCells(C, "euclidean", K.sq_dists).nearest_two(X, 64)
    sq = K.sq_dists(X, C)
    assert (at == sq.argmin(axis=1)).all() and (best == sq.min(axis=1)).all() and (second == np.partition(sq, 1, axis=1)[:, 1]).all()
