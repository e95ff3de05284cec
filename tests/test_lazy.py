"""Centres by lazily opened blocks, and the search for the nearest of many centres: equal to the plain rounds and kernels."""

import random

import numpy as np
import pytest

from tessera.operators import kcenter as KC
from tessera.operators import kmedian as KM
from tessera.plans import kernels as K
from tessera.plans.cells import CentreCells


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<double>")


def clouds(dim, n, seed, ties=False):
    rng = random.Random(seed)
    spots = [[rng.uniform(-50, 50) for _ in range(dim)] for _ in range(8)]
    return [(7 * i + 2, [float(round(x + rng.gauss(0, 2)) if ties else x + rng.gauss(0, 2)) for x in rng.choice(spots)]) for i in range(n)]


def plain(rows, k, metric="euclidean"):
    """Farthest-first centres of all rows, one after the other."""
    ids, X = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    at = int(np.argmin(ids))
    out, d = [int(ids[at])], np.full(len(rows), np.inf)
    while len(out) < k:
        d = np.minimum(d, K.metric_value(K.sq_dists(X, X[at:at + 1], metric)[:, 0], metric))
        if d.max() <= 0:
            break
        top = np.flatnonzero(d == d.max())
        at = int(top[np.argmin(ids[top])])
        out.append(int(ids[at]))
    return out


@pytest.mark.parametrize("metric", ["euclidean", "sq_drop_last", "euclidean_2d"])
@pytest.mark.parametrize("dim,ties", [(2, True), (3, False), (10, True)])
def test_lazy_centres_are_those_of_the_plain_rounds(spark, metric, dim, ties):
    rows = clouds(dim, 400, dim, ties)
    got = KC.lazy_farthest_first(frame(spark, rows).repartition(5), 14, metric, blocks=32)
    assert [i for i, _ in got] == plain(rows, 14, metric)
    assert all(v == dict(rows)[i] for i, v in got)


def test_lazy_centres_equal_farthest_first_and_stop(spark):
    rows = [(i, [float(i % 3), 1.0]) for i in range(50)]
    df = frame(spark, rows)
    assert KC.lazy_farthest_first(df, 9, blocks=4) == KC.farthest_first(df, 9)[0] and len(KC.lazy_farthest_first(df, 9)) == 3
    assert KC.lazy_farthest_first(df.limit(0), 3) == []
    assert [r["id"] for r in KC.k_center_lazy(df, 1).collect()] == [0]
    with pytest.raises(ValueError):
        KC.lazy_farthest_first(df, 0)
    with pytest.raises(Exception, match="NULL|NaN|point"):
        KC.lazy_farthest_first(frame(spark, [*rows, (99, None)]), 3)


def test_rounds_open_few_blocks(spark):
    # a third of all rows are one point
    rows = clouds(2, 6000, 5) + [(100_000 + i, [3.0, 3.0]) for i in range(3000)]
    stats = {}
    got = KC.lazy_farthest_first(frame(spark, rows), 20, blocks=64, stats=stats)
    assert [i for i, _ in got] == plain(rows, 20)
    # plain rounds read each point in each of them
    assert stats["rounds"][-1][0] < 0.3 * 19 * len(rows)


@pytest.mark.parametrize("metric", ["euclidean", "sq_drop_last", "euclidean_2d"])
@pytest.mark.parametrize("dim", [2, 5, 16])
def test_many_centres_are_searched_exactly(metric, dim):
    rng = np.random.default_rng(dim)
    C = np.round(rng.normal(size=(3000, dim)) * 4) if dim < 16 else rng.normal(size=(3000, dim))
    X = np.vstack([np.round(rng.normal(size=(700, dim)) * 4), rng.normal(size=(300, dim)) * 50])
    shards = np.arange(len(X)) % 2
    plain_d, plain_at = K.nearest_arrays(X, shards, {0: C, 1: C[:2000]}, metric, 512)
    cells = K.searched({0: C, 1: C[:2000]}, metric)
    assert all(isinstance(c, CentreCells) for c in cells.values())
    d, at = K.nearest_arrays(X, shards, cells, metric, 512)
    assert (at == plain_at).all() and (d == plain_d).all()
    if dim == 2 and metric == "euclidean":
        assert sum(c.compared for c in cells.values()) < 0.2 * 500 * 5000


def test_a_hundred_thousand_centres(spark):
    rng = np.random.default_rng(1)
    C = rng.uniform(size=(100_000, 2))
    X = rng.uniform(size=(2000, 2))
    got = {r["id"]: (r["cid"], r["d"]) for r in KM.assign_nearest(frame(spark, list(enumerate(X.tolist()))), {0: C.tolist()}).collect()}
    for i in range(0, 2000, 40):
        sq = ((X[i] - C) ** 2).sum(axis=1)
        assert got[i] == (int(sq.argmin()), pytest.approx(float(np.sqrt(sq.min())), rel=1e-12))


def test_weights_and_steps_of_many_centres(spark, monkeypatch):
    rows = clouds(3, 1500, 9, ties=True)
    centers = {0: [v for _, v in rows[:400]]}
    df = frame(spark, rows)
    got = {r["cid"]: r["n"] for r in KM.center_weights(df, centers).collect()}
    step = KM.lloyd_step(KM.prepare(df), centers, 3)
    monkeypatch.setattr(K, "MANY_CENTERS", 1 << 30)
    assert got == {r["cid"]: r["n"] for r in KM.center_weights(df, centers).collect()}
    assert step == KM.lloyd_step(KM.prepare(df), centers, 3)
