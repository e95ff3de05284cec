import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException

from tessera.operators import distance as D


def test_pair_distances_f3(spark, four_points):
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3)], "id_a long, id_b long")
    got = {(r["id_a"], r["id_b"]): r["d"] for r in D.pair_distance(four_points, pairs).collect()}
    want = {(0, 1): 5, (0, 2): 10, (0, 3): 1, (1, 2): 5, (1, 3): 4.242641, (2, 3): 9.219544}
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-6
    drop = {(r["id_a"], r["id_b"]): r["d"] for r in
            D.pair_distance(four_points, pairs, metric="sq_drop_last").collect()}
    assert drop[(0, 2)] == 36.0 and drop[(2, 3)] == 36.0 and drop[(0, 3)] == 0.0


def test_exact_and_average_f3(spark, four_points):
    assert D.exact_mpd(four_points).collect()[0]["mpd"] == 10.0
    assert D.exact_mpd_pruned(four_points).collect()[0]["mpd"] == 10.0
    assert abs(D.avg_pairwise_distance(four_points).collect()[0]["avg_d"] - 5.743698) < 1e-6


def test_small_inputs(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    assert D.exact_mpd(one).collect()[0]["mpd"] == 0.0
    assert D.avg_pairwise_distance(one).collect()[0]["avg_d"] is None


def test_unequal_dimensions_raise(spark):
    bad = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 2.0, 3.0])], "id long, v array<double>")
    with pytest.raises(PySparkException):
        D.exact_mpd(bad).collect()
    pairs = spark.createDataFrame([(0, 1)], "id_a long, id_b long")
    with pytest.raises(PySparkException):
        D.pair_distance(bad, pairs).collect()


@pytest.fixture(scope="module")
def cloud(spark):
    rng = random.Random(7)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(700)]
    return spark.createDataFrame(rows, "id long, v array<double>"), np.array([r[1] for r in rows])


def _brute(X):
    diff = X[:, None, :] - X[None, :, :]
    d = np.sqrt((diff ** 2).sum(-1))
    iu = np.triu_indices(len(X), 1)
    return d[iu].max(), d[iu].mean()


def test_block_plan_matches_brute_force(cloud):
    df, X = cloud
    mx, avg = _brute(X)
    for B in (1, 3, 7):
        assert math.isclose(D.exact_mpd(df, blocks=B).collect()[0]["mpd"], mx, rel_tol=1e-12)
        assert math.isclose(D.avg_pairwise_distance(df, blocks=B).collect()[0]["avg_d"], avg, rel_tol=1e-10)
    assert math.isclose(D.exact_mpd_pruned(df).collect()[0]["mpd"], mx, rel_tol=1e-12)


def test_two_approx_bounds(cloud):
    df, X = cloud
    mx, _ = _brute(X)
    lb = D.two_approx_mpd(df, 10, 42).collect()[0]["mpd_lb"]
    assert mx / 2 - 1e-12 <= lb <= mx + 1e-12


def test_sample_is_layout_independent(cloud):
    df, _ = cloud
    a = sorted(r["id"] for r in D.sample_k(df, 10, 42).collect())
    b = sorted(r["id"] for r in D.sample_k(df.repartition(17), 10, 42).collect())
    assert a == b and len(a) == 10


def test_distinct_points(spark):
    df = spark.createDataFrame([(5, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [0.0, 1.0])], "id long, v array<double>")
    assert sorted(r["id"] for r in D.distinct_points(df).collect()) == [2, 3]
    assert D.point_count(df).collect()[0][0] == 3
