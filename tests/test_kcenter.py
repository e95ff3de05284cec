import random

import numpy as np

from tessera.operators import kcenter as KC


def ids(df, col="id"):
    return [r[col] for r in df.collect()]


def test_k_center_f3(four_points):
    assert ids(KC.k_center(four_points, 2).orderBy("rank")) == [0, 2]
    assert ids(KC.k_center(four_points, 3).orderBy("rank")) == [0, 2, 1]
    assert KC.k_center_mpd(four_points, 2).collect()[0]["mpd"] == 10.0


def test_coreset_f3(four_points):
    rows = KC.k_center_coreset(four_points, 2, 2).collect()
    got = {r["shard"]: set() for r in rows}
    for r in rows:
        got[r["shard"]].add(r["id"])
    assert got == {0: {0, 2}, 1: {1, 3}}


def test_matching_f3(spark, four_points):
    five = four_points.unionByName(spark.createDataFrame([(9, [100.0, 100.0])], "id long, v array<double>"))
    rows = KC.greedy_matching(four_points, 3).collect()
    assert sorted((r["round"], r["id"]) for r in rows) == [(0, 0), (0, 2), (1, 1)]
    rows = KC.greedy_matching(five, 4).collect()
    assert sorted((r["round"], r["id"]) for r in rows) == [(0, 0), (0, 9), (1, 2), (1, 3)]
    # first axis only: (0,9) and (3,9) tie at 10000 -> smaller ids; then (2,3) at 36
    rows = KC.greedy_matching(five, 4, metric="sq_drop_last").collect()
    assert sorted((r["round"], r["id"]) for r in rows) == [(0, 0), (0, 9), (1, 2), (1, 3)]
    assert len(KC.greedy_matching(four_points, 4).collect()) == 4  # k >= n: all points


def test_matching_drop_last_tie(spark, four_points):
    # (0,2) and (2,3) tie at 36 on the first axis; the smaller ids win
    five = four_points.unionByName(spark.createDataFrame([(9, [3.0, 50.0])], "id long, v array<double>"))
    rows = KC.greedy_matching(five, 2, metric="sq_drop_last").collect()
    assert sorted(r["id"] for r in rows) == [0, 2]


def test_duplicates_and_short_input(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(5)] + [(9, [2.0, 2.0])],
                               "id long, v array<double>")
    assert ids(KC.k_center(df, 4).orderBy("rank")) == [0, 9]
    one = spark.createDataFrame([(4, [0.0])], "id long, v array<double>")
    assert ids(KC.k_center(one, 3)) == [4]
    same = spark.createDataFrame([(i, [1.0]) for i in range(4)], "id long, v array<double>")
    assert sorted(ids(KC.greedy_matching(same, 3))) == [0, 1, 2]


def _ff_numpy(X, ids, k):
    order = np.argsort(ids)
    X, ids = X[order], ids[order]
    chosen = [0]
    d = np.sqrt(((X - X[0]) ** 2).sum(1))
    for _ in range(1, k):
        if d.max() <= 0:
            break
        m = d.max()
        j = np.nonzero(d == m)[0][0]
        chosen.append(j)
        d = np.minimum(d, np.sqrt(((X - X[j]) ** 2).sum(1)))
    return [int(ids[c]) for c in chosen]


def test_farthest_first_matches_numpy_and_checkpoints(spark):
    rng = random.Random(3)
    rows = [(i * 3 + 1, [rng.random() for _ in range(8)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    X = np.array([r[1] for r in rows])
    want = _ff_numpy(X, np.array([r[0] for r in rows]), 12)
    got = ids(KC.k_center(df, 12).orderBy("rank"))
    assert got == want
    got_ckpt = ids(KC.k_center(df.repartition(5), 12, checkpoint_every=2).orderBy("rank"))
    assert got_ckpt == want


def test_diversity_is_layout_independent(spark):
    rng = random.Random(11)
    df = spark.createDataFrame([(i, [rng.random(), rng.random()]) for i in range(300)],
                               "id long, v array<double>")
    a = sorted(ids(KC.diversity_max(df, 6, 3)))
    b = sorted(ids(KC.diversity_max(df.repartition(13), 6, 3)))
    assert a == b and len(a) == 6
    score = KC.diversity_score(df, 6, 3).collect()[0]["avg_d"]
    assert score > 0


def test_unequal_dimensions_raise(spark):
    import pytest
    from pyspark.errors import PySparkException
    bad = spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 2.0, 3.0])], "id long, v array<double>")
    with pytest.raises(PySparkException):
        KC.k_center(bad, 2)
