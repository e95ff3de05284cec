import random

import numpy as np

from tessera.operators import kmedian as KM


def test_assignment_f3(four_points):
    c = {0: [[0.0, 0.0], [6.0, 8.0]]}
    got = {r["id"]: (r["cid"], r["d"]) for r in KM.assign_nearest(four_points, c).collect()}
    assert got == {0: (0, 0.0), 1: (0, 5.0), 2: (1, 0.0), 3: (0, 1.0)}  # point 1 ties -> centre 0
    assert KM.kmedian_objective(four_points, c).collect()[0]["objective"] == 1.5
    w = {r["cid"]: r["n"] for r in KM.center_weights(four_points, c).collect()}
    assert w == {0: 3, 1: 1}
    new, sizes = KM.lloyd_step(KM.prepare(four_points), c, 2)
    assert np.allclose(new[0][0], [1.0, 5.0 / 3.0]) and new[0][1] == [6.0, 8.0]
    assert sizes[(0, 0)] == (3.0, 3)


def test_empty_cluster_keeps_centre(four_points):
    c = {0: [[0.0, 0.0], [100.0, 100.0], [6.0, 8.0]]}
    new, _ = KM.lloyd_step(KM.prepare(four_points), c, 2)
    assert new[0][1] == [100.0, 100.0]


def test_weighted_lloyd(spark):
    df = spark.createDataFrame([(0, [0.0], 1.0), (1, [10.0], 3.0)], "id long, v array<double>, w double")
    new, _ = KM.lloyd_step(KM.prepare(df, None, "w"), {0: [[5.0]]}, 1)
    assert new[0][0] == [7.5]


def test_seeding_excludes_zero_distance(spark):
    df = spark.createDataFrame([(i, [1.0, 1.0]) for i in range(6)] + [(7, [2.0, 2.0])],
                               "id long, v array<double>")
    seeds = KM.kmedian_seed(df, 4, 42)[0]
    vecs = sorted(tuple(v) for _, v in seeds)
    assert vecs == [(1.0, 1.0), (2.0, 2.0)]


def test_seeding_distribution_is_proportional_to_w_times_d(spark):
    # centre fixed at 0 by making id 0 the first draw for every seed is not
    # controllable; instead check the exponential-key race directly
    rows = [(0, [0.0], 1.0), (1, [1.0], 1.0), (2, [3.0], 2.0)]
    df = KM.prepare(spark.createDataFrame(rows, "id long, v array<double>, w double"), None, "w")
    hits = {1: 0, 2: 0}
    trials = 300
    for seed in range(trials):
        chosen = KM.kmedian_seed(df, 2, seed, prepared=True)[0]
        if chosen[0][0] != 0:
            continue
        hits[chosen[1][0]] += 1
    n = hits[1] + hits[2]
    assert n > 50
    # P(2) = 2*3 / (1*1 + 2*3) = 6/7
    assert abs(hits[2] / n - 6 / 7) < 0.12


def test_sharded_seeding_is_layout_independent(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i, [rng.random(), rng.random()]) for i in range(500)],
                               "id long, v array<double>")
    a = KM.kmedian_seed(df, 5, 42, shards=4)
    b = KM.kmedian_seed(df.repartition(9), 5, 42, shards=4, checkpoint_every=2)
    assert {s: [i for i, _ in v] for s, v in a.items()} == {s: [i for i, _ in v] for s, v in b.items()}


def test_mr_kmedian_objective_close_to_global(spark):
    rng = random.Random(9)
    pts = []
    for c in ([0, 0], [10, 0], [0, 10]):
        for _ in range(150):
            pts.append([c[0] + rng.gauss(0, 0.5), c[1] + rng.gauss(0, 0.5)])
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pts)], "id long, v array<double>")
    obj, centers = KM.mr_kmedian(df, 3, 3, 3, 42)
    o = obj.collect()[0]["objective"]
    assert o < 1.5 and len(centers[0]) == 3
