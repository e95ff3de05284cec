"""Centres compared in slices, and points in other layouts: the same results."""

import random

import pytest

from tessera.operators import distance as D
from tessera.operators import kmedian as KM
from tessera.plans import centers as PC


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(17)
    rows = [(i, [rng.random(), rng.random(), rng.random()]) for i in range(300)]
    # an exact tie: point 1000 is equidistant from centres 0 and 1 below
    rows.append((1000, [0.5, 0.5, 0.5]))
    df = spark.createDataFrame(rows, "id long, v array<double>")
    centers = {0: [[0.0, 0.5, 0.5], [1.0, 0.5, 0.5], [0.2, 0.9, 1.1], [0.7, -0.2, 0.3], [-0.1, 0.4, 0.9]]}
    sharded = {s: [[rng.random() for _ in range(3)] for _ in range(3)] for s in range(3)}
    return df, centers, sharded


def test_chunked_equals_single(spark, data, monkeypatch):
    df, centers, sharded = data
    pts = KM.prepare(df)
    spts = KM.prepare(df, 3)

    def results():
        return (
            sorted((r["id"], r["cid"], r["d"]) for r in KM.assign_nearest(df, centers).collect()),
            KM.kmedian_objective(df, centers).collect()[0][0],
            KM.lloyd_step(pts, centers)[0],
            KM.lloyd_step(spts, sharded, sharded=True)[0],
            sorted(tuple(r) for r in KM.center_weights(df, sharded, 3).collect()),
            D.two_approx_mpd(df, 7, 42).collect()[0][0],
        )

    single = results()
    monkeypatch.setattr(PC, "KERNEL_LIMIT", 4)  # one centre at a time
    chunked = results()
    assert chunked[0] == single[0]
    assert abs(chunked[1] - single[1]) < 1e-12
    for a, b in ((chunked[2], single[2]), (chunked[3], single[3])):
        assert a.keys() == b.keys()
        for s in a:
            for u, v in zip(a[s], b[s]):
                assert all(abs(x - y) < 1e-12 for x, y in zip(u, v))
    assert chunked[4] == single[4]
    assert chunked[5] == single[5]
    tie = [r for r in single[0] if r[0] == 1000][0]
    assert tie[1] == 0  # ties go to the lowest centre index, also across chunks


def test_chunked_rounds_equal_single(spark, monkeypatch):
    from tessera.operators import kcenter as KC
    rng = random.Random(23)
    df = spark.createDataFrame([(i, [rng.random(), rng.random()]) for i in range(400)], "id long, v array<double>")
    want = KC.k_center_coreset(df, 5, 6).collect()
    seeds = KM.kmedian_seed(df, 4, 42, shards=6)
    monkeypatch.setattr(PC, "KERNEL_LIMIT", 5)  # two centres at a time
    got = KC.k_center_coreset(df, 5, 6).collect()
    assert sorted((r["shard"], r["rank"], r["id"]) for r in got) == \
        sorted((r["shard"], r["rank"], r["id"]) for r in want)
    assert KM.kmedian_seed(df, 4, 42, shards=6) == seeds


def test_rounds_do_not_depend_on_the_layout(spark):
    from tessera.operators import kcenter as KC
    rng = random.Random(29)
    rows = [(i, [round(rng.random(), 2), round(rng.random(), 2), rng.random()]) for i in range(500)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]  # duplicates
    frame = spark.createDataFrame(rows, "id long, v array<double>")

    def picks(df):
        return (
            [(r["shard"], r["rank"], r["id"]) for r in KC.k_center_coreset(df, 6, 5, checkpoint_every=2).collect()],
            KC.farthest_first(df, 7, None, metric="sq_drop_last"),
            KM.kmedian_seed(df, 5, 42, shards=5, checkpoint_every=3),
            KM.kmedian_seed(df, 5, 7),
        )

    assert picks(frame.coalesce(1)) == picks(frame.repartition(7))


@pytest.mark.parametrize("dim", [2, 16, 17, 64])
@pytest.mark.parametrize("bad", ["null", "coordinate", "nan"])
def test_bad_points_raise_alike_at_any_dimension(spark, dim, bad):
    from tessera.operators import kcenter as KC
    rows = [(i, [float(i + j) for j in range(dim)]) for i in range(20)]
    rows.append((50, None if bad == "null" else [None if bad == "coordinate" else float("nan")] + [1.0] * (dim - 1)))
    df = spark.createDataFrame(rows, "id long, v array<double>")
    good = {0: [rows[0][1], rows[5][1]]}
    for job in (lambda: KC.k_center(df, 3), lambda: KM.kmedian_seed(df, 2), lambda: KM.kmedian_objective(df, good).collect(),
                lambda: KM.lloyd_step(KM.prepare(df), good), lambda: D.exact_mpd(df).collect(), lambda: D.exact_mpd_pruned(df).collect(),
                lambda: D.two_approx_mpd(df, 3).collect()):
        with pytest.raises(Exception, match="NULL or NaN point"):
            job()


def test_more_centres_than_a_packed_index_and_repeated_ids(spark):
    rows = [(7, [0.0]), (7, [9.0]), (8, [5.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    many = {0: [[1e6 + j] for j in range((1 << 20) + 1)] + [[5.0]]}
    assert sorted((r["id"], r["cid"]) for r in KM.assign_nearest(df, many).collect()) == [(7, (1 << 20) + 1)] * 2 + [(8, (1 << 20) + 1)]
    assert KM.lloyd_step(KM.prepare(df), many)[1] == {(0, (1 << 20) + 1): (3.0, 3)}
