"""Shard coresets whose centres stay in Spark: the same rows as the collected rounds, in any layout and skew."""

import random

import numpy as np
import pytest

from tessera.operators import kcenter as KC
from tessera.operators import kmedian as KM
from tessera.plans import shards as S


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<double>")


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(31)
    rows = [(i * 5, [round(rng.random(), 2), rng.random(), rng.random()]) for i in range(400)]  # all in shard 0 of 5
    rows += [(1000 + i, [rng.random(), rng.random(), 0.5]) for i in range(300)]
    rows += [(5000 + i, rows[i][1]) for i in range(40)]
    return rows


def coreset(df, **kw):
    return sorted((r["shard"], r["rank"], r["id"], tuple(r["v"])) for r in KC.k_center_coreset(df, 7, 5, **kw).collect())


@pytest.mark.parametrize("every", [2, 8])
@pytest.mark.parametrize("least", [16, 1024])
def test_coreset_equals_the_collected_rounds(spark, skewed, monkeypatch, every, least):
    monkeypatch.setattr(S, "LEAST_ROWS", least)
    df = frame(spark, skewed)
    want = sorted((s, r, i, tuple(v)) for s, lst in KC.farthest_first(df, 7, 5).items() for r, (i, v) in enumerate(lst))
    assert coreset(df, checkpoint_every=every) == want
    assert coreset(df.repartition(9), checkpoint_every=every) == want


@pytest.mark.parametrize("least", [16, 1024])
def test_weighted_coreset_equals_the_collected_rounds(spark, skewed, monkeypatch, least):
    monkeypatch.setattr(S, "LEAST_ROWS", least)
    df = frame(spark, skewed)
    centers = KM.kmedian_cluster(df, 6, 2, 42, 5)
    weights = {(r["shard"], r["cid"]): r["n"] for r in KM.center_weights(df, centers, 5).collect()}
    got = {(r["shard"], r["cid"]): (r["v"], r["w"]) for r in KM.kmedian_coreset(df, 6, 5, 2, 42, checkpoint_every=3).collect()}
    assert {k: w for k, (_, w) in got.items()} == weights
    for (s, c), (v, _) in got.items():
        assert np.allclose(v, centers[s][c], rtol=0, atol=1e-12)


def test_no_centre_reaches_the_driver(spark, skewed, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    collected = []
    collect = Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: collected.append(self.columns) or collect(self))
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("rows from the driver"))
    df = skewed_df = spark.range(300).selectExpr("id", "array(double(id * id % 97), double(id % 31)) AS v")
    core = KC.k_center_coreset(df, 4, 3)
    KM.kmedian_coreset(skewed_df, 4, 3, 1)
    assert all("v" not in c and "id" not in c for c in collected)
    assert core.columns == ["shard", "rank", "id", "v"]


def test_a_cached_round_exchanges_no_points(spark):
    df = spark.range(5000).selectExpr("id", "array(double(id * id % 97), double(id % 31)) AS v", "int(id % 3) AS shard", "1D AS w")
    with S.ShardedPoints(df) as g:
        centre = spark.createDataFrame([(0, 2, 0, [0.0, 0.0])], S.CENTRE)
        plan = g.with_centres(centre, S._pick_kernel("farthest", "euclidean"), S.CANDIDATE)._jdf.queryExecution().executedPlan().toString()
        above = plan.split("InMemoryTableScan")[0]
        assert "FlatMapCoGroupsInArrow" in above and "Exchange" not in above and "Sort" not in above
        assert g.rows.groupBy("shard", "sub").count().agg({"count": "max"}).first()[0] <= 2 * S.LEAST_ROWS


def test_short_empty_and_bad_inputs(spark):
    df = frame(spark, [(i, [1.0, 1.0]) for i in range(6)] + [(7, [2.0, 2.0])])
    assert sorted((r["shard"], r["rank"], r["id"]) for r in KC.k_center_coreset(df, 4, 2).collect()) == [(0, 0, 0), (1, 0, 1), (1, 1, 7)]
    core = {(r["shard"], r["cid"]): r["w"] for r in KM.kmedian_coreset(df, 4, 2, 1).collect()}
    assert sum(core.values()) == 7 and set(core) == {(0, 0), (1, 0), (1, 1)}
    none = frame(spark, [])
    assert KC.k_center_coreset(none, 3, 2).collect() == [] == KM.kmedian_coreset(none, 3, 2, 1).collect()
    for bad in ([None], [[1.0, float("nan")]], [[1.0]]):
        rows = [(0, [0.0, 0.0]), (2, [1.0, 0.0])] + [(4, v) for v in bad]
        with pytest.raises(Exception, match="NULL or NaN point|unequal dimension"):
            KC.k_center_coreset(frame(spark, rows), 3, 2).collect()
    for k, L in ((0, 2), (2, 0)):
        with pytest.raises(ValueError):
            KC.k_center_coreset(df, k, L)
