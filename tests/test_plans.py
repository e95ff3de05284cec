"""Plan-level guards: no registered query plans a cross join or nested-loop
join, scans read only the columns they need, and counting keeps a map-side
partial aggregate before its shuffle."""

import os
import re

import pytest

import __spark_entry__ as E
from tessera.operators import classes as C
from tessera.sources import tables

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# the training-data operators' inner jobs are looked at by the check tool, not by their last frame
CORE = sorted(n for n in E.queries() if n != "pipeline" and not re.match(r"op\d+_", n))


@pytest.mark.parametrize("name", CORE)
def test_no_cross_or_nested_loop_join(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_partial_aggregate_and_pruned_scan(spark):
    df = C.class_count_direct(tables.event_pairs(spark, SF))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in text
    scan = [ln for ln in df._jdf.queryExecution().toString().splitlines() if "ReadSchema" in ln]
    assert scan and all("event_type" in ln and "props" not in ln for ln in scan)


def test_skewed_class_is_combined_map_side(spark):
    # a third of the rows in one class: the shuffle carries one row per map task for it
    rows = [(i, "hot" if i % 3 == 0 else f"c{i % 97}") for i in range(30_000)]
    pairs = spark.createDataFrame(rows, "id long, class string").repartition(6)
    got = {r["class"]: r["n"] for r in C.class_count(pairs, 4).collect()}
    assert got["hot"] == 10_000 and sum(got.values()) == 30_000


def test_no_round_sorts_the_points(spark, monkeypatch):
    # the frames that the loops collect, not only the one they return
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    from tessera.operators import kcenter as KC
    from tessera.operators import kmedian as KM
    plans = []
    collect = Frame.collect
    monkeypatch.setattr(Frame, "collect", lambda self: plans.append(plan_of(self)) or collect(self))
    df = spark.createDataFrame([(i, [float(i * i % 17), float(i)]) for i in range(60)], "id long, v array<double>")
    KC.farthest_first(df, 4, 2, checkpoint_every=2)
    KM.kmedian_cluster(df, 3, 2, shards=2)
    assert len(plans) >= 8
    assert all("MapInArrow" in p and "Sort" not in p for p in plans)


def test_class_counts_come_in_order(spark):
    rows = [(i, f"c{i * 7 % 23:02}") for i in range(200)]
    got = [r["class"] for r in C.class_count_sorted(spark.createDataFrame(rows, "id long, class string"), 4).collect()]
    assert got == sorted(got) and len(got) == 23


def test_sample_must_be_smaller_than_the_points(spark):
    from tessera.operators import distance as D
    df = spark.createDataFrame([(i, [float(i)]) for i in range(5)], "id long, v array<double>")
    for k in (0, 5, 6):
        with pytest.raises(ValueError):
            D.two_approx_mpd(df, k)
    assert D.two_approx_mpd(df, 4).first()[0] >= 2.0


def test_matching_of_repeated_ids_has_k_rows(spark):
    from tessera.operators import kcenter as KC
    rows = [(1, [0.0]), (1, [0.1]), (1, [0.2]), (2, [9.0]), (3, [4.0])]
    assert KC.greedy_matching(spark.createDataFrame(rows, "id long, v array<double>"), 3).count() == 3
