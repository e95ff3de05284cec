"""Fixture F4: 1,012 two-dimensional points (961 distinct); values from FIXTURES.md."""

import os

import pytest

from tessera.operators import distance as D
from tessera.operators import kcenter as KC

DATA = os.path.join(os.path.dirname(__file__), "data", "uber_small.csv")


@pytest.fixture(scope="module")
def uber(spark):
    pts = []
    with open(DATA) as f:
        for line in f:
            line = line.strip()
            if line:
                pts.append(tuple(float(x) for x in line.split(",")))
    # ids in lexicographic order, so "smallest id" is the smallest point
    pts.sort()
    return spark.createDataFrame([(i, list(p)) for i, p in enumerate(pts)], "id long, v array<double>")


def test_exact_and_average(uber):
    assert round(D.exact_mpd(uber).collect()[0]["mpd"], 6) == 0.999805
    assert round(D.exact_mpd_pruned(uber).collect()[0]["mpd"], 6) == 0.999805
    assert round(D.avg_pairwise_distance(uber).collect()[0]["avg_d"], 6) == 0.066801
    assert D.distinct_points(uber).count() == 961


def test_k_center_and_radius(uber):
    centers = [tuple(r["v"]) for r in KC.k_center(uber, 5).orderBy("rank").collect()]
    assert centers == [(40.6086, -73.9326), (40.7757, -73.4202), (40.779, -74.42),
                       (40.9651, -74.0736), (40.6914, -74.1771)]
    r5 = KC.k_center_distances(uber, 5).agg({"d": "max"}).collect()[0][0]
    r10 = KC.k_center_distances(uber, 10).agg({"d": "max"}).collect()[0][0]
    assert round(r5, 6) == 0.231767 and round(r10, 6) == 0.114511
