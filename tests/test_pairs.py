"""Farthest pairs by the block index, the hull and moments: equal to comparing all pairs, with far fewer comparisons."""

import itertools
import math
import random

import numpy as np
import pytest

from tessera.operators import distance as D
from tessera.operators import kcenter as KC
from tessera.plans import hull as H
from tessera.plans import pairs as P


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, v array<double>")


def dist(a, b, metric):
    if metric == "sq_drop_last":
        return sum((x - y) ** 2 for x, y in zip(a[:-1], b[:-1]))
    if metric == "euclidean_2d":
        a, b = a[:2], b[:2]
    return math.dist(a, b)


def ranked_pairs(rows, metric="euclidean"):
    return sorted((-dist(v, w, metric), min(i, j), max(i, j)) for (i, v), (j, w) in itertools.combinations(rows, 2))


def matched(rows, rounds, metric="euclidean"):
    out, used = [], set()
    for _, a, b in ranked_pairs(rows, metric):
        if len(out) < rounds and not {a, b} & used:
            used |= {a, b}
            out.append((a, b))
    return out


def clouds(dim, n, seed, ties=False):
    rng = random.Random(seed)
    rows = [(3 * i + 1, [round(rng.gauss(0, 5)) if ties else rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]
    return [(i, [float(x) for x in v]) for i, v in rows]


@pytest.mark.parametrize("metric", ["euclidean", "sq_drop_last", "euclidean_2d"])
@pytest.mark.parametrize("dim,ties", [(2, True), (3, False), (5, True), (12, False)])
def test_farthest_pairs_one_after_another(spark, monkeypatch, metric, dim, ties):
    monkeypatch.setattr(P, "SIDE_POINTS", 9)  # blocks are dealt to sub-blocks
    rows = clouds(dim, 160, dim, ties)
    want = matched(rows, 4, metric)
    with P.PairIndex(frame(spark, rows).repartition(3), metric, blocks=8) as index:
        got = []
        for _ in range(4):
            d, a, b = index.farthest()
            assert d == pytest.approx(dist(dict(rows)[a], dict(rows)[b], metric), rel=1e-12)
            got.append((a, b))
            index.use(a, b)
    assert got == want


def test_few_pairs_are_compared_and_later_rounds_cost_little(spark):
    rng = np.random.default_rng(5)
    n = 20_000
    df = frame(spark, [(i, v) for i, v in enumerate(rng.uniform(0, 1, (n, 2)).tolist())])
    stats = {}
    KC.greedy_matching(df, 10, stats=stats)
    compared = [c for c, _ in stats["rounds"]]
    assert len(compared) == 5 and compared[-1] < n * n / 2 / 1000
    flat = frame(spark, [(i, [*v, 0.5]) for i, v in enumerate(rng.uniform(0, 1, (n, 2)).tolist())])
    mpd = {}
    assert D.exact_mpd(flat, stats=mpd).first()[0] > 1.3
    assert mpd["compared"] < n * n / 2 / 1000


def test_equal_points_and_short_inputs(spark):
    same = [(i, [1.0, 2.0, 3.0]) for i in range(12)]
    assert sorted(r["id"] for r in KC.greedy_matching(frame(spark, same), 5).collect()) == [0, 1, 2, 3, 4]
    with P.PairIndex(frame(spark, same), blocks=4) as index:
        assert index.farthest() == (0.0, 0, 1)
    for rows in ([], same[:1]):
        with P.PairIndex(frame(spark, rows)) as index:
            assert index.farthest() is None
        assert D.exact_mpd(frame(spark, rows)).first()[0] == 0.0
    one = [(i, [float(i)]) for i in range(6)]
    assert sorted(r["id"] for r in KC.greedy_matching(frame(spark, one), 2, "sq_drop_last").collect()) == [0, 1]


@pytest.mark.parametrize("shape", ["cloud", "grid", "line", "circle", "same", "two", "one", "none"])
def test_plane_diameter(spark, monkeypatch, shape):
    rng = random.Random(8)
    vs = {"cloud": [[rng.gauss(0, 1), rng.gauss(0, 9)] for _ in range(3000)], "grid": [[float(x), float(y)] for x in range(40) for y in range(25)],
          "line": [[0.1 * i, 0.3 * i + 1] for i in range(500)], "circle": [[math.cos(0.01 * i), math.sin(0.01 * i)] for i in range(600)],
          "same": [[2.0, 2.0]] * 70, "two": [[0.0, 0.0], [3.0, 4.0]], "one": [[1.0, 1.0]], "none": []}[shape]
    df = frame(spark, list(enumerate(vs))).repartition(3)
    X = np.array(vs, float).reshape(-1, 2)
    want = max((float(np.sqrt(((X - x) ** 2).sum(axis=1)).max()) for x in X), default=0.0)
    assert D.exact_mpd(df).first()[0] == pytest.approx(want, rel=1e-12)
    if shape in ("circle", "cloud"):
        monkeypatch.setattr(H, "CORNERS", 2)  # more corners than a task compares: the index
        assert H.diameter(df).first()[0] == pytest.approx(want, rel=1e-12)


def test_plane_diameter_runs_no_block_job(spark, monkeypatch):
    monkeypatch.setattr(D, "block_pair_max", lambda *a, **k: pytest.fail("block job"))
    monkeypatch.setattr(D, "PairIndex", lambda *a, **k: pytest.fail("index"))
    assert D.exact_mpd(frame(spark, clouds(2, 5000, 1))).first()[0] > 5


def test_squared_mean_by_moments(spark, monkeypatch):
    rows = [(i, [1e6 + v[0], v[1], 1e9]) for i, v in clouds(2, 300, 3)]
    df = frame(spark, rows).repartition(5)
    want = np.mean([dist(v, w, "sq_drop_last") for (_, v), (_, w) in itertools.combinations(rows, 2)])
    blocks = D.avg_pairwise_distance(df, blocks=3, metric="sq_drop_last").first()[0]
    monkeypatch.setattr(D, "block_pair_sums", lambda *a, **k: pytest.fail("block job"))
    assert D.avg_pairwise_distance(df, metric="sq_drop_last").first()[0] == pytest.approx(want, rel=1e-9) == pytest.approx(blocks, rel=1e-9)
    for few in ([], rows[:1]):
        assert D.avg_pairwise_distance(frame(spark, few), metric="sq_drop_last").first()[0] is None
    with pytest.raises(Exception, match="unequal dimension"):
        D.avg_pairwise_distance(frame(spark, [(0, [1.0, 2.0]), (1, [1.0, 2.0, 3.0])]), metric="sq_drop_last").collect()
