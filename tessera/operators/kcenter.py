"""Farthest-first traversal (k-center), its coreset, greedy matching, diversity.

The traversal is a loop of k rounds over the whole point table. Each round is
one scan: an Arrow-batched kernel lowers each point's distance to the nearest
centre so far and keeps one candidate per shard and task; the best of a shard's
candidates is its next centre, so only one row per round reaches the driver. Shard-local
coresets run the same rounds over groups of their shards' points, and their centres
stay in Spark; no shard is ever gathered into one task, however large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import checked_point
from tessera.plans.centers import argmin_by_shard, center_rounds, centers_frame, nearest, spread_and_persist
from tessera.plans.lazy import LazyCenters
from tessera.plans.pairs import PairIndex
from tessera.plans.shards import ShardedPoints, centre_tables


def _prep(points: DataFrame, shards: int | None, id_col: str = "id", v_col: str = "v") -> DataFrame:
    shard = F.pmod(F.col(id_col), F.lit(shards)).cast("int") if shards else F.lit(0)
    return points.select(F.col(id_col).alias("id"), checked_point(v_col).alias("v"), shard.alias("shard"))


def _first_by_min_id(df: DataFrame, _r: int) -> DataFrame:
    return argmin_by_shard(df, F.col("id"))


def farthest_first(points: DataFrame, k: int, shards: int | None = None, dim: int | None = None,
                   metric: str = "euclidean", checkpoint_every: int = 8,
                   id_col: str = "id", v_col: str = "v"):
    """Centres per shard as ``{shard: [(id, v), ...]}`` in pick order.

    First centre: smallest id. Next: the point farthest from the centres so
    far, ties to the smallest id. Stops early when every remaining point equals
    a centre, so at most min(k, distinct points) centres come back.
    """
    pts = spread_and_persist(_prep(points, shards, id_col, v_col))
    try:
        return center_rounds(pts, k, _first_by_min_id, "farthest", dim, metric=metric,
                             checkpoint_every=checkpoint_every, persisted=True)
    finally:
        pts.unpersist()


def lazy_farthest_first(points: DataFrame, k: int, metric: str = "euclidean", blocks: int | None = None,
                        stats: dict | None = None) -> list[tuple[int, list[float]]]:
    """The centres of ``farthest_first`` without shards, ``[(id, v), ...]``, by rounds that open few blocks (``plans.lazy``).

    For many points with structure in space and many centres: a round there reads the blocks that may hold the next
    centre, here and there all of them if boxes tell nothing (high dimension). ``stats`` tells after each round
    the ``(rows, compared, jobs)`` so far. Each point is read once more to be written by block.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    with LazyCenters(points, metric, blocks=blocks) as lazy:
        pick = lazy.first()
        while pick is not None:
            lazy.add(*pick)
            if len(lazy.centers) == k:
                break
            pick = lazy.farthest()
            if stats is not None:
                stats.setdefault("rounds", []).append((lazy.rows, lazy.compared, lazy.jobs))
        return lazy.centers


def k_center_lazy(points: DataFrame, k: int, **kw) -> DataFrame:
    """``(rank, id, v)``: the farthest-first centres by lazily opened blocks."""
    return centers_frame(points.sparkSession, {0: lazy_farthest_first(points, k, **kw)}, with_shard=False)


def k_center(points: DataFrame, k: int, **kw) -> DataFrame:
    """``(rank, id, v)``: the farthest-first centres."""
    chosen = farthest_first(points, k, None, **kw)
    return centers_frame(points.sparkSession, chosen, with_shard=False)


def k_center_distances(points: DataFrame, k: int, dim: int | None = None, **kw) -> DataFrame:
    """``(id, d)``: each point's distance to its nearest farthest-first centre."""
    chosen = farthest_first(points, k, None, dim=dim, **kw)
    centers = {0: [v for _, v in chosen.get(0, [])]}
    return nearest(points, centers, dim, None, cid_name=None, keep=["id"])


def k_center_mpd(points: DataFrame, k: int, **kw) -> DataFrame:
    """One row ``mpd``: exact maximum distance among the k centres."""
    from tessera.operators.distance import exact_mpd
    return exact_mpd(k_center(points, k, **kw).select("id", "v"))


def k_center_coreset(points: DataFrame, k: int, L: int, metric: str = "euclidean", checkpoint_every: int = 8,
                     id_col: str = "id", v_col: str = "v") -> DataFrame:
    """``(shard, rank, id, v)``: k farthest-first centres inside each shard ``pmod(id, L)``, as a written table in order of shard and rank.

    A shard with fewer than k distinct points returns all of them. The centres never leave Spark (``plans.shards``),
    so neither k nor L is bounded by the driver.
    """
    if L <= 0:
        raise ValueError("L must be positive")
    pts = _prep(points, L, id_col, v_col).withColumn("w", F.lit(1.0))
    with ShardedPoints(pts) as groups:
        centres, _ = centre_tables(groups, k, F.col("id"), "farthest", metric=metric, every=checkpoint_every)
    return centres.select("shard", "rank", "id", "v").orderBy("shard", "rank")


def greedy_matching(points: DataFrame, k: int, metric: str = "euclidean",
                    n: int | None = None, stats: dict | None = None) -> DataFrame:
    """``(round, id, v)``: floor(k/2) rounds of the farthest unused pair, plus the
    smallest unused id when k is odd; all points when k >= n.

    The points are written once as blocks in space (``plans.pairs``). The first round opens the block pairs whose
    bound reaches the farthest pair, later ones only those that lost theirs or come into reach, so their cost
    does not follow n². Ties go to the smallest ids, which also settles rounds where every
    remaining distance is 0. ``stats`` tells the pairs ``compared`` and the ``jobs`` after each round.
    """
    pts = points.select("id", "v")
    if n is None:
        n = pts.count()
    spark = points.sparkSession
    if k >= n:
        return pts.select(F.lit(None).cast("int").alias("round"), "id", "v")
    picked: list[tuple[int, int]] = []
    with PairIndex(pts, metric, n) as index:
        for r in range(k // 2):
            pair = index.farthest()
            if stats is not None:
                stats.setdefault("rounds", []).append((index.compared, index.jobs))
            if pair is None:
                break
            picked += [(r, pair[1]), (r, pair[2])]
            index.use(*pair[1:])
        if k % 2:
            used = F.broadcast(spark.createDataFrame([(i,) for _, i in picked], "id long"))
            last = index.rows.join(used, "id", "left_anti").agg(F.min("id")).first()[0]
            if last is not None:
                picked.append((k // 2, int(last)))
    sel = F.broadcast(spark.createDataFrame(picked, "round int, id long"))
    # of rows that repeat a picked id one is the point
    return pts.join(sel, "id").select("round", "id", "v").dropDuplicates(["round", "id"])


def diversity_max(points: DataFrame, k: int, L: int, metric: str = "euclidean", **kw) -> DataFrame:
    """Two rounds: k-center coreset per shard, then greedy matching on the k·L rows."""
    core = k_center_coreset(points, k, L, **kw).select("id", "v")
    return greedy_matching(core, k, metric)


def diversity_score(points: DataFrame, k: int, L: int, **kw) -> DataFrame:
    """One row ``avg_d``: average pairwise distance of the diversity solution."""
    from tessera.operators.distance import avg_pairwise_distance
    from tessera.plans.blocks import block_count_for
    sol = diversity_max(points, k, L, **kw).select("id", "v")
    # at most k rows: the block count follows from k, no count job
    return avg_pairwise_distance(sol, blocks=block_count_for(sol, k))
