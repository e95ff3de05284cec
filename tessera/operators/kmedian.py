"""Weighted k-median: distance-proportional seeding, Lloyd rounds, coresets.

Every round is one scan of the points: an Arrow-batched kernel compares each
batch with the centres and reduces its task to one row per cluster, and these are
added up after an exchange; the k (or k·L) centres are the only rows that reach the driver. Seeding draws with
probability proportional to ``w·d`` by exponential keys: the point with the
smallest ``-ln(u)/(w·d)`` wins, ``u`` a seeded md5 uniform of
``seed:round:id`` — no prefix sums, no ordering, reproducible in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import checked_point, seeded_key, seeded_number
from tessera.plans.bounds import carried_lloyd
from tessera.plans.centers import (
    argmin_by_shard, center_rounds, lloyd_sums, nearest, spread_and_persist,
)
from tessera.plans.shards import ShardedPoints, centre_tables, cluster_sums, lloyd_tables
from tessera.session import write_table


def prepare(points: DataFrame, shards: int | None = None, w_col: str | None = None,
            id_col: str = "id", v_col: str = "v") -> DataFrame:
    """``(id, v, shard, w)`` with shard ``pmod(id, L)`` (0 without shards), w default 1."""
    shard = F.pmod(F.col(id_col), F.lit(shards)).cast("int") if shards else F.lit(0)
    w = F.col(w_col).cast("double") if w_col else F.lit(1.0)
    return points.select(F.col(id_col).alias("id"), checked_point(v_col).alias("v"),
                         shard.alias("shard"), w.alias("w"))


def _first_uniform(seed: int):
    def pick(df: DataFrame, _r: int) -> DataFrame:
        return argmin_by_shard(df, seeded_number(seed, F.col("id")), seed)
    return pick


def kmedian_seed(points: DataFrame, k: int, seed: int = 42, shards: int | None = None,
                 dim: int | None = None, checkpoint_every: int = 8, prepared: bool = False):
    """Seeds per shard ``{shard: [(id, v), ...]}``.

    First seed uniform (smallest ``md5('seed:id')``); seed r is drawn with
    probability proportional to ``w·d`` among points at positive distance.
    """
    pts = points if prepared else prepare(points, shards)
    return center_rounds(pts, k, _first_uniform(seed), "seed", dim,
                         checkpoint_every=checkpoint_every, extra_cols=("w",), seed=seed,
                         persisted=prepared and points.is_cached)


def _vectors(chosen) -> dict[int, list[list[float]]]:
    return {s: [v for _, v in lst] for s, lst in chosen.items()}


def assign_nearest(points: DataFrame, centers: dict[int, list[list[float]]], dim: int | None = None,
                   shard_col: str | None = None) -> DataFrame:
    """``(id, cid, d)``: nearest centre, ties to the lowest centre index."""
    keep = (["shard"] if shard_col else []) + ["id"]
    return nearest(points, centers, dim, shard_col, keep=keep)


def lloyd_step(points: DataFrame, centers: dict[int, list[list[float]]], dim: int | None = None,
               sharded: bool = False):
    """One Lloyd round on prepared points ``(id, v, shard, w)``.

    Returns ``(new_centers, sizes)``: weighted means per (shard, centre) and
    ``{(shard, cid): (sum_w, n)}``. An empty cluster keeps its previous centre.
    """
    if dim is None:
        dim = len(next(v for vs in centers.values() for v in vs))
    new = {s: [list(v) for v in vs] for s, vs in centers.items()}
    sizes = {}
    for r in lloyd_sums(points, centers, dim, "shard" if sharded else None).collect():
        s, c = int(r["shard"]), int(r["cid"])
        sizes[(s, c)] = (r["sw"], r["n"])
        if r["sw"] > 0:
            new[s][c] = [x / r["sw"] for x in r["s"]]
    return new, sizes


def lloyd(points: DataFrame, centers, dim: int | None, iters: int, sharded: bool = False, carry: bool = False,
          stats: dict | None = None):
    """``iters`` Lloyd rounds, no convergence test (as specified).

    ``carry`` keeps bounds with the points (``plans.bounds``): the same centres, but after the first round only points
    that may have changed their cluster are compared with the centres. It pays a written table for that, so it is for many rounds or
    centres. ``stats`` tells the rows ``compared`` in each round (with ``carry``) and the last round's ``sizes``,
    ``{(shard, cid): (sum_w, n)}``; a cluster without an entry is empty and kept its centre.
    """
    if carry:
        return carried_lloyd(points, centers, iters, sharded, stats)
    for _ in range(iters):
        centers, sizes = lloyd_step(points, centers, dim, sharded)
        if stats is not None:
            stats["sizes"] = sizes
    return centers


def kmedian_cluster(points: DataFrame, k: int, iters: int, seed: int = 42,
                    shards: int | None = None, w_col: str | None = None,
                    checkpoint_every: int = 8, spread: bool = True, carry: bool = False,
                    stats: dict | None = None) -> dict[int, list[list[float]]]:
    """Seeding plus ``iters`` Lloyd rounds; ``{shard: [centre vectors]}``. ``carry`` and ``stats`` as in ``lloyd``.

    ``spread=False`` keeps the input's partitioning (for a small bounded input
    such as a k·L-row coreset, where a repartition costs more than it saves).
    """
    prepared = prepare(points, shards, w_col)
    pts = spread_and_persist(prepared) if spread else prepared.persist()
    try:
        chosen = kmedian_seed(pts, k, seed, shards, None, checkpoint_every, prepared=True)
        if not chosen:
            return {}
        centers = _vectors(chosen)
        dim = len(next(iter(centers.values()))[0])
        return lloyd(pts, centers, dim, iters, bool(shards), carry, stats)
    finally:
        pts.unpersist()


def centers_to_frame(spark, centers: dict[int, list[list[float]]]) -> DataFrame:
    rows = [(s, c, list(map(float, v))) for s, vs in sorted(centers.items()) for c, v in enumerate(vs)]
    # k·L rows, bounded by the parameters: one partition
    return spark.createDataFrame(rows, "shard int, cid int, v array<double>").coalesce(1)


def kmedian_objective(points: DataFrame, centers: dict[int, list[list[float]]],
                      dim: int | None = None) -> DataFrame:
    """One row ``objective``: mean distance of every point to its nearest centre."""
    d = nearest(points, centers, dim, None, cid_name=None, keep=[])
    return d.agg(F.avg("d").alias("objective"))


def center_weights(points: DataFrame, centers: dict[int, list[list[float]]],
                   shards: int | None = None, dim: int | None = None) -> DataFrame:
    """``(shard, cid, n)``: points nearest each centre; centres with none show 0."""
    pts = prepare(points, shards)
    assigned = nearest(pts, centers, dim, "shard" if shards else None, keep=["shard"])
    counts = assigned.groupBy("shard", "cid").agg(F.count(F.lit(1)).alias("n"))
    allc = points.sparkSession.createDataFrame(
        [(s, c) for s, vs in sorted(centers.items()) for c in range(len(vs))], "shard int, cid int")
    return allc.join(counts, ["shard", "cid"], "left").select(
        "shard", "cid", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def kmedian_coreset(points: DataFrame, k: int, L: int, iters: int, seed: int = 42,
                    checkpoint_every: int = 8) -> DataFrame:
    """Round 1: ``(shard, cid, v, w)`` — per-shard clustering with centre weights, as a written table.

    The same seeds and Lloyd rounds as ``kmedian_cluster`` with shards, but the centres never leave Spark
    (``plans.shards``), so neither k nor L is bounded by the driver.
    """
    if L <= 0:
        raise ValueError("L must be positive")
    with ShardedPoints(prepare(points, L)) as groups:
        seeds, path = centre_tables(groups, k, seeded_key(seed, F.col("id")), "seed", seed, every=checkpoint_every)
        groups.tables.append(path)
        centres = lloyd_tables(groups, seeds.withColumnRenamed("rank", "cid"), iters)
        sizes = cluster_sums(groups, centres).select("shard", "cid", "n")
        out = centres.join(sizes, ["shard", "cid"], "left").select(
            "shard", "cid", "v", F.coalesce("n", F.lit(0)).cast("long").alias("w"))
        return write_table(out)[0]


def coreset_points(coreset: DataFrame, k: int) -> DataFrame:
    """Give coreset rows ids ``shard·k + cid`` for the second clustering."""
    return coreset.select((F.col("shard").cast("long") * F.lit(k) + F.col("cid")).alias("id"), "v", "w")


def mr_kmedian(points: DataFrame, k: int, L: int, iters: int, seed: int = 42,
               checkpoint_every: int = 8) -> tuple[DataFrame, dict]:
    """Three rounds: weighted coreset per shard, clustering of the k·L weighted
    rows, objective over all points. Returns ``(objective_df, centers)``."""
    pts = spread_and_persist(points.select("id", "v"))
    try:
        core = coreset_points(kmedian_coreset(pts, k, L, iters, seed, checkpoint_every), k)
        centers = kmedian_cluster(core, k, iters, seed, None, "w", checkpoint_every, spread=False)
        # one row, written so that the points can leave the cache
        return write_table(kmedian_objective(pts, centers))[0], centers
    finally:
        pts.unpersist()
