"""Point-versus-centres plans and the round loop of the centre-picking operators.

Centres are few (k per shard, bounded by the caller's parameters and checked
against ``DRIVER_LIMIT``) and are the only thing that reaches the driver: one
row per shard per round. They go back to the executors as a broadcast to an
Arrow-batched numpy kernel. Each round is one scan; a task reduces its rows to
one candidate per shard, and the candidates are reduced after an exchange by
shard. No round sorts the points.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.vectors import checked_point, seeded_uniform
from tessera.plans import kernels as K
from tessera.session import drop_table, scan_partitions, write_table

# Centres beyond this many doubles (256 MB) are refused: they were collected
# on the driver.
DRIVER_LIMIT = 1 << 25
# A kernel compares at most this many centre doubles (512 KB) at once; a memory bound without effect on results.
KERNEL_LIMIT = 1 << 16


def spread_and_persist(df: DataFrame) -> DataFrame:
    """Persist a loop input, spread over at least ``defaultParallelism`` partitions.

    A loop reads its input once per round; a source with few splits (a small
    file with few row groups) would otherwise run every round on a few cores.
    Inputs that already have enough partitions are not shuffled, nor those behind an exchange, whose
    partitions only a run of it would tell.
    """
    par = df.sparkSession.sparkContext.defaultParallelism
    if (scan_partitions(df) or par) < par:
        df = df.repartition(par)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def vector_dim(points: DataFrame, v_col: str = "v") -> int | None:
    """Dimension of the first point (None for an empty table)."""
    row = points.select(F.size(F.col(v_col)).alias("d")).limit(1).collect()
    return int(row[0]["d"]) if row else None


def _size(centers: dict[int, list]) -> int:
    return sum(len(vs) * (len(vs[0]) if len(vs) else 0) for vs in centers.values())


def _width(arrays: dict[int, np.ndarray]) -> int | None:
    """The centres' dimension; points of another dimension are then refused."""
    widths = {a.shape[1] for a in arrays.values()}
    if len(widths) > 1:
        raise ValueError("centres of unequal dimension")
    return widths.pop() if widths else None


def center_arrays(centers: dict[int, list[list[float]]]) -> dict[int, np.ndarray]:
    """Centre vectors as numpy matrices, refused past ``DRIVER_LIMIT`` doubles."""
    total = _size(centers)
    if total > DRIVER_LIMIT:
        raise ValueError(f"{total} centre coordinates exceed the bound {DRIVER_LIMIT}; "
                         "use fewer centres or shards")
    return {int(s): np.asarray(vs, dtype=np.float64).reshape(len(vs), -1)
            for s, vs in centers.items() if len(vs)}


def share_centers(spark, arrays):
    """Broadcast centres, of at most ``DRIVER_LIMIT`` doubles."""
    return spark.sparkContext.broadcast(arrays)


def _step(dim: int | None) -> int:
    """Centres that a kernel compares at once."""
    return max(1, KERNEL_LIMIT // max(1, dim or 1))


def nearest(points: DataFrame, centers: dict[int, list[list[float]]], dim: int | None,
            shard_col: str | None = None, v_col: str = "v", metric: str = "euclidean",
            d_name: str = "d", cid_name: str | None = "cid", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns plus the distance to the nearest centre of the row's
    shard and its index (ties to the lowest). No centre gives NULLs.

    One Arrow-batched pass (``mapInArrow``), nothing shuffled, every row kept whatever the number of centres.
    NULL points and NULL or NaN coordinates raise.
    """
    if keep is None:
        keep = list(points.columns)
    arrays = center_arrays(centers)
    dim = dim if dim is not None else _width(arrays)
    need = list(dict.fromkeys(keep + [v_col] + ([shard_col] if shard_col else [])))
    src = points.select(*need).withColumn(v_col, checked_point(v_col))
    schema = T.StructType([src.schema[c] for c in keep] + [T.StructField(d_name, T.DoubleType())] +
                          ([T.StructField(cid_name, T.IntegerType())] if cid_name else []))
    return src.mapInArrow(K.nearest_kernel(share_centers(points.sparkSession, arrays), shard_col, v_col, keep, d_name,
                                           cid_name, metric, dim, _step(dim)), schema)


PickFn = Callable[[DataFrame, int], DataFrame]

PICK_SCHEMA = "shard int, id long, v array<double>, key double"


def center_rounds(points: DataFrame, k: int, first_pick: PickFn, mode: str,
                  dim: int | None, shard_col: str = "shard", v_col: str = "v",
                  metric: str = "euclidean", checkpoint_every: int = 8,
                  extra_cols: tuple[str, ...] = (), seed: int = 0, persisted: bool = False,
                  ) -> dict[int, list[tuple[int, list[float]]]]:
    """Pick up to k centres per shard, one per round.

    ``points`` has ``id``, ``v``, ``shard`` (and ``extra_cols``, e.g. ``w``).
    ``first_pick(df, 0)`` returns rows ``(shard, id, v)``. Later rounds use
    ``mode``: ``'farthest'`` (largest distance to the centres so far, ties to
    the smallest id) or ``'seed'`` (smallest ``-ln(u)/(w·d)``, a draw with
    probability proportional to ``w·d``). Only points at positive distance
    qualify, so a shard whose points all equal its centres stops.

    Each round is one scan: the kernel lowers the carried distance ``d0`` by the centres picked since it was
    last written, and keeps one candidate per task and shard. Every ``checkpoint_every`` rounds ``d0`` is written
    to the shared checkpoint folder, so a round compares with that many centres at most; the table written
    before is deleted. A lost executor recomputes from the written table or the source.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    if mode not in ("farthest", "seed"):
        raise ValueError(mode)
    spark = points.sparkSession
    cols = ["id", "v", "shard", *extra_cols]
    pts = points.select(F.col("id"), F.col(v_col).alias("v"), F.col(shard_col).alias("shard"),
                        *extra_cols)
    if not persisted:
        pts = spread_and_persist(pts)
    chosen: dict[int, list[tuple[int, list[float]]]] = {}
    pending: dict[int, list[list[float]]] = {}
    base = pts.withColumn("d0", F.lit(float("inf")))
    written = None
    try:
        def take(rows) -> None:
            for row in rows:
                s = int(row["shard"])
                chosen.setdefault(s, []).append((int(row["id"]), list(row["v"])))
                pending.setdefault(s, []).append(list(row["v"]))

        take(first_pick(pts, 0).collect())
        if dim is None:
            dim = _width(center_arrays(pending))
        for r in range(1, k):
            if not chosen:
                break
            src = base
            if mode == "seed":
                src = base.withColumn("u", seeded_uniform(seed, F.lit(r), F.col("id")))
            shared = share_centers(spark, center_arrays(pending))
            cand = src.mapInArrow(K.pick_kernel(shared, mode, metric, dim, _step(dim)), PICK_SCHEMA)
            rows = _winners(cand, PICK_SCHEMA).collect()
            if not rows:
                break
            take(rows)
            if checkpoint_every and r % checkpoint_every == 0 and r < k - 1:
                schema = T.StructType([base.schema[c] for c in cols] + [T.StructField("d0", T.DoubleType())])
                shared = share_centers(spark, center_arrays(pending))
                nxt = base.select(*cols, "d0").mapInArrow(K.update_kernel(shared, metric, dim, cols, _step(dim)), schema)
                before, (base, written) = written, write_table(nxt)
                if before:
                    drop_table(spark, before)
                pending = {}
    finally:
        if written:
            drop_table(spark, written)
        if not persisted:
            pts.unpersist()
    return chosen


def _winners(cand: DataFrame, schema: str, seed: int | None = None) -> DataFrame:
    """The best of the tasks' candidates of each shard: an exchange by shard and the same reduction, no sort."""
    kind = pa.int64() if "key long" in schema else pa.float64()
    return cand.repartition("shard").mapInArrow(K.first_kernel(kind, seed), schema)


def rows_by_shard(chosen: dict[int, list[tuple[int, list[float]]]]) -> list[tuple[int, int, int, list[float]]]:
    """Flatten to ``(shard, rank, id, v)`` tuples."""
    return [(s, r, i, v) for s, lst in sorted(chosen.items()) for r, (i, v) in enumerate(lst)]


def centers_frame(spark, chosen, with_shard: bool = True) -> DataFrame:
    rows = rows_by_shard(chosen)
    # k·L rows, bounded by the parameters: one partition
    df = spark.createDataFrame(rows, "shard int, rank int, id long, v array<double>").coalesce(1)
    return df if with_shard else df.drop("shard")


def argmin_by_shard(df: DataFrame, key: Column, seed: int | None = None) -> DataFrame:
    """Per shard the row with the smallest ``key`` (a long); ties to the smallest md5 of ``seed:id``, if given, then the smallest id."""
    schema = "shard int, id long, v array<double>, key long"
    cand = df.select("shard", "id", "v", key.alias("key")).mapInArrow(K.first_kernel(pa.int64(), seed), schema)
    return _winners(cand, schema, seed).select("shard", "id", "v")


def max_distance_to(points: DataFrame, centers: list[list[float]], dim: int | None,
                    metric: str = "euclidean") -> DataFrame:
    """One row ``m``: the largest distance from any point to any of ``centers``."""
    arr = center_arrays({0: centers}).get(0)
    if arr is None:
        return points.sparkSession.createDataFrame([], "m double").agg(F.max("m").alias("m"))
    dim = arr.shape[1] if dim is None else dim
    shared = share_centers(points.sparkSession, arr)
    part = points.select(checked_point("v").alias("v")).mapInArrow(
        K.max_dist_kernel(shared, metric, dim, _step(dim)), "m double")
    return part.agg(F.max("m").alias("m"))


def lloyd_sums(points: DataFrame, centers: dict[int, list[list[float]]], dim: int | None,
               shard_col: str | None, metric: str = "euclidean") -> DataFrame:
    """``(shard, cid, s, sw, n)``: weighted coordinate sums, weight sum and points of each cluster.

    A task sends one row per cluster, so a cluster that holds a third of all points costs no more than others.
    """
    arrays = center_arrays(centers)
    dim = dim if dim is not None else _width(arrays)
    cols = ["w"] + ([shard_col] if shard_col else [])
    schema = "shard int, cid int, s array<double>, sw double, n long"
    shared = share_centers(points.sparkSession, arrays)
    part = points.select(checked_point("v").alias("v"), *cols).mapInArrow(
        K.lloyd_kernel(shared, shard_col, metric, dim, _step(dim)), schema)
    return part.repartition("shard", "cid").mapInArrow(K.add_sums_kernel, schema)
