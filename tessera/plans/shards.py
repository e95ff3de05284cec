"""Centre loops of many shards whose centres stay in Spark.

The points are dealt once to groups ``(shard, sub)``: a shard of many points has several, so none is large whatever the
skew. The centres are a table keyed by shard, and each round a cogroup brings a shard's new centres to its groups. The
points keep their partitioning and order in the cache, so a round shuffles centres and one candidate of each group; the
driver sees the number of centres of a round, and no centre.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.vectors import seeded_uniform
from tessera.plans import kernels as K
from tessera.session import drop_table, ensure_checkpoint_dir, write_table

# A group's vectors take about this many bytes. A task holds a group with all its columns, and several arrays as large while it works.
GROUP_BYTES = 1 << 21
# A partition's vectors take about this many bytes.
PARTITION_BYTES = 1 << 26
# Groups are not made smaller than this many points just for parallelism.
LEAST_ROWS = 1024
# Shards of more than one group, at most; groups grow beyond that (16 MB of (shard, groups) rows are broadcast then).
LARGE_SHARDS = 1_000_000
# Doubles of centres that a kernel compares at once.
STEP_DOUBLES = 1 << 16

CENTRE = "shard int, subs int, id long, v array<double>"


def group_rows(n: int, dim: int, par: int) -> int:
    """Rows of a group, about, if a shard of ``n`` points has several: the same for all large ``n``, up to ``LARGE_SHARDS`` groups."""
    return max(LEAST_ROWS, min(GROUP_BYTES // (8 * dim), -(-n // (4 * par))), -(-n // LARGE_SHARDS))


class ShardedPoints:
    """Points ``(id, v, shard, w)`` in groups ``(shard, sub)``, cached in that partitioning and order.

    ``subs`` is the number of groups of the row's shard. A context manager; leaving it frees the cache and deletes tables.
    """

    def __init__(self, points: DataFrame):
        self.spark = points.sparkSession
        self.tables: list[str] = []
        points = points.persist(StorageLevel.MEMORY_AND_DISK)  # read for the sizes and for the groups
        sizes, path = write_table(points.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim")))
        self.tables.append(path)
        total, dim = sizes.agg(F.sum("n"), F.max("dim")).first()
        n, par = int(total or 0), self.spark.sparkContext.defaultParallelism
        rows = group_rows(n, max(1, dim or 1), par)
        large = sizes.where(F.col("n") > rows).select("shard", F.ceil(F.col("n") / rows).cast("int").alias("subs"))
        subs = F.coalesce("subs", F.lit(1))
        self.partitions = max(par, -(-8 * n * max(1, dim or 1) // PARTITION_BYTES))
        dealt = points.join(F.broadcast(large), "shard", "left").select(
            "id", "v", "shard", "w", subs.alias("subs"), F.pmod(F.xxhash64("id"), subs).cast("int").alias("sub"), F.lit(float("inf")).alias("d0"))
        self.rows = self._grouped(dealt)
        points.unpersist()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.rows.unpersist()
        for path in self.tables:
            drop_table(self.spark, path)

    def _grouped(self, rows: DataFrame) -> DataFrame:
        """Cached groups; filled at once, so that later plans know the partitioning and order and exchange nothing."""
        out = rows.repartition(self.partitions, "shard", "sub").sortWithinPartitions("shard", "sub").persist(StorageLevel.MEMORY_AND_DISK)
        out.write.format("noop").mode("overwrite").save()
        return out

    def with_centres(self, centres: DataFrame, kernel: Callable, schema: str, extra: dict[str, Column] | None = None) -> DataFrame:
        """``kernel(points, centres)`` of each group; a centre (with ``subs``) goes to all groups of its shard."""
        left = self.rows.withColumns(extra) if extra else self.rows
        right = centres.withColumn("sub", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)))
        return left.groupBy("shard", "sub").cogroup(right.groupBy("shard", "sub")).applyInArrow(kernel, schema)

    def lower(self, centres: DataFrame, metric: str) -> None:
        """Carry each point's distance to the nearest of ``centres`` from now on; the lineage ends at a written table."""
        schema = "id long, v array<double>, shard int, w double, subs int, sub int, d0 double"
        rows, path = write_table(self.with_centres(centres, _lower_kernel(metric), schema))
        self.rows.unpersist()
        self.tables.append(path)
        self.rows = self._grouped(rows)


def _nearest(points: pa.Table, centres: pa.Table, metric: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of a group, distance to the nearest centre (infinite without any), and its row in ``centres`` (-1)."""
    X = K.vectors(points.column("v"))
    if not centres.num_rows:
        return X, np.full(len(X), np.inf), np.full(len(X), -1)
    C = K.vectors(centres.column("v"), X.shape[1])
    d, at = K.nearest_arrays(X, np.zeros(len(X), np.int64), {0: C}, metric, max(1, STEP_DOUBLES // max(1, X.shape[1])))
    return X, d, at


def _distance(points: pa.Table, centres: pa.Table, metric: str) -> np.ndarray:
    return np.minimum(points.column("d0").to_numpy(), _nearest(points, centres, metric)[1])


def _lower_kernel(metric: str):
    names = ["id", "v", "shard", "w", "subs", "sub"]

    def kernel(points: pa.Table, centres: pa.Table) -> pa.Table:
        if not points.num_rows:
            return points.select([*names, "d0"])
        return points.select(names).append_column("d0", pa.array(_distance(points, centres, metric)))
    return kernel


CANDIDATE = "key double, " + CENTRE


def _pick_kernel(mode: str, metric: str):
    """The group's candidate for its shard's next centre: the smallest (key, id)."""
    names = ["shard", "subs", "id", "v"]

    def kernel(points: pa.Table, centres: pa.Table) -> pa.Table:
        best = None
        if points.num_rows:
            d = _distance(points, centres, metric)
            ok, key = d > 0, -d
            if mode == "seed":
                w = points.column("w").to_numpy()
                ok &= w > 0
                with np.errstate(divide="ignore", invalid="ignore"):
                    key = -np.log(points.column("u").to_numpy()) / (w * d)
            at = np.flatnonzero(ok)
            if len(at):
                at = at[key[at] == key[at].min()]
                best = at[np.argmin(points.column("id").to_numpy()[at])]
        row = points.select(names).slice(0 if best is None else int(best), int(best is not None))
        return row.add_column(0, "key", pa.array([] if best is None else [key[best]], pa.float64()))
    return kernel


def centre_tables(points: ShardedPoints, k: int, first: Column, mode: str, seed: int = 0, metric: str = "euclidean",
                  every: int = 8) -> tuple[DataFrame, str]:
    """``(shard, subs, id, v, rank)``: up to ``k`` centres of each shard, one a round, as a written table; and its path.

    The first centre is the row with the smallest ``(first, id)``; the next ones go by ``mode`` as in
    ``plans.centers.center_rounds``. Every ``every`` rounds the points' distances are written, so a round compares
    with that many centres at most.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    spark = points.spark
    base = f"{ensure_checkpoint_dir(spark)}/centres-{uuid.uuid4().hex}"

    def write(candidates: DataFrame, r: int) -> int:
        """Write the best of each shard's candidates as its centre of rank r; how many there are."""
        best = candidates.groupBy("shard").agg(F.min(F.struct("key", "id", "v", "subs")).alias("b"))
        seen = Observation()
        out = best.select("shard", "b.subs", "b.id", "b.v").observe(seen, F.count(F.lit(1)).alias("n"))
        out.write.parquet(f"{base}/rank={r}")
        return seen.get["n"]

    def read(ranks: list[int]) -> DataFrame:
        return spark.read.schema(CENTRE).parquet(*(f"{base}/rank={r}" for r in ranks))

    groups = points.rows.groupBy("shard", "sub").agg(F.min(F.struct(first.alias("key"), "id", "v", "subs")).alias("b"))
    more, pending = write(groups.select("shard", "b.*"), 0), [0]
    for r in range(1, k):
        if not more:
            break
        u = {"u": seeded_uniform(seed, F.lit(r), F.col("id"))} if mode == "seed" else None
        more = write(points.with_centres(read(pending), _pick_kernel(mode, metric), CANDIDATE, u), r)
        pending.append(r)
        if len(pending) >= every and r < k - 1:
            points.lower(read(pending), metric)
            pending = []
    return spark.read.schema(CENTRE + ", rank int").parquet(base), base


SUMS = "shard int, cid int, s array<double>, sw double, n long"


def _sums_kernel(metric: str):
    """A group's weighted coordinate sums, weight sum and points for each centre it has points of."""
    def kernel(points: pa.Table, centres: pa.Table) -> pa.Table:
        out = {"shard": [], "cid": [], "s": [], "sw": [], "n": []}
        if points.num_rows and centres.num_rows:
            # ties go to the lowest index
            centres = centres.sort_by("cid")
            X, _, at = _nearest(points, centres, metric)
            w = points.column("w").to_numpy()
            cid = centres.column("cid").to_numpy()
            order = np.argsort(at, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], np.diff(at[order]) != 0]))
            wx = X[order] * w[order, None]
            out = {"shard": [points.column("shard")[0].as_py()] * len(start), "cid": cid[at[order][start]],
                   "s": list(np.add.reduceat(wx, start, axis=0)), "sw": np.add.reduceat(w[order], start),
                   "n": np.diff(np.append(start, len(order)))}
        kinds = {"shard": pa.int32(), "cid": pa.int32(), "s": pa.list_(pa.float64()), "sw": pa.float64(), "n": pa.int64()}
        return pa.table({c: pa.array(out[c], kinds[c]) for c in kinds})
    return kernel


def cluster_sums(points: ShardedPoints, centres: DataFrame, metric: str = "euclidean") -> DataFrame:
    """``(shard, cid, s, sw, n)`` over all groups of each shard; ``centres`` has (shard, subs, cid, v)."""
    part = points.with_centres(centres, _sums_kernel(metric), SUMS)
    return part.repartition("shard", "cid").mapInArrow(K.add_sums_kernel, SUMS)


def lloyd_tables(points: ShardedPoints, centres: DataFrame, iters: int, metric: str = "euclidean") -> DataFrame:
    """``centres`` (shard, subs, cid, v) after ``iters`` Lloyd rounds, as a table of ``points``; an empty cluster keeps its centre."""
    for _ in range(iters):
        moved = centres.join(cluster_sums(points, centres, metric), ["shard", "cid"], "left")
        mean = F.when(F.col("sw") > 0, F.expr("transform(s, x -> x / sw)")).otherwise(F.col("v"))
        centres, path = write_table(moved.select("shard", "subs", "cid", mean.alias("v")))
        points.tables.append(path)
    return centres
