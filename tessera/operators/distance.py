"""Distance operators over points ``(id, v ARRAY<DOUBLE>)``.

Pair distances are Catalyst expressions. All-pairs statistics (exact diameter,
average distance) run on the block-pair plan: B hashed blocks, one group per
block pair after a single exchange, reduced in numpy to one row each — no pair
rows are materialized.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import checked_point, distance_to_literal, metric_distance, seeded_key
from tessera.plans.blocks import block_count_for, block_pair_max, block_pair_sums
from tessera.plans import kernels as K
from tessera.plans.centers import DRIVER_LIMIT, max_distance_to, spread_and_persist, vector_dim
from tessera.plans.hull import diameter
from tessera.plans.pairs import PairIndex
from tessera.session import write_table

# So many points are compared without an index in space.
FEW_POINTS = 4096


def pair_distance(points: DataFrame, pairs: DataFrame, a_col: str = "id_a", b_col: str = "id_b",
                  metric: str = "euclidean", dim: int | None = None) -> DataFrame:
    """Distance for every row of a pair table ``(a_col, b_col)`` of point ids.

    Both lookups are equi-joins on the point id; unequal dimensions raise.
    """
    a = points.select(F.col("id").alias(a_col), F.col("v").alias("_va"))
    b = points.select(F.col("id").alias(b_col), F.col("v").alias("_vb"))
    joined = pairs.join(a, a_col).join(b, b_col)
    return joined.select(a_col, b_col, metric_distance("_va", "_vb", metric, dim).alias("d"))


def successor_pairs(points: DataFrame) -> DataFrame:
    """Pairs ``(id, id + 1)`` present in the table: a data-derived pair table.

    An equi-join, so it partitions by key (a global ordering window would run
    in one task).
    """
    ids = points.select(F.col("id").alias("id_a"))
    nxt = points.select(F.col("id").alias("id_b"))
    return ids.join(nxt, F.col("id_b") == F.col("id_a") + 1)


def exact_mpd(points: DataFrame, blocks: int | None = None, stats: dict | None = None) -> DataFrame:
    """One row ``mpd``: the exact maximum pairwise distance, 0 for < 2 points.

    Few points are compared in blocks of any kind (also if ``blocks`` says how many). Of more points in the plane the
    ends are corners of the convex hull; others go by the index of blocks in space, which opens the pairs of blocks whose bound beats
    the best pair; ``stats`` then tells the pairs ``compared`` and the ``jobs``.
    """
    if blocks is None:
        n, dim = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
        if n > FEW_POINTS and dim == 2:
            return diameter(points)
        if n > FEW_POINTS:
            with PairIndex(points, n=n) as index:
                far = index.farthest()
                if stats is not None:
                    stats.update(compared=index.compared, jobs=index.jobs)
            return points.sparkSession.createDataFrame([(far[0],)], "mpd double")
        blocks = block_count_for(points, n, dim=dim)
    per_block = block_pair_max(points, "euclidean", blocks=blocks)
    return per_block.agg(F.coalesce(F.max("d"), F.lit(0.0)).alias("mpd"))


def pruned_survivors(points: DataFrame, dim: int | None = None) -> DataFrame:
    """Points that can still be an end of the farthest pair.

    Pivot c = centroid, r(x) = d(x, c), p = the point of largest r (r_max),
    LB = max_y d(p, y), a real pair distance. Any pair at distance >= LB has
    both ends with r(x) + r_max >= LB, so the others are dropped. Exact; a
    tolerance of 1e-9 relative keeps rounding from dropping a true end.
    Three one-row aggregates and a filter, all JVM expressions.
    """
    if dim is None:
        dim = vector_dim(points)
    if dim is None:
        return points
    if dim > DRIVER_LIMIT:
        raise ValueError("dimension too large")
    cen = points.agg(*[F.avg(F.col("v")[i]).alias(f"c{i}") for i in range(dim)]).collect()[0]
    c = [float(cen[f"c{i}"]) for i in range(dim)]
    with_r = points.withColumn("r", distance_to_literal("v", c))
    far = with_r.agg(F.max_by(F.struct("id", "v", "r"), F.struct("r", -F.col("id"))).alias("p")).collect()[0]["p"]
    r_max, p_vec = float(far["r"]), list(far["v"])
    lb = points.agg(F.max(distance_to_literal("v", p_vec)).alias("lb")).collect()[0]["lb"]
    lb = float(lb or 0.0)
    tol = 1e-9 * max(lb, 1.0)
    return with_r.where(F.col("r") + F.lit(r_max) >= F.lit(lb - tol)).drop("r")


def exact_mpd_pruned(points: DataFrame, dim: int | None = None) -> DataFrame:
    """Exact MPD after triangle-inequality pruning; same answer as ``exact_mpd``.

    The input is persisted for its four passes; the survivors (few in low
    dimension) feed the block plan.
    """
    pts = spread_and_persist(points.select("id", checked_point("v").alias("v")))
    try:
        # one row, written so that the points can leave the cache
        return write_table(exact_mpd(pruned_survivors(pts, dim)))[0]
    finally:
        pts.unpersist()


def sample_k(points: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k rows uniformly without replacement: the k smallest ``md5('seed:id')``.

    Independent of partitioning; planned as a top-k (TakeOrderedAndProject).
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    key = seeded_key(seed, F.col("id"))
    return points.withColumn("_key", key).orderBy("_key", "id").limit(k).drop("_key")


def two_approx_mpd(points: DataFrame, k: int, seed: int = 42, dim: int | None = None) -> DataFrame:
    """One row ``mpd_lb``: max over x in S and s in a k-sample of d(x, s).

    At least half the diameter. The sample (k vectors, size-checked) travels
    to an Arrow kernel as a broadcast, so the pass over S is one scan. k must be under the number of points.
    """
    if k <= 0:
        raise ValueError("k must be positive")
    sample = [list(r["v"]) for r in sample_k(points, k, seed).select("v").collect()]
    if len(sample) == k and points.limit(k + 1).count() == k or 0 < len(sample) < k:
        raise ValueError(f"the sample of {k} must be smaller than the point set")
    if not sample:
        return points.sparkSession.createDataFrame([(0.0,)], "mpd_lb double")
    return max_distance_to(points, sample, dim).select(F.coalesce("m", F.lit(0.0)).alias("mpd_lb"))


def avg_pairwise_distance(points: DataFrame, blocks: int | None = None,
                          metric: str = "euclidean") -> DataFrame:
    """One row ``avg_d``: mean distance over unordered pairs; NULL for < 2 points.

    The squared metric needs no pairs: their sum is n times the points' squared deviations from their mean, which
    tasks add up without cancellation and no point is shuffled. The others compare all pairs of blocks.
    """
    if metric == "sq_drop_last" and blocks is None:
        schema = "n long, mean array<double>, m2 double"
        part = points.select(checked_point("v").alias("v")).mapInArrow(K.moments_kernel, schema)
        # a row for each task
        whole = part.repartition(1).mapInArrow(K.add_moments_kernel, schema)
        return whole.agg(F.max(F.when(F.col("n") > 1, 2 * F.col("m2") / (F.col("n") - 1))).alias("avg_d"))
    sums = block_pair_sums(points, metric, blocks=blocks)
    return sums.agg((F.sum("sum_d") / F.nullif(F.sum("n_pairs"), F.lit(0))).alias("avg_d"))


def distinct_points(points: DataFrame) -> DataFrame:
    """Deduplicate equal points, keeping the smallest id: ``(id, v)``.

    A map-side partial ``min`` makes a point repeated a million times cost one
    row per map task in the shuffle.
    """
    return points.groupBy("v").agg(F.min("id").alias("id")).select("id", "v")


def point_count(points: DataFrame) -> DataFrame:
    return points.agg(F.count(F.lit(1)).alias("n_points"))
