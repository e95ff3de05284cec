"""Diameter of points in the plane by their convex hull.

The farthest two points are corners of the hull. A task keeps the hull of what it has read, the tasks' corners meet in
fewer tasks, and the few that remain are compared with each other (or, if they are many, by the block index).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tessera.functions.vectors import checked_point
from tessera.plans import kernels as K
from tessera.plans.pairs import PairIndex
from tessera.session import drop_table, write_table

# Corners that one task compares with each other at most.
CORNERS = 4096
# Directions whose extreme points are taken first; what lies inside their polygon is no corner.
DIRECTIONS = 16


def _outside(P: np.ndarray) -> np.ndarray:
    """Points not clearly inside the polygon of the extreme points in some directions."""
    angle = 2 * np.pi * np.arange(DIRECTIONS) / DIRECTIONS
    extreme = P[np.argmax(P @ np.vstack([np.cos(angle), np.sin(angle)]), axis=0)]
    side = np.roll(extreme, -1, axis=0) - extreme
    real = (side != 0).any(axis=1)
    if real.sum() < 3:
        return P
    scale = np.abs(P).max() + 1.0
    inside = np.ones(len(P), bool)
    for q, s in zip(extreme[real], side[real]):
        inside &= s[0] * (P[:, 1] - q[1]) - s[1] * (P[:, 0] - q[0]) > 1e-9 * scale * scale
    return P[~inside]


def hull(P: np.ndarray) -> np.ndarray:
    """Corners of the convex hull of distinct points, by a monotone chain."""
    P = np.unique(_outside(P) if len(P) > 4 * DIRECTIONS else P, axis=0)
    if len(P) < 3:
        return P

    def chain(points) -> list:
        out: list = []
        for x, y in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (y - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (x - out[-2][0]):
                out.pop()
            out.append((x, y))
        return out

    rows = P.tolist()
    return np.array(chain(rows)[:-1] + chain(rows[::-1])[:-1])


def hull_kernel(batches):
    """The corners of all points of a task."""
    seen = np.zeros((0, 2))
    for b in batches:
        if b.num_rows:
            seen = hull(np.vstack([seen, K.vectors(b.column("v"), 2)]))
    offsets = pa.array(2 * np.arange(len(seen) + 1), pa.int32())
    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(seen.reshape(-1)))], names=["v"])


def widest_kernel(batches):
    """The largest distance of a task's points from each other; 0 for fewer than two."""
    P = np.vstack([np.zeros((0, 2)), *(K.vectors(b.column("v"), 2) for b in batches if b.num_rows)])
    top = max((float(K.sq_dists(P[s:s + 512], P).max()) for s in range(0, len(P), 512)), default=0.0)
    yield pa.RecordBatch.from_arrays([pa.array([np.sqrt(top)])], names=["mpd"])


def diameter(points: DataFrame) -> DataFrame:
    """One row ``mpd``: the largest distance of two of the 2-D points ``v``, 0 for fewer than two; in O(n log n)."""
    spark = points.sparkSession
    par = spark.sparkContext.defaultParallelism
    corners = points.select(checked_point("v").alias("v")).mapInArrow(hull_kernel, "v array<double>")
    seen = Observation()
    few, path = write_table(corners.repartition(par).mapInArrow(hull_kernel, "v array<double>").observe(seen, F.count(F.lit(1)).alias("n")))
    try:
        n = seen.get["n"]
        if n > CORNERS * par:
            with PairIndex(few.select(F.monotonically_increasing_id().alias("id"), "v"), n=n) as index:
                return spark.createDataFrame([(index.farthest()[0],)], "mpd double")
        last = few.repartition(1).mapInArrow(hull_kernel, "v array<double>")
        left, path2 = write_table(last)
        try:
            if left.count() > CORNERS:
                with PairIndex(left.select(F.monotonically_increasing_id().alias("id"), "v")) as index:
                    return spark.createDataFrame([(index.farthest()[0],)], "mpd double")
            value = left.repartition(1).mapInArrow(widest_kernel, "mpd double").first()[0]
            return spark.createDataFrame([(value,)], "mpd double")
        finally:
            drop_table(spark, path2)
    finally:
        drop_table(spark, path)
