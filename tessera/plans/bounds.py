"""Lloyd rounds with bounds that the points carry.

A written table holds for each point its cluster, an upper bound of the distance to that centre and a lower bound of the
distance to any other. By the triangle inequality a centre that moves changes the bounds by its shift at most; while
the bounds stay apart the point keeps its cluster without any comparison. The centres' shifts are measured from where they were when the table
was written, so a round writes nothing. The table is written anew, with moved bounds for the points that kept their cluster,
when a round had to compare more than ``RENEW`` of the points.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.functions.vectors import checked_point
from tessera.plans import centers as P
from tessera.plans import kernels as K
from tessera.plans.cells import CentreCells
from tessera.session import drop_table, write_table

# Share of compared points after which the bounds are written again; decides no result.
RENEW = 0.25
# Distances and shifts may be off by this share.
ERROR = 1e-12

BOUNDED = "v array<double>, w double, shard int, cid int, up double, low double"
SUMS = "shard int, cid int, s array<double>, sw double, n long"


def _two_nearest(X, shards, cells: dict, step: int):
    """Index of the nearest centre of each row's shard, its distance, and the next one's; -1 and infinite distances without a centre."""
    cid, up, low = np.full(len(X), -1, np.int32), np.full(len(X), np.inf), np.full(len(X), np.inf)
    for s in np.unique(shards):
        if int(s) in cells:
            rows = np.flatnonzero(shards == s)
            near, cid[rows], other = cells[int(s)].nearest_two(X[rows], step)
            up[rows], low[rows] = np.sqrt(near), np.sqrt(other)
    return cid, up, low


def _first_bounds(shared, shard_col: str | None, step: int):
    """Rows of ``BOUNDED`` from bare points."""
    def run(batches):
        cells = {s: CentreCells(C, "euclidean", K.sq_dists) for s, C in shared.value.items()}
        for b in batches:
            if b.num_rows:
                shards = K._shards(b, shard_col)
                yield _rows(b, shards, *_two_nearest(K.vectors(b.column("v")), shards, cells, step))
    return run


def _rows(b: pa.RecordBatch, shards, cid, up, low) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([b.column("v"), b.column("w"), pa.array(shards.astype(np.int32)), pa.array(cid, pa.int32()),
                                       pa.array(up), pa.array(low)], names=["v", "w", "shard", "cid", "up", "low"])


def _moved(shards, cid, up, low, shifts: dict):
    """Bounds after the centres' shifts ``{shard: (own, others)}``, widened by what rounding may lose."""
    for s in np.unique(shards):
        own, others = shifts.get(int(s), (None, None))
        rows = np.flatnonzero((shards == s) & (cid >= 0))
        if own is None or not len(rows):
            continue
        a, z = own[cid[rows]], others[cid[rows]]
        up[rows] = (up[rows] + a) * (1 + ERROR)
        held = np.isfinite(low[rows])
        low[rows[held]] -= z[held] + ERROR * (low[rows[held]] + z[held])
    return up, low


def _current(shared, step: int):
    """Function from a batch of ``BOUNDED`` to (vectors, shards, cluster, bounds, compared rows) under the centres as they are now."""
    centers, shifts = shared.value
    cells = {s: CentreCells(C, "euclidean", K.sq_dists) for s, C in centers.items()}

    def of(b: pa.RecordBatch):
        X, shards = K.vectors(b.column("v")), K._shards(b, "shard")
        cid = b.column("cid").to_numpy().copy()
        up, low = _moved(shards, cid, b.column("up").to_numpy().copy(), b.column("low").to_numpy().copy(), shifts)
        unsure = np.flatnonzero(~((up < low) | (cid < 0)))
        if len(unsure):
            cid[unsure], up[unsure], low[unsure] = _two_nearest(X[unsure], shards[unsure], cells, step)
        return X, shards, cid, up, low, len(unsure)
    return of


def _renew_kernel(shared, step: int):
    def run(batches):
        of = _current(shared, step)
        for b in batches:
            if b.num_rows:
                _, shards, cid, up, low, _ = of(b)
                yield _rows(b, shards, cid, up, low)
    return run


def _sums_kernel(shared, step: int):
    """Per task and cluster a row of sums, and one of cluster -1 with the number of compared rows."""
    def run(batches):
        of, acc, compared = _current(shared, step), {}, 0
        for b in batches:
            if not b.num_rows:
                continue
            X, shards, cid, _, _, n = of(b)
            compared += n
            K.add_to_sums(acc, X, shards, cid, b.column("w").to_numpy(zero_copy_only=False).astype(np.float64))
        acc[-1, -1] = (np.zeros(0), 0.0, compared)
        yield K._sums(acc)
    return run


def _shifts(base: dict, now: dict) -> dict:
    """Of each shard how far each centre went, and the farthest that any other one went."""
    out = {}
    for s, C in now.items():
        own = np.sqrt(((C - base[s]) ** 2).sum(axis=1))
        top = np.argsort(-own, kind="stable")[:2]
        others = np.full(len(own), own[top[0]])
        others[top[0]] = own[top[1]] if len(top) > 1 else 0.0
        out[s] = own, others
    return out


def carried_lloyd(points: DataFrame, centers: dict[int, list[list[float]]], iters: int, sharded: bool = False,
                  stats: dict | None = None) -> dict[int, list[list[float]]]:
    """``iters`` Lloyd rounds on prepared points ``(id, v, shard, w)``: the centres of ``lloyd_step``'s rounds.

    An empty cluster keeps its centre. ``stats`` gets the rows ``compared`` with centres in each round, and the last ``sizes``.
    The table of bounds lies in the checkpoint folder until the end.
    """
    spark = points.sparkSession
    now = P.center_arrays(centers)
    if iters <= 0 or not now:
        return centers
    step = P._step(P._width(now))
    cols = ["w"] + (["shard"] if sharded else [])
    src = points.select(checked_point("v").alias("v"), *cols)
    rows, path = write_table(src.mapInArrow(_first_bounds(P.share_centers(spark, now), "shard" if sharded else None, step), BOUNDED))
    base, counts, sizes = now, [], {}
    try:
        for r in range(iters):
            shared = P.share_centers(spark, (now, _shifts(base, now)))
            part = rows.mapInArrow(_sums_kernel(shared, step), SUMS)
            found = part.repartition("shard", "cid").mapInArrow(K.add_sums_kernel, SUMS).collect()
            compared = sum(x["n"] for x in found if x["cid"] < 0)
            sizes = {(x["shard"], x["cid"]): (x["sw"], x["n"]) for x in found if x["cid"] >= 0}
            total = sum(n for _, n in sizes.values())
            counts.append(total if r == 0 else compared)
            if r and r < iters - 1 and compared > RENEW * total:
                old, (rows, path) = path, write_table(rows.mapInArrow(_renew_kernel(shared, step), BOUNDED))
                drop_table(spark, old)
                base = now
            now = {s: C.copy() for s, C in now.items()}
            for x in found:
                if x["cid"] >= 0 and x["sw"] > 0:
                    now[x["shard"]][x["cid"]] = np.array(x["s"]) / x["sw"]
    finally:
        drop_table(spark, path)
    if stats is not None:
        stats["compared"], stats["sizes"] = counts, sizes
    return {s: C.tolist() for s, C in now.items()}
