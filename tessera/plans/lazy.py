"""Farthest-first centres by lazily opened blocks in space.

The points are written once by the cells of a k-d tree. The driver keeps for each block its box and the largest distance
of its points to the centres, which only falls. A new centre leaves a block as it is if its box is not nearer than that
distance. Of the others, which now have a bound only, a round opens those that may hold the next centre, from the largest
bound down. An opened block is compared with the centres that may be nearest to one of its points, so nothing is carried
with the points and no round writes a table. (What is saved is reading; an opened point may be compared with several
centres where a plain round compares it with the last ones.)
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import checked_point
from tessera.plans import centers as P
from tessera.plans import kernels as K
from tessera.plans.cells import SLACK, cell_of, farthest_sq, nearest_sq, used_coordinates
from tessera.plans.pairs import block_boxes, of_blocks, space_cuts, written_blocks
from tessera.session import drop_table

# Centre numbers that are sent to the blocks of a batch, at most (16 MB), while it has more than one block.
BATCH_CENTERS = 1 << 22


def _assign_kernel(shared, metric: str):
    """Rows ``(block, id, v)`` with whole vectors."""
    def run(batches):
        dim, cut = shared.value
        for b in batches:
            if b.num_rows:
                cell = cell_of(used_coordinates(K.vectors(b.column("v")), metric), dim, cut)
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), b.column("id"), b.column("v")], names=["block", "id", "v"])
    return run


def _open_kernel(shared, metric: str, step: int):
    """Per task and opened block the point farthest from its centres, the smallest id among equals; none at distance 0."""
    def run(batches):
        C, near = shared.value
        centers = K.searched({block: C[at] for block, at in near.items()}, metric)
        best = K._Best()
        for b in batches:
            block = b.column("block").to_numpy()
            at = np.flatnonzero(np.isin(block, list(near)))
            if not len(at):
                continue
            X, block = K.vectors(b.column("v"))[at], block[at].astype(np.int64)
            d, _ = K.nearest_arrays(X, block, centers, metric, step)
            far = np.flatnonzero(d > 0)
            best.offer(block[far], -d[far], b.column("id").to_numpy()[at[far]], b.column("v").take(pa.array(at[far])))
        yield best.batch(pa.float64())
    return run


class LazyCenters:
    """Farthest-first centres of points ``(id, v)``; a context manager, since it keeps a table of the points by block.

    ``rows`` counts the points of the opened blocks, ``compared`` the distances at most, ``jobs`` the batches.
    """

    def __init__(self, points: DataFrame, metric: str = "euclidean", n: int | None = None, blocks: int | None = None):
        self.spark, self.metric = points.sparkSession, metric
        self.rows = self.compared = self.jobs = 0
        pts = points.select(F.col("id").cast("long").alias("id"), checked_point("v").alias("v"))
        self.n = pts.count() if n is None else n
        dim, cut, *_ = space_cuts(pts, metric, self.n, blocks)
        self.table, self.path = written_blocks(pts, self.n, _assign_kernel, dim, cut, metric)
        boxes = block_boxes(self.table)
        self.block = np.array([r["block"] for r in boxes], np.int64)
        self.place = {int(b): i for i, b in enumerate(self.block)}
        self.size = np.array([r["n"] for r in boxes], np.int64)
        self.width = len(boxes[0]["lo"]) if boxes else 0
        if any(len(r["lo"]) != self.width for r in boxes):
            raise ValueError("points of unequal dimension")
        if boxes:
            self.lo, self.hi = (used_coordinates(np.array([r[k] for r in boxes], float), metric) for k in ("lo", "hi"))
        self.centers: list[tuple[int, list[float]]] = []
        # largest distance of a block's points, or a bound of it; known: which of the two
        self.most, self.known = np.full(len(boxes), np.inf), np.zeros(len(boxes), bool)
        self.top: dict[int, tuple[int, list[float]]] = {}
        # least of the largest distances (squared) from a centre to a block: a centre farther than this is no point's nearest
        self.reach = np.full(len(boxes), np.inf)
        self.nearest = np.zeros((0, len(boxes)))

    def __enter__(self):
        return self

    def __exit__(self, *_):
        drop_table(self.spark, self.path)

    def first(self) -> tuple[int, list[float]] | None:
        """The point of the smallest id."""
        r = self.table.agg(F.min(F.struct("id", "v")).alias("r")).first()["r"]
        return (int(r["id"]), list(r["v"])) if r else None

    def add(self, ident: int, v: list[float]) -> None:
        """A new centre: lowers the bounds of the blocks that it may come near."""
        self.centers.append((ident, v))
        c = used_coordinates(np.array([v], float), self.metric)
        near = nearest_sq(c, self.lo, self.hi)[0]
        far = np.array([farthest_sq(c, lo, hi)[0] for lo, hi in zip(self.lo, self.hi)])
        self.reach = np.minimum(self.reach, far)
        self.nearest = np.vstack([self.nearest, near])
        touched = K.metric_value(near, self.metric) / SLACK < self.most
        self.known &= ~touched
        self.most = np.minimum(self.most, K.metric_value(far, self.metric) * SLACK)

    def farthest(self) -> tuple[int, list[float]] | None:
        """The point farthest from the centres, the smallest id among equals; None if all points equal centres."""
        par = self.spark.sparkContext.defaultParallelism
        batch = max(16, 2 * par)
        while True:
            best = float(self.most[self.known].max(initial=0.0))
            todo = np.flatnonzero(~self.known & (self.most >= best) & (self.most > 0))
            if not len(todo):
                break
            self._open(todo[np.argsort(-self.most[todo], kind="stable")][:batch])
            batch *= 4
        if best <= 0:
            return None
        return min(self.top[int(i)] for i in np.flatnonzero(self.known & (self.most == best)))

    def _open(self, blocks: np.ndarray) -> None:
        near = [np.flatnonzero(self.nearest[:, i] <= self.reach[i]).astype(np.int32) for i in blocks]
        sizes = np.cumsum([len(x) for x in near])
        blocks = blocks[:max(1, int(np.searchsorted(sizes, BATCH_CENTERS, side="right")))]
        C = P.center_arrays({0: [v for _, v in self.centers]})[0]
        shared = P.share_centers(self.spark, (C, {int(self.block[i]): x for i, x in zip(blocks, near)}))
        cand = of_blocks(self.table, [int(self.block[i]) for i in blocks]).mapInArrow(
            _open_kernel(shared, self.metric, P._step(self.width)), P.PICK_SCHEMA)
        found = P._winners(cand, P.PICK_SCHEMA).collect()
        self.jobs += 1
        self.rows += int(self.size[blocks].sum())
        self.compared += int(sum(self.size[i] * len(x) for i, x in zip(blocks, near)))
        self.most[blocks], self.known[blocks] = 0.0, True
        for r in found:
            i = self.place[r["shard"]]
            self.most[i], self.top[i] = -r["key"], (int(r["id"]), list(r["v"]))
