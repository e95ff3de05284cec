"""Farthest pairs by a block index in space: bounds of block pairs, opened best first.

A k-d tree over a bounded sample cuts space into cells; the points of a cell are a block, with its bounding box. The boxes
bound the distance of any two points of two blocks. Pairs of blocks are opened from the largest bound down, a batch of
them as one job, until no bound reaches the best pair found; of an opened pair only points travel whose distance
to the other block's box reaches that pair. Neighbouring blocks form bands, and a point travels once to each pair of bands
that opens a pair of its block. Boxes that tell little (many dimensions) open all pairs of blocks: then that is once for each
band, and a batch that would move most of it opens all that is left. The table of block pairs stays on the driver (``MAX_BLOCKS`` bounds it whatever
the points): their bounds, and the farthest pair of those that were opened. So the next farthest pair without some
points, as greedy matching needs it, only opens pairs that lost theirs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import checked_point
from tessera.plans import kernels as K
from tessera.plans.cells import SLACK, cell_of, farthest_sq, kd_cuts, used_coordinates
from tessera.session import drop_table, write_table

# Blocks at most: 2 million block pairs on the driver.
MAX_BLOCKS = 2048
# Points of a block, about, while there are fewer blocks.
BLOCK_POINTS = 512
# Sampled points for each block; they place the cuts and decide no result.
SAMPLE_PER_BLOCK = 16
# Points of a side in a task's group at most, about: a group compares a billion pairs. A point travels once for each side.
SIDE_POINTS = 1 << 15
# Scalar differences held at once.
CHUNK_ELEMS = 1 << 22


def _reached(X: np.ndarray) -> float:
    """A squared distance that some two of the rows have: from the mean to the farthest row, from there to the farthest, and once more."""
    if len(X) < 2:
        return -1.0
    at, best = X.mean(axis=0), 0.0
    for sweep in range(3):
        sq = ((X - at) ** 2).sum(axis=1)
        at = X[np.argmax(sq)]
        best = max(best, float(sq.max())) if sweep else best
    return best / SLACK


def box_bounds(lo: np.ndarray, hi: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Largest squared distance of points in boxes a and b."""
    out = np.empty(len(a))
    step = max(1, CHUNK_ELEMS // max(1, lo.shape[1]))
    for s in range(0, len(a), step):
        i, j = a[s:s + step], b[s:s + step]
        far = np.maximum(hi[i] - lo[j], hi[j] - lo[i])
        out[s:s + step] = np.einsum("ij,ij->i", far, far) * SLACK
    return out


def _assign_kernel(shared, metric: str):
    """Rows ``(block, id, v)``; ``v`` has the coordinates of the metric only."""
    def run(batches):
        dim, cut = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            X = used_coordinates(K.vectors(b.column("v")), metric)
            offsets = pa.array(np.arange(len(X) + 1) * X.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell_of(X, dim, cut), pa.int32()), b.column("id"), pa.ListArray.from_arrays(offsets, pa.array(X.reshape(-1)))],
                names=["block", "id", "v"])
    return run


BOX = "block int, n long, lo array<double>, hi array<double>"


def _box_batch(boxes: dict) -> pa.RecordBatch:
    rows = sorted(boxes.items())
    return pa.RecordBatch.from_arrays(
        [pa.array([int(b) for b, _ in rows], pa.int32()), pa.array([int(r[0]) for _, r in rows], pa.int64()),
         *(pa.array([r[i].tolist() for _, r in rows], pa.list_(pa.float64())) for i in (1, 2))], names=["block", "n", "lo", "hi"])


def _join_box(boxes: dict, block: int, n: int, lo: np.ndarray, hi: np.ndarray) -> None:
    had = boxes.get(block)
    if had is not None and len(had[1]) != len(lo):
        raise ValueError("points of unequal dimension")
    boxes[block] = (n, lo, hi) if had is None else (had[0] + n, np.minimum(had[1], lo), np.maximum(had[2], hi))


def boxes_kernel(batches):
    """A task's count and bounding box of each block."""
    boxes: dict = {}
    for b in batches:
        if b.num_rows:
            X, block = K.vectors(b.column("v")), b.column("block").to_numpy()
            order = np.argsort(block, kind="stable")
            start = np.flatnonzero(np.concatenate([[True], np.diff(block[order]) != 0]))
            lo, hi = np.minimum.reduceat(X[order], start, axis=0), np.maximum.reduceat(X[order], start, axis=0)
            for f, n, low, high in zip(order[start], np.diff(np.append(start, len(order))), lo, hi):
                _join_box(boxes, int(block[f]), int(n), low, high)
    yield _box_batch(boxes)


def add_boxes_kernel(batches):
    boxes: dict = {}
    for b in batches:
        for r in b.to_pylist():
            _join_box(boxes, r["block"], r["n"], np.array(r["lo"]), np.array(r["hi"]))
    yield _box_batch(boxes)


SIDE = "task int, p int, q int, a int, b int, side int, block int, id long, v array<double>"


def _all_reach(lo: np.ndarray, hi: np.ndarray, i: int, js: np.ndarray, floor: float) -> np.ndarray:
    """Which boxes of ``js`` have a point at least ``floor`` (squared) away from wherever in box i."""
    centre, half = (lo[js] + hi[js]) / 2, (hi[js] - lo[js]) / 2
    least = np.maximum(np.maximum(lo[i] - centre, centre - hi[i]), 0.0) + half
    return np.einsum("ij,ij->i", least, least) >= floor * SLACK


class _Opened:
    """What the tasks of a batch know: the opened block pairs, the blocks' boxes and bands, and the points that are used."""

    def __init__(self, index: PairIndex, pairs: np.ndarray, floor: float):
        self.lo, self.hi, self.band, self.subs, self.floor = index.lo, index.hi, index.band, index.subs, floor
        self.used = np.array(index.used, np.int64)
        self.place = np.full(int(index.block.max()) + 1, -1, np.int64)
        self.place[index.block] = np.arange(len(index.block))
        opened = np.zeros((len(self.band), len(self.band)), bool)
        opened[index.a[pairs], index.b[pairs]] = opened[index.b[pairs], index.a[pairs]] = True
        self.bits = np.packbits(opened, axis=1)
        # groups of a pair of bands are numbered from ``first`` on
        p, q = np.unique(np.stack([self.band[index.a[pairs]], self.band[index.b[pairs]]]), axis=1)
        size = self.subs[p] * self.subs[q]
        self.first = np.zeros((len(self.subs), len(self.subs)), np.int64)
        self.first[p, q] = np.cumsum(size) - size
        self.groups = int(size.sum())

    def of(self, i: int) -> np.ndarray:
        """Blocks that are opened with block i."""
        return np.flatnonzero(np.unpackbits(self.bits[i], count=len(self.band)))


def _sides_kernel(shared, parts: int):
    """Rows of the opened pairs of bands: each point that can be an end of a pair of at least ``floor`` (squared).

    A block of many points is dealt to sub-blocks by id; a row goes to the groups (p, q, a, b) of its own.
    """
    def run(batches):
        o = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            block, ids = o.place[b.column("block").to_numpy()], b.column("id").to_numpy()
            X = K.vectors(b.column("v"))
            free = ~np.isin(ids, o.used)
            sub_key = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            sent: dict[tuple[int, int], list] = {}
            for i in np.unique(block):
                mine, js = np.flatnonzero((block == i) & free), o.of(i)
                whole = _all_reach(o.lo, o.hi, i, js, o.floor)
                for band in np.unique(o.band[js]):
                    there = o.band[js] == band
                    if whole[there].any():
                        at = mine
                    else:
                        reach = np.zeros(len(mine), bool)
                        for j in js[there]:
                            reach |= farthest_sq(X[mine], o.lo[j], o.hi[j]) >= o.floor
                        at = mine[reach]
                    if len(at):
                        sent.setdefault((int(o.band[i]), int(band)), []).append(at)
            for (own, band), rows in sent.items():
                at = np.concatenate(rows)
                sub = (sub_key[at] % np.uint64(o.subs[own])).astype(np.int64)
                p, q = min(own, band), max(own, band)
                for other in range(o.subs[band]):
                    if own == band:
                        # within a band: sub-blocks (a, c) with a <= c
                        a, c, side = np.minimum(sub, other), np.maximum(sub, other), (other < sub).astype(np.int32)
                    else:
                        a, c = (sub, np.full(len(at), other)) if own == p else (np.full(len(at), other), sub)
                        side = np.full(len(at), int(own == q), np.int32)
                    task = (o.first[p, q] + a * o.subs[q] + c) % parts
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(task, pa.int32()), pa.array(np.full(len(at), p), pa.int32()), pa.array(np.full(len(at), q), pa.int32()),
                         pa.array(a, pa.int32()), pa.array(c, pa.int32()), pa.array(side, pa.int32()), pa.array(block[at], pa.int32()),
                         b.column("id").take(pa.array(at)), b.column("v").take(pa.array(at))],
                        names=["task", "p", "q", "a", "b", "side", "block", "id", "v"])
    return run


FOUND = "pair int, id_a long, id_b long, sq double, compared long"


def farthest_of(X: np.ndarray, x_ids: np.ndarray, Y: np.ndarray, y_ids: np.ndarray, same: bool, shift: np.ndarray) -> tuple[float, int, int] | None:
    """``(sq, low id, high id)`` of the farthest pair of a row of each (``same``: of two rows), the smallest ids among equals.

    A matrix product of the points less ``shift`` tells which pairs can be farthest; those are compared by their differences.
    """
    if not len(X) or not len(Y):
        return None
    products = K.SqProducts(X, Y, shift)
    best = None
    step = max(1, CHUNK_ELEMS // len(Y))
    for s in range(0, len(X), step):
        sq = products.sq(slice(s, s + step), slice(None)) if products.exact_to is not None else K.sq_dists(X[s:s + step], Y)
        doubt = products.exact_to or 0.0
        if same:
            sq[np.arange(len(Y))[None, :] <= np.arange(s, s + len(sq))[:, None]] = -np.inf
        top = sq.max()
        if top == -np.inf or best is not None and top + doubt < best[0]:
            continue
        i, j = np.nonzero(sq >= top - 2 * doubt)
        pieces = max(1, CHUNK_ELEMS // X.shape[1])
        for t in range(0, len(i), pieces):
            p, q = i[t:t + pieces] + s, j[t:t + pieces]
            exact = K.paired_sq(X[p], Y[q])
            far = exact == exact.max()
            low, high = np.minimum(x_ids[p[far]], y_ids[q[far]]), np.maximum(x_ids[p[far]], y_ids[q[far]])
            o = np.lexsort((high, low))[0]
            cand = (float(exact.max()), int(low[o]), int(high[o]))
            if best is None or cand[0] > best[0] or cand[0] == best[0] and cand[1:] < best[1:]:
                best = cand
    return best


def _by_block(tbl: pa.Table, side: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of each block on a side."""
    block, ids, X = tbl.column("block").to_numpy(), tbl.column("id").to_numpy(), K.vectors(tbl.column("v"))
    order = side[np.argsort(block[side], kind="stable")]
    start = np.flatnonzero(np.concatenate([[True], np.diff(block[order]) != 0])) if len(order) else np.zeros(0, np.int64)
    return {int(block[order[f]]): (ids[order[f:e]], X[order[f:e]]) for f, e in zip(start, np.append(start[1:], len(order)))}


def _open_kernel(shared):
    """The farthest pair of each opened block pair in a group, and how many pairs were compared for it."""
    def kernel(key, tbl):
        o = shared.value
        p, q, a, b = (k.as_py() for k in key[1:])
        side = tbl.column("side").to_numpy()
        left = _by_block(tbl, np.flatnonzero(side == 0))
        same = p == q and a == b
        right = left if same else _by_block(tbl, np.flatnonzero(side == 1))
        blocks = len(o.band)
        out: list[list] = [[], [], [], [], []]
        for i, (x_ids, X) in left.items():
            js = o.of(i)
            js = js[(js >= i) & np.isin(js, list(right))]
            whole = _all_reach(o.lo, o.hi, i, js, o.floor)
            for j, all_here in zip(js.tolist(), whole):
                y_ids, Y = right[j]
                x_keep = slice(None) if all_here else farthest_sq(X, o.lo[j], o.hi[j]) >= o.floor
                within = same and i == j
                y_keep = x_keep if within else farthest_sq(Y, o.lo[i], o.hi[i]) >= o.floor
                u, v = X[x_keep], Y[y_keep]
                best = farthest_of(u, x_ids[x_keep], v, y_ids[y_keep], within, (o.lo[i] + o.hi[i]) / 2)
                if best is not None:
                    compared = len(u) * (len(u) - 1) // 2 if within else len(u) * len(v)
                    for column, value in zip(out, (i * blocks - i * (i - 1) // 2 + j - i, best[1], best[2], best[0], compared)):
                        column.append(value)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
        return pa.table({n: pa.array(c, k) for n, c, k in zip(("pair", "id_a", "id_b", "sq", "compared"), out, kinds)})
    return kernel


def space_cuts(pts: DataFrame, metric: str, n: int, blocks: int | None = None):
    """The k-d tree's cuts (dimension, value) of ``n`` points into ``blocks``, and the sampled vectors and ids that placed them."""
    if blocks is None:
        blocks = 1 << max(0, min(MAX_BLOCKS, -(-n // BLOCK_POINTS)) - 1).bit_length()
    sample, ids = np.zeros((0, 1)), np.zeros(0, np.int64)
    if blocks > 1:
        rows = pts.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_PER_BLOCK * blocks).toArrow()
        sample, ids = used_coordinates(K.vectors(rows.column("v")), metric), rows.column("id").to_numpy()
    return *kd_cuts(sample, blocks), sample, ids


def written_blocks(pts: DataFrame, n: int, kernel, dim: np.ndarray, cut: np.ndarray, metric: str) -> tuple[DataFrame, str]:
    """A table ``(block, id, v)`` of the points by ``kernel``, sorted, so that a batch skips the row groups of other blocks; and its path."""
    spark = pts.sparkSession
    cuts = spark.sparkContext.broadcast((dim, cut))
    par = spark.sparkContext.defaultParallelism
    if n < par << 20:
        pts = pts.repartition(par)
    return write_table(pts.mapInArrow(kernel(cuts, metric), "block int, id long, v array<double>").sortWithinPartitions("block"))


def block_boxes(rows: DataFrame) -> list:
    """Count and bounding box of each block, by block: one row for each."""
    boxes = rows.mapInArrow(boxes_kernel, BOX).repartition("block").mapInArrow(add_boxes_kernel, BOX).collect()
    return sorted(boxes, key=lambda r: r["block"])


def of_blocks(rows: DataFrame, blocks: list[int]) -> DataFrame:
    """The rows of some blocks, and others among them if there are many."""
    return rows.where(F.col("block").isin(blocks) if len(blocks) <= 64 else F.col("block").between(min(blocks), max(blocks)))


class PairIndex:
    """Farthest pairs of points ``(id, v)``; a context manager, since it keeps a table of the points by block.

    ``compared`` counts the pairs of points whose distance was computed, ``moved`` the rows that travelled for it at most, ``jobs`` the batches.
    """

    def __init__(self, points: DataFrame, metric: str = "euclidean", n: int | None = None, blocks: int | None = None):
        self.spark, self.metric = points.sparkSession, metric
        self.compared = self.moved = self.jobs = 0
        pts = points.select(F.col("id").cast("long").alias("id"), checked_point("v").alias("v"))
        if n is None:
            n = pts.count()
        self.used: list[int] = []
        dim, cut, self.sample, self.sample_ids = space_cuts(pts, metric, n, blocks)
        self.par = self.spark.sparkContext.defaultParallelism
        self.rows, self.path = written_blocks(pts, n, _assign_kernel, dim, cut, metric)
        boxes = block_boxes(self.rows)
        self.block = np.array([r["block"] for r in boxes], np.int64)
        self.size = np.array([r["n"] for r in boxes], np.int64)
        if len({len(r["lo"]) for r in boxes}) > 1:
            raise ValueError("points of unequal dimension")
        width = len(boxes[0]["lo"]) if boxes else 1
        self.lo, self.hi = (np.array([r[k] for r in boxes], float).reshape(len(boxes), width) for k in ("lo", "hi"))
        self.a, self.b = np.triu_indices(len(boxes))
        self.bound = box_bounds(self.lo, self.hi, self.a, self.b) if len(boxes) else np.zeros(0)
        alone = (self.a == self.b) & (self.size[self.a] < 2) if len(boxes) else np.zeros(0, bool)
        self.bound[alone] = -1.0
        # points that are not used
        self.free = self.size.copy()
        self.band, self.subs = self._bands()
        # farthest pair of an opened block pair; -1: none is known
        self.sq = np.full(len(self.a), -1.0)
        self.ends = np.zeros((len(self.a), 2), np.int64)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        drop_table(self.spark, self.path)

    def _bands(self) -> tuple[np.ndarray, np.ndarray]:
        """The band of each block, and the sub-blocks of each band: blocks side by side of at most ``SIDE_POINTS`` points, or one with more."""
        side = int(np.ceil(np.sqrt(8 * self.par)))
        most = min(SIDE_POINTS, max(BLOCK_POINTS, -(-int(self.size.sum()) // side)))
        band, points = np.zeros(len(self.size), np.int64), []
        for i, n in enumerate(self.size.tolist()):
            if points and points[-1] + n <= most:
                points[-1] += n
            else:
                points.append(n)
            band[i] = len(points) - 1
        return band, np.maximum(1, -(-np.array(points, np.int64) // SIDE_POINTS))

    def use(self, *ids: int) -> None:
        """Leave these points out from now on. Block pairs that lose their farthest pair keep its distance as their bound."""
        self.used.extend(ids)
        lost = (self.sq >= 0) & np.isin(self.ends, ids).any(axis=1)
        self.bound[lost], self.sq[lost] = self.sq[lost], -1.0
        # an id can have several rows
        for r in self.rows.where(F.col("id").isin([int(i) for i in ids])).groupBy("block").count().collect():
            self.free[np.searchsorted(self.block, r["block"])] -= r["count"]

    def _moved(self, pairs: np.ndarray) -> float:
        """Rows that travel at most if these block pairs are opened."""
        a, b = self.a[pairs], self.b[pairs]
        to = np.zeros((len(self.size), len(self.subs)), bool)
        to[a, self.band[b]] = to[b, self.band[a]] = True
        return float((to * self.size[:, None] * self.subs).sum())

    def farthest(self) -> tuple[float, int, int] | None:
        """``(distance, id_a, id_b)`` of the farthest pair of unused points, the smallest ids among equals; None without two."""
        batch = max(16, 2 * self.par)
        least = _reached(self.sample[~np.isin(self.sample_ids, self.used)])
        while True:
            best = float(self.sq.max()) if len(self.sq) else -1.0
            floor = max(best, least)
            todo = np.flatnonzero((self.sq < 0) & (self.bound >= max(floor, 0.0)))
            if not len(todo):
                break
            some = todo[np.argsort(-self.bound[todo], kind="stable")][:batch]
            # all that is left, if a batch moves most of that
            self._open(todo if 2 * self._moved(some) >= self._moved(todo) else some, floor)
            batch *= 4
        if best < 0:
            return None
        top = np.flatnonzero(self.sq == best)
        ends = min(map(tuple, self.ends[top].tolist()))
        return (best if self.metric == "sq_drop_last" else float(np.sqrt(best)), *ends)

    def _open(self, pairs: np.ndarray, floor: float) -> None:
        """Farthest pairs of some block pairs, where they reach ``floor`` or all points were compared; the others get a bound below it."""
        opened = _Opened(self, pairs, floor)
        shared = self.spark.sparkContext.broadcast(opened)
        # groups are dealt one by one: each is a task's work
        parts = max(1, min(opened.groups, 16 * self.par + opened.groups // 16))
        blocks = self.block[np.unique([self.a[pairs], self.b[pairs]])].tolist()
        sides = of_blocks(self.rows, blocks).mapInArrow(_sides_kernel(shared, parts), SIDE)
        best = sides.repartitionById(parts, F.col("task")).groupBy("task", "p", "q", "a", "b").applyInArrow(_open_kernel(shared), FOUND)
        found = best.groupBy("pair").agg(F.min(F.struct((-F.col("sq")).alias("sq"), "id_a", "id_b")).alias("m"), F.sum("compared").alias("compared"))
        found = found.select("pair", (-F.col("m.sq")).alias("sq"), "m.id_a", "m.id_b", "compared").toArrow()
        self.jobs += 1
        self.moved += self._moved(pairs)
        i, j = self.a[pairs], self.b[pairs]
        self.bound[pairs] = np.nextafter(floor, -1.0) if floor > 0 else -1.0
        self.bound[pairs[self._pairs_of(i, j) == 0]] = -1.0
        pair, sq, id_a, id_b, compared = (found.column(c).to_numpy() for c in ("pair", "sq", "id_a", "id_b", "compared"))
        self.compared += int(compared.sum())
        known = (sq >= floor) | (compared == self._pairs_of(self.a[pair], self.b[pair]))
        self.sq[pair[known]] = self.bound[pair[known]] = sq[known]
        self.ends[pair[known]] = np.stack([id_a[known], id_b[known]], axis=1)

    def _pairs_of(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Pairs of unused points of blocks i and j."""
        return np.where(i == j, self.free[i] * (self.free[i] - 1) // 2, self.free[i] * self.free[j])
