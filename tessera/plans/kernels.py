"""Arrow-batched numpy kernels for points against a small centre set.

Spark partitions the points; each task receives Arrow record batches, views
the vector column as an (n, d) float64 array without copying, and compares it
with the centres of each row's shard (a broadcast whose size the caller checks).
Kernels that reduce accumulate over the whole task and yield once: one candidate
per shard, or one row of sums per cluster. The same kernels then reduce the tasks'
rows after an exchange by shard, so no sort is planned.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib

import numpy as np
import pyarrow as pa

from tessera.plans.cells import CentreCells

# Scalar differences held at once while comparing a batch with its centres.
CHUNK_ELEMS = 1 << 22
# More centres of a shard than these are searched by cells, which changes no row.
MANY_CENTERS = 256


def vectors(col: pa.ChunkedArray | pa.Array, dim: int | None = None) -> np.ndarray:
    """(n, d) float64 view of a list<double> column; unequal sizes raise."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    n = len(arr)
    if n == 0:
        return np.zeros((0, dim or 0))
    if arr.null_count:
        raise ValueError("NULL point")
    offs = arr.offsets.to_numpy()
    lens = np.diff(offs)
    d = int(lens[0])
    if (lens != d).any() or (dim is not None and d != dim):
        raise ValueError("points of unequal dimension")
    vals = arr.values.slice(offs[0], offs[-1] - offs[0]).to_numpy(zero_copy_only=False)
    return vals.astype(np.float64, copy=False).reshape(n, d)


def sq_dists(X: np.ndarray, C: np.ndarray, metric: str = "euclidean") -> np.ndarray:
    """Exact squared distances (n, k) by direct differences, chunked."""
    if metric == "sq_drop_last":
        X, C = X[:, :-1], C[:, :-1]
    elif metric == "euclidean_2d":
        X, C = X[:, :2], C[:, :2]
    n, d = X.shape
    k = C.shape[0]
    out = np.empty((n, k))
    if d <= 8:
        out[:] = 0.0
        for j in range(d):
            diff = X[:, j, None] - C[None, :, j]
            out += diff * diff
        return out
    step = max(1, CHUNK_ELEMS // max(k * d, 1))
    for s in range(0, n, step):
        diff = X[s:s + step, None, :] - C[None, :, :]
        out[s:s + step] = np.einsum("ijk,ijk->ij", diff, diff)
    return out


def paired_sq(X: np.ndarray, Y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows one by one, as ``sq_dists`` computes them."""
    diff = X - Y
    if X.shape[1] > 8:
        return np.einsum("ij,ij->i", diff, diff)
    out = np.zeros(len(X))
    for j in range(X.shape[1]):
        out += diff[:, j] * diff[:, j]
    return out


@functools.cache
def one_thread() -> None:
    """Let numpy's matrix products run in the task's own thread: Spark has a task for each core, and threads of all of them would wait for each other."""
    try:
        with open("/proc/self/maps") as maps:
            paths = {line.split(maxsplit=5)[5].strip() for line in maps if "openblas" in line}
    except OSError:
        return
    for path in paths:
        library = ctypes.CDLL(path)
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(ctypes.c_int(1))
                break


class SqProducts:
    """Squared distances of the rows of X and Y by a matrix product of the points less ``shift``: fast, and off by at most ``exact_to``.

    That is None if norms are no finite numbers; then only differences tell.
    """

    def __init__(self, X: np.ndarray, Y: np.ndarray, shift: np.ndarray):
        one_thread()
        with np.errstate(all="ignore"):
            X, Y = X - shift, Y - shift
            x, y = np.einsum("ij,ij->i", X, X), np.einsum("ij,ij->i", Y, Y)
            reach = (np.sqrt(x.max(initial=0.0)) + np.sqrt(y.max(initial=0.0))) ** 2
        self.exact_to = float(4 * (X.shape[1] + 8) * np.finfo(float).eps * reach) if np.isfinite(reach) and reach < 1e300 else None
        if self.exact_to is not None:
            self.X = np.column_stack([-2 * X, x, np.ones(len(X))])
            self.Y = np.column_stack([Y, np.ones(len(Y)), y])

    def sq(self, rows: slice, columns: slice) -> np.ndarray:
        return self.X[rows] @ self.Y[columns].T


def metric_value(sq: np.ndarray, metric: str) -> np.ndarray:
    return sq if metric == "sq_drop_last" else np.sqrt(sq)


def searched(centers: dict[int, np.ndarray], metric: str) -> dict:
    """Centres by shard, those of shards with many in cells; for a task's batches."""
    return {s: CentreCells(C, metric, sq_dists) if len(C) > MANY_CENTERS else C for s, C in centers.items()}


def nearest_arrays(X: np.ndarray, shards: np.ndarray, centers: dict[int, np.ndarray],
                   metric: str, step: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """Distance to and index of the nearest centre of each row's shard.

    Ties go to the lowest index; rows whose shard has no centre get NaN / -1.
    ``step`` centres are compared at once, which bounds the memory and changes no result. Centres may come in cells (``searched``).
    """
    n = X.shape[0]
    d = np.full(n, np.nan)
    cid = np.full(n, -1, dtype=np.int32)
    order = np.argsort(shards, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], np.diff(shards[order]) != 0])) if n else np.zeros(0, np.int64)
    for a, b in zip(start, np.append(start[1:], n)):
        C = centers.get(int(shards[order[a]]))
        if C is None or len(C) == 0:
            continue
        rows = order[a:b]
        if isinstance(C, CentreCells):
            best, cid[rows] = C.nearest(X[rows], step)
            d[rows] = metric_value(best, metric)
            continue
        best = np.full(len(rows), np.inf)
        at = np.zeros(len(rows), dtype=np.int32)
        for k in range(0, len(C), step):
            sq = sq_dists(X[rows], C[k:k + step], metric)
            j = np.argmin(sq, axis=1)
            near = sq[np.arange(len(rows)), j]
            closer = near < best
            best[closer], at[closer] = near[closer], k + j[closer]
        cid[rows] = at
        d[rows] = metric_value(best, metric)
    return d, cid


def _shards(batch: pa.RecordBatch, shard_col: str | None) -> np.ndarray:
    if shard_col is None:
        return np.zeros(batch.num_rows, dtype=np.int64)
    return batch.column(shard_col).to_numpy(zero_copy_only=False).astype(np.int64)


def nearest_kernel(shared, shard_col: str | None, v_col: str, keep: list[str], d_name: str,
                   cid_name: str | None, metric: str, dim: int | None, step: int):
    """Rows of ``keep`` plus the nearest-centre distance (and index); ``shared`` broadcasts the centres."""
    def run(batches):
        centers = searched(shared.value, metric)
        for b in batches:
            X = vectors(b.column(v_col), dim)
            d, cid = nearest_arrays(X, _shards(b, shard_col), centers, metric, step)
            cols = [b.column(c) for c in keep]
            names = list(keep)
            cols.append(pa.array(d, pa.float64(), mask=np.isnan(d)))
            names.append(d_name)
            if cid_name:
                cols.append(pa.array(cid, pa.int32(), mask=cid < 0))
                names.append(cid_name)
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def _lowered(b: pa.RecordBatch, pending: dict[int, np.ndarray], metric: str, dim: int | None, step: int):
    """Vectors, shards and ``d0`` lowered by the pending centres of a batch."""
    X = vectors(b.column("v"), dim)
    sh = _shards(b, "shard")
    d0 = b.column("d0").to_numpy(zero_copy_only=False).astype(np.float64)
    dp, _ = nearest_arrays(X, sh, pending, metric, step)
    return X, sh, np.where(np.isnan(dp), d0, np.minimum(d0, np.nan_to_num(dp, nan=np.inf)))


class _Best:
    """The row with the smallest (key, id) of each shard, over all batches of a task.

    With a ``seed`` the md5 of ``seed:id`` decides between equal keys first; it is only made for those.
    """

    def __init__(self, seed: int | None = None):
        self.rows: dict[int, tuple] = {}
        self.seed = seed

    def _tie(self, i) -> str:
        return "" if self.seed is None else hashlib.md5(f"{self.seed}:{int(i)}".encode()).hexdigest()

    def offer(self, shards: np.ndarray, keys: np.ndarray, ids: np.ndarray, vecs: pa.Array) -> None:
        if not len(keys):
            return
        # the rows of a shard together, the smallest (key, id) first
        order = np.lexsort((ids, keys, shards))
        start = np.flatnonzero(np.concatenate([[True], np.diff(shards[order]) != 0]))
        for a, b in zip(start, np.append(start[1:], len(order))):
            s, low = int(shards[order[a]]), keys[order[a]]
            if s in self.rows and self.rows[s][0] < low:
                continue
            tied = order[a:a + 1] if self.seed is None else order[a:b][keys[order[a:b]] == low]
            mark, i, r = min((self._tie(ids[r]), ids[r], r) for r in tied)
            if s not in self.rows or (low, mark, i) < self.rows[s][:3]:
                self.rows[s] = (low, mark, i, vecs[int(r)].as_py())

    def batch(self, key_type: pa.DataType) -> pa.RecordBatch:
        out = sorted(self.rows.items())
        return pa.RecordBatch.from_arrays(
            [pa.array([int(s) for s, _ in out], pa.int32()), pa.array([int(r[2]) for _, r in out], pa.int64()),
             pa.array([r[3] for _, r in out], pa.list_(pa.float64())),
             pa.array([r[0].item() for _, r in out], key_type)],
            names=["shard", "id", "v", "key"])


def first_kernel(key_type: pa.DataType, seed: int | None = None):
    """Per task and shard the row with the smallest (key, id): picks among rows, and among tasks' picks."""
    def run(batches):
        best = _Best(seed)
        for b in batches:
            if b.num_rows:
                best.offer(_shards(b, "shard"), b.column("key").to_numpy(zero_copy_only=False),
                           b.column("id").to_numpy(zero_copy_only=False), b.column("v"))
        yield best.batch(key_type)
    return run


def pick_kernel(shared, mode: str, metric: str, dim: int | None, step: int):
    """Per task and shard one candidate for the next centre, as ``(shard, id, v, key)`` with the smallest key.

    Input columns: id, v, shard, w, d0 (and u for ``mode='seed'``).
    ``farthest``: key -d over d > 0. ``seed``: key -ln(u)/(w·d) over d > 0 and w > 0. Ties to the smallest id.
    """
    def run(batches):
        pending, best = shared.value, _Best()
        for b in batches:
            if not b.num_rows:
                continue
            ids = b.column("id").to_numpy(zero_copy_only=False)
            _, sh, d = _lowered(b, pending, metric, dim, step)
            if mode == "farthest":
                ok, key = d > 0, -d
            else:
                w = b.column("w").to_numpy(zero_copy_only=False).astype(np.float64)
                u = b.column("u").to_numpy(zero_copy_only=False).astype(np.float64)
                ok = (d > 0) & (w > 0)
                with np.errstate(divide="ignore", invalid="ignore"):
                    key = -np.log(u) / (w * d)
            at = np.nonzero(ok)[0]
            best.offer(sh[at], key[at], ids[at], b.column("v").take(pa.array(at)))
        yield best.batch(pa.float64())
    return run


def update_kernel(shared, metric: str, dim: int | None, cols: list[str], step: int):
    """Rows with ``d0`` lowered by the pending centres (for a written table)."""
    def run(batches):
        for b in batches:
            _, _, d = _lowered(b, shared.value, metric, dim, step)
            yield pa.RecordBatch.from_arrays([b.column(c) for c in cols] + [pa.array(d, pa.float64())], names=cols + ["d0"])
    return run


def _sums(acc: dict) -> pa.RecordBatch:
    rows = sorted(acc.items())
    return pa.RecordBatch.from_arrays(
        [pa.array([int(k[0]) for k, _ in rows], pa.int32()), pa.array([int(k[1]) for k, _ in rows], pa.int32()),
         pa.array([r[0].tolist() for _, r in rows], pa.list_(pa.float64())), pa.array([float(r[1]) for _, r in rows], pa.float64()),
         pa.array([int(r[2]) for _, r in rows], pa.int64())], names=["shard", "cid", "s", "sw", "n"])


def add_to_sums(acc: dict, X: np.ndarray, sh: np.ndarray, cid: np.ndarray, w: np.ndarray) -> None:
    """Add a batch to a task's sums ``{(shard, cluster): (s, sw, n)}``; rows of cluster -1 have none."""
    at = np.nonzero(cid >= 0)[0]
    if not len(at):
        return
    order = at[np.lexsort((cid[at], sh[at]))]
    new = np.concatenate([[True], (np.diff(sh[order]) != 0) | (np.diff(cid[order]) != 0)])
    first = np.nonzero(new)[0]
    wx = X[order] * w[order, None]
    for f, s, sw, n in zip(order[first], np.add.reduceat(wx, first, axis=0),
                           np.add.reduceat(w[order], first), np.diff(np.append(first, len(order)))):
        key = (int(sh[f]), int(cid[f]))
        had = acc.get(key)
        acc[key] = (s, sw, n) if had is None else (had[0] + s, had[1] + sw, had[2] + n)


def lloyd_kernel(shared, shard_col: str | None, metric: str, dim: int | None, step: int):
    """Per task and (shard, cluster) one row: weighted coordinate sums ``s``, weight sum ``sw``, points ``n``."""
    def run(batches):
        centers, acc = searched(shared.value, metric), {}
        for b in batches:
            X = vectors(b.column("v"), dim)
            sh = _shards(b, shard_col)
            w = b.column("w").to_numpy(zero_copy_only=False).astype(np.float64)
            _, cid = nearest_arrays(X, sh, centers, metric, step)
            add_to_sums(acc, X, sh, cid, w)
        yield _sums(acc)
    return run


def add_sums_kernel(batches):
    """Add up the tasks' rows of each (shard, cluster)."""
    acc: dict = {}
    for b in batches:
        for r in b.to_pylist():
            key, s = (r["shard"], r["cid"]), np.array(r["s"])
            had = acc.get(key)
            acc[key] = (s, r["sw"], r["n"]) if had is None else (had[0] + s, had[1] + r["sw"], had[2] + r["n"])
    yield _sums(acc)


def max_dist_kernel(shared, metric: str, dim: int | None, step: int):
    """Per task, the largest distance from any row to any of the centres."""
    def run(batches):
        centers, best = shared.value, None
        for b in batches:
            if b.num_rows == 0:
                continue
            X = vectors(b.column("v"), dim)
            for k in range(0, len(centers), step):
                m = float(metric_value(sq_dists(X, centers[k:k + step], metric).max(), metric))
                best = m if best is None else max(best, m)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([best], pa.float64())], names=["m"])
    return run


def _merged_moments(a, n: int, mean: np.ndarray, m2: float):
    """Count, mean and sum of squared deviations of two sets, from those of each."""
    if a is None:
        return n, mean, m2
    if len(a[1]) != len(mean):
        raise ValueError("points of unequal dimension")
    total, gap = a[0] + n, mean - a[1]
    return total, a[1] + gap * (n / total), a[2] + m2 + float(gap @ gap) * (a[0] * n / total)


def _moments_batch(a) -> pa.RecordBatch:
    cols = ([], [], []) if a is None else ([a[0]], [a[1].tolist()], [a[2]])
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.float64())), pa.array(cols[2], pa.float64())],
                                      names=["n", "mean", "m2"])


def moments_kernel(batches):
    """A task's count, mean and sum of squared deviations of the points without their last coordinate."""
    acc = None
    for b in batches:
        if b.num_rows:
            X = vectors(b.column("v"))[:, :-1]
            mean = X.mean(axis=0)
            acc = _merged_moments(acc, len(X), mean, float(((X - mean) ** 2).sum()))
    yield _moments_batch(acc)


def add_moments_kernel(batches):
    acc = None
    for b in batches:
        for r in b.to_pylist():
            acc = _merged_moments(acc, r["n"], np.array(r["mean"]), r["m2"])
    yield _moments_batch(acc)
