"""All-pairs work over a point set without emitting pair rows.

Points are hashed into B blocks by id. Each unordered block pair (bi <= bj)
becomes one group: side 0 carries block bi, side 1 block bj (empty on the
diagonal, where block bi is paired with itself). Rows are replicated B times
in total and shuffled once, groups hold about 2n/B points, and every group
reduces its pairs in numpy to one small row (a maximum with its pair, or a sum
and a count). Block ids come from a hash of the id, so no value skew can make
one group large. Groups are dealt to tasks one by one, so no task gets many by chance.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import checked_point
from tessera.plans import kernels as K
from tessera.plans.cells import used_coordinates

# Bytes of a block's vectors; a block has that many rows of them, and BLOCK_ROWS at least.
BLOCK_BYTES = 1 << 24
BLOCK_ROWS = 4096
# A group of two blocks compares at most the square of this many pairs (a billion), whatever the dimension.
MOST_ROWS = 1 << 15
# Block pairs in a partition at most.
PAIRS_PER_PARTITION = 16
# Blocks below this size are not split further just for parallelism.
MIN_BLOCK_ROWS = 256
# Pair-chunk size handled at once inside a kernel (scalar differences).
CHUNK_ELEMS = 1 << 22
# Pairs whose distances a matrix product gives at once: (rows, columns).
PRODUCT_TILE = (256, 256)
# A squared distance under so many times the product's error is taken from differences instead.
PRODUCT_MARGIN = 1e10


def choose_blocks(n: int, parallelism: int, block_rows: int = BLOCK_ROWS) -> int:
    """Number of blocks B: bounded block size first, then enough block pairs to fill the cores."""
    if n <= 1:
        return 1
    by_size = math.ceil(n / block_rows)
    by_par = math.ceil(math.sqrt(4 * max(parallelism, 1)))
    by_min = math.ceil(n / MIN_BLOCK_ROWS)
    return max(1, by_size, min(by_par, by_min))


def _vectors(tbl: pa.Table, v_col: str, id_col: str = "id") -> tuple[np.ndarray, np.ndarray]:
    if tbl.num_rows == 0:
        return np.zeros(0, dtype=np.int64), np.zeros((0, 0))
    ids = tbl.column(id_col).to_numpy()
    if tbl.num_rows == 0:
        return ids, np.zeros((0, 0))
    arr = tbl.column(v_col).combine_chunks()
    if arr.null_count:
        raise ValueError("NULL point")
    lens = np.diff(arr.offsets.to_numpy())
    d = int(lens[0])
    if (lens != d).any():
        raise ValueError("points of unequal dimension")
    vals = arr.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return ids, vals.reshape(-1, d)


def _sq_dists(X: np.ndarray, Y: np.ndarray, metric: str) -> np.ndarray:
    """Exact squared distances (direct differences, no Gram trick)."""
    if metric == "sq_drop_last":
        X, Y = X[:, :-1], Y[:, :-1]
    elif metric == "euclidean_2d":
        X, Y = X[:, :2], Y[:, :2]
    d = X.shape[1]
    if d <= 8:
        out = np.zeros((X.shape[0], Y.shape[0]))
        for k in range(d):
            diff = X[:, k, None] - Y[None, :, k]
            out += diff * diff
        return out
    diff = X[:, None, :] - Y[None, :, :]
    return np.einsum("ijk,ijk->ij", diff, diff)


def _pair_chunks(X, Y, diagonal: bool):
    """Yield (row offset, rows of X, mask or None) chunks bounded in memory."""
    m, p, d = X.shape[0], Y.shape[0], max(X.shape[1], 1)
    step = max(1, CHUNK_ELEMS // max(p * d, 1))
    for s in range(0, m, step):
        e = min(m, s + step)
        mask = None
        if diagonal:
            # pairs (i, j) with i < j inside one block
            mask = np.arange(p)[None, :] > np.arange(s, e)[:, None]
        yield s, X[s:e], mask


def _finish(sq: np.ndarray, metric: str) -> np.ndarray:
    return sq if metric == "sq_drop_last" else np.sqrt(sq)


def _sides(tbl: pa.Table) -> tuple[pa.Table, pa.Table]:
    side = tbl.column("side").to_numpy(zero_copy_only=False)
    return tbl.filter(pa.array(side == 0)), tbl.filter(pa.array(side == 1))


def _pairs_max_kernel(metric: str, v_col: str):
    def kernel(key, tbl):
        bi, bj = int(key[1].as_py()), int(key[2].as_py())
        left, right = _sides(tbl)
        ids_x, X = _vectors(left, v_col)
        diagonal = bi == bj
        ids_y, Y = (ids_x, X) if diagonal else _vectors(right, v_col)
        best = None  # (sq, id_a, id_b)
        if len(ids_x) and len(ids_y):
            for s, Xc, mask in _pair_chunks(X, Y, diagonal):
                sq = _sq_dists(Xc, Y, metric)
                if mask is not None:
                    sq = np.where(mask, sq, -1.0)
                mx = sq.max()
                if mx < 0 or (best is not None and mx < best[0]):
                    continue
                rows, cols = np.nonzero(sq == mx)
                a = ids_x[rows + s]
                b = ids_y[cols]
                lo, hi = np.minimum(a, b), np.maximum(a, b)
                order = np.lexsort((hi, lo))[0]
                cand = (float(mx), int(lo[order]), int(hi[order]))
                if best is None or cand[0] > best[0] or (
                        cand[0] == best[0] and cand[1:] < best[1:]):
                    best = cand
        if best is None:
            return pa.table({"id_a": pa.array([], pa.int64()), "id_b": pa.array([], pa.int64()),
                             "d": pa.array([], pa.float64())})
        d = float(_finish(np.array(best[0]), metric))
        return pa.table({"id_a": [best[1]], "id_b": [best[2]], "d": [d]})
    return kernel


def _sum_by_differences(X: np.ndarray, Y: np.ndarray, diagonal: bool, metric: str) -> float:
    total = 0.0
    for _, Xc, mask in _pair_chunks(X, Y, diagonal):
        dist = _finish(_sq_dists(Xc, Y, "euclidean"), metric)
        total += float(dist.sum() if mask is None else dist[mask].sum())
    return total


def sum_of_distances(X: np.ndarray, Y: np.ndarray, diagonal: bool, metric: str) -> float:
    """Sum over all pairs of a row of each (``diagonal``: i < j within X), by matrix products.

    Pairs so near that a product's error could show in their distance are compared by their differences.
    """
    X, Y = used_coordinates(X, metric), used_coordinates(Y, metric)
    products = K.SqProducts(X, Y, X.mean(axis=0))
    if products.exact_to is None:
        return _sum_by_differences(X, Y, diagonal, metric)
    near = products.exact_to * PRODUCT_MARGIN
    total = 0.0
    for s in range(0, len(X), PRODUCT_TILE[0]):
        for t in range(0, len(Y), PRODUCT_TILE[1]):
            rows, columns = slice(s, s + PRODUCT_TILE[0]), slice(t, t + PRODUCT_TILE[1])
            if diagonal and t + PRODUCT_TILE[1] <= s:
                continue
            sq = products.sq(rows, columns)
            if diagonal and t < s + len(sq):
                # pairs (i, j) with i < j only
                sq[np.arange(t, t + sq.shape[1])[None, :] <= np.arange(s, s + len(sq))[:, None]] = np.inf
            if sq.min() <= near:
                i, j = np.nonzero(sq <= near)
                sq[i, j] = K.paired_sq(X[s + i], Y[t + j])
            dist = _finish(sq, metric)
            total += float(dist.sum(where=dist < np.inf) if diagonal and t < s + len(sq) else dist.sum())
    return total


def _pairs_sum_kernel(metric: str, v_col: str):
    def kernel(key, tbl):
        left, right = _sides(tbl)
        _, X = _vectors(left, v_col)
        diagonal = key[1].as_py() == key[2].as_py()
        Y = X if diagonal else _vectors(right, v_col)[1]
        total, count = 0.0, 0
        if len(X) and len(Y):
            if X.shape[1] != Y.shape[1]:
                raise ValueError("points of unequal dimension")
            total = sum_of_distances(X, Y, diagonal, metric)
            count = len(X) * (len(X) - 1) // 2 if diagonal else len(X) * len(Y)
        return pa.table({"sum_d": [total], "n_pairs": [count]})
    return kernel


def _block_rows(points: DataFrame, B: int, id_col: str, v_col: str) -> DataFrame:
    """Rows ``(task, bi, bj, side, id, v)``: side 0 carries block bi, side 1 block bj.

    A point of block b is sent as side 0 to pairs (b, b..B-1) and as side 1 to
    pairs (0..b-1, b); each point is sent B times. The block pairs are dealt by their number to at most
    one partition per block pair, so the grouping on (task, bi, bj) that follows needs no second exchange.
    """
    b = F.pmod(F.xxhash64(F.col(id_col)), F.lit(B)).cast("int")
    base = points.select(F.col(id_col).alias("id"), checked_point(v_col).alias("v"), b.alias("b"))
    # one scan, one generate: partner block j gives the pair (min, max) and the side
    rows = base.select("id", "v", "b", F.explode(F.sequence(F.lit(0), F.lit(B - 1))).alias("j")).select(
        F.least("b", "j").alias("bi"), F.greatest("b", "j").alias("bj"),
        (F.col("j") < F.col("b")).cast("int").alias("side"), "id", "v")
    spark = points.sparkSession
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = B * (B + 1) // 2
    nparts = max(1, min(pairs, max(shuffle, _parallelism(points), pairs // PAIRS_PER_PARTITION)))
    number = F.expr("bj * CAST(bj + 1 AS BIGINT) DIV 2 + bi")
    rows = rows.withColumn("task", F.pmod(number, F.lit(nparts)).cast("int"))
    return rows.repartitionById(nparts, F.col("task"))


def _parallelism(points: DataFrame) -> int:
    return points.sparkSession.sparkContext.defaultParallelism


def block_count_for(points: DataFrame, n: int | None = None, v_col: str = "v", dim: int | None = None) -> int:
    """Blocks for the points: by bytes, so that points of a low dimension need fewer of them, and by the work of a pair of blocks."""
    if n is None or dim is None and n > BLOCK_ROWS:
        n, dim = points.agg(F.count(F.lit(1)), F.max(F.size(v_col))).first()
    rows = max(BLOCK_ROWS, min(MOST_ROWS, BLOCK_BYTES // (8 * dim))) if dim else BLOCK_ROWS
    return choose_blocks(n, _parallelism(points), rows)


def block_pair_max(points: DataFrame, metric: str = "euclidean", id_col: str = "id",
                   v_col: str = "v", blocks: int | None = None) -> DataFrame:
    """Per block pair, the farthest pair ``(id_a, id_b, d)`` with ``id_a < id_b``.

    Ties go to the smallest ``(id_a, id_b)``. ``d`` is the Euclidean distance,
    or the squared distance without the last coordinate for ``sq_drop_last``.
    """
    B = blocks or block_count_for(points, v_col=v_col)
    rows = _block_rows(points, B, id_col, v_col)
    schema = "id_a long, id_b long, d double"
    return rows.groupBy("task", "bi", "bj").applyInArrow(_pairs_max_kernel(metric, "v"), schema=schema)


def block_pair_sums(points: DataFrame, metric: str = "euclidean", id_col: str = "id",
                    v_col: str = "v", blocks: int | None = None) -> DataFrame:
    """Per block pair, ``(sum_d, n_pairs)`` over its unordered pairs."""
    B = blocks or block_count_for(points, v_col=v_col)
    rows = _block_rows(points, B, id_col, v_col)
    schema = "sum_d double, n_pairs long"
    return rows.groupBy("task", "bi", "bj").applyInArrow(_pairs_sum_kernel(metric, "v"), schema=schema)


def farthest_pair(points: DataFrame, metric: str = "euclidean", id_col: str = "id",
                  v_col: str = "v", blocks: int | None = None) -> DataFrame:
    """The single farthest pair ``(id_a, id_b, d)``; empty for fewer than 2 points."""
    per_block = block_pair_max(points, metric, id_col, v_col, blocks)
    return per_block.orderBy(F.col("d").desc(), "id_a", "id_b").limit(1)
