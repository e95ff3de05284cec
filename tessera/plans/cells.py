"""Cells of a k-d tree in numpy, their boxes' bounds, and the search for the nearest of many centres by them."""

from __future__ import annotations

import numpy as np

# Bounds are rounded up (or down) by this factor.
SLACK = 1 + 1e-12
# Scalar differences held at once.
CHUNK_ELEMS = 1 << 22


def used_coordinates(X: np.ndarray, metric: str) -> np.ndarray:
    """The coordinates that the metric looks at; a column of zeros if it looks at none."""
    part = X[:, {"euclidean": slice(None), "sq_drop_last": slice(0, -1), "euclidean_2d": slice(0, 2)}[metric]]
    return np.ascontiguousarray(part) if part.shape[1] else np.zeros((len(X), 1))


def kd_cuts(X: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Dimension and value of each inner node's cut, in heap order; ``leaves`` is a power of two.

    A node cuts the dimension in which its points spread most, at their median.
    """
    dim, cut = np.zeros(max(0, leaves - 1), np.int64), np.zeros(max(0, leaves - 1))
    rows = {0: np.arange(len(X))}
    for node in range(leaves - 1):
        at = rows.pop(node)
        if len(at):
            spread = X[at].max(axis=0) - X[at].min(axis=0)
            dim[node] = int(np.argmax(spread))
            cut[node] = np.median(X[at, dim[node]])
        right = X[at, dim[node]] > cut[node]
        rows[2 * node + 1], rows[2 * node + 2] = at[~right], at[right]
    return dim, cut


def cell_of(X: np.ndarray, dim: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.zeros(len(X), np.int64)
    at = np.arange(len(X))
    for _ in range((len(dim) + 1).bit_length() - 1):
        node = 2 * node + 1 + (X[at, dim[node]] > cut[node])
    return node - len(dim)


def farthest_sq(X: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance from each row to the farthest point of a box."""
    far = np.maximum(np.abs(X - lo), np.abs(X - hi))
    return np.einsum("ij,ij->i", far, far) * SLACK


def nearest_sq(X: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Squared distance from each row of ``X`` to the nearest point of each box, rounded down: (rows, boxes)."""
    out = np.zeros((len(X), len(lo)))
    for j in range(X.shape[1]):
        x = X[:, j, None]
        gap = np.maximum(np.maximum(lo[:, j] - x, x - hi[:, j]), 0.0)
        out += gap * gap
    return out / SLACK


class CentreCells:
    """Centres in the cells of a k-d tree, about as many cells as centres in a cell.

    A point is compared with its nearest cell's centres, then only with those of cells whose box is not farther than
    the best so far, so the nearest centre is exact. Ties go to the lowest index.
    """

    def __init__(self, C: np.ndarray, metric: str, sq_dists):
        self.C, self.metric, self.sq_dists = C, metric, sq_dists
        U = used_coordinates(C, metric)
        leaves = 1 << max(0, int(len(C) ** 0.5) - 1).bit_length()
        cell = cell_of(U, *kd_cuts(U, leaves))
        order = np.argsort(cell, kind="stable")
        start = np.flatnonzero(np.concatenate([[True], np.diff(cell[order]) != 0]))
        # a cell's centres in order of their index
        self.members = np.split(order, start[1:])
        self.lo, self.hi = np.minimum.reduceat(U[order], start, axis=0), np.maximum.reduceat(U[order], start, axis=0)
        self.compared = 0

    def __len__(self):
        return len(self.C)

    def nearest(self, X: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance to and index of the nearest centre; ``step`` centres are compared at once."""
        best, at = np.full(len(X), np.inf), np.zeros(len(X), np.int64)
        rows_at_once = max(1, CHUNK_ELEMS // len(self.members))
        for s in range(0, len(X), rows_at_once):
            part = slice(s, s + rows_at_once)
            self._search(X[part], best[part], at[part], None, step)
        return best, at

    def nearest_two(self, X: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``nearest`` and the squared distance to the nearest of the other centres (infinite without any)."""
        best, at, second = np.full(len(X), np.inf), np.zeros(len(X), np.int64), np.full(len(X), np.inf)
        rows_at_once = max(1, CHUNK_ELEMS // len(self.members))
        for s in range(0, len(X), rows_at_once):
            part = slice(s, s + rows_at_once)
            self._search(X[part], best[part], at[part], second[part], step)
        return best, at, second

    def _search(self, X: np.ndarray, best: np.ndarray, at: np.ndarray, second: np.ndarray | None, step: int) -> None:
        low = nearest_sq(used_coordinates(X, self.metric), self.lo, self.hi)
        home = low.argmin(axis=1)
        for c in np.unique(home):
            self._look(X, np.flatnonzero(home == c), c, best, at, second, step)
        limit = best if second is None else second
        for c in range(len(self.members)):
            self._look(X, np.flatnonzero((low[:, c] <= limit) & (home != c)), c, best, at, second, step)

    def _look(self, X, rows, cell, best, at, second, step) -> None:
        if not len(rows):
            return
        for k in range(0, len(self.members[cell]), step):
            index = self.members[cell][k:k + step]
            sq = self.sq_dists(X[rows], self.C[index], self.metric)
            self.compared += sq.size
            j = sq.argmin(axis=1)
            near, which = sq[np.arange(len(rows)), j], index[j]
            if second is not None:
                # of the two best so far and the two best here the second
                other = np.partition(sq, 1, axis=1)[:, 1] if sq.shape[1] > 1 else np.inf
                second[rows] = np.minimum(np.maximum(best[rows], near), np.minimum(second[rows], other))
            closer = (near < best[rows]) | ((near == best[rows]) & (which < at[rows]))
            best[rows[closer]], at[rows[closer]] = near[closer], which[closer]
