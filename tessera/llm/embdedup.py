"""Embedding near-duplicates by int8 tile products with rigorous error bounds (operator 3).

Unit vectors are rounded to int8 with one scale each, and the norm e of what the rounding lost is kept. For two
vectors u = a + x and w = b + y (a, b rounded; |x| = e, |y| = f) the int8 product differs from the cosine by
at most |a| f + e |b| + e f. Tiles of two blocks of vectors are multiplied in int8; only pairs whose product
plus bound reaches the threshold are computed again, in double precision, unless the product less bound reaches it too.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, materialize

#: Bytes of a block's vectors, and so of half a tile's input; rows of a block at most.
BLOCK_BYTES = 1 << 21
BLOCK_ROWS = 8192
#: Dimensions whose int8 products a float32 adds up exactly (1024 * 127 * 127 < 2 ** 24).
EXACT = 1024
#: Covers the rounding of the float32 scale factors.
SLACK = 1e-5
_PAIRS = 1 << 15
#: Tasks that tiles are dealt to, at most (or the number of shuffle partitions, if that is more).
MOST_TASKS = 1 << 14


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors (double), int8 values, scales, and norms of what is lost, of finite nonzero rows."""
    u = x / np.abs(x).max(1, keepdims=True)
    u /= np.sqrt(np.einsum("ij,ij->i", u, u))[:, None]
    scale = np.abs(u).max(1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    lost = u - q * scale[:, None]
    return u, q, scale, np.sqrt(np.einsum("ij,ij->i", lost, lost))


def linked_pairs(a, b, threshold: float, same: bool):
    """Yield index arrays (i, j) of the pairs of two quantised blocks with a cosine of ``threshold`` or more.

    ``same``: both are one block, of which each pair comes once (i < j).
    """
    ua, qa, sa, ea = a
    ub, qb, sb, eb = b
    na, nb = 1 + ea, 1 + eb  # |a| <= |u| + |x|
    wide = [(k, min(k + EXACT, qa.shape[1])) for k in range(0, qa.shape[1], EXACT)]
    fb = qb.astype(np.float32)
    for s in range(0, len(qa), 512):
        rows = slice(s, s + 512)
        fa = qa[rows].astype(np.float32)
        dots = fa[:, :EXACT] @ fb[:, :EXACT].T
        if len(wide) > 1:
            dots = dots.astype(np.float64)
            for k, m in wide[1:]:
                dots += fa[:, k:m] @ fb[:, k:m].T
        dots *= sa[rows, None].astype(dots.dtype)
        dots *= sb[None, :].astype(dots.dtype)
        widest = (na[rows] * eb.max() + ea[rows] * (nb.max() + eb.max())).max() + SLACK
        i, j = np.nonzero(dots >= threshold - widest)
        near = dots[i, j]
        i += s
        bound = na[i] * eb[j] + ea[i] * nb[j] + ea[i] * eb[j] + SLACK
        ok = near + bound >= threshold
        if same:
            ok &= i < j
        sure = near[ok] - bound[ok] >= threshold
        i, j = i[ok], j[ok]
        for t in range(0, len(i), _PAIRS):
            x, y, hit = i[t:t + _PAIRS], j[t:t + _PAIRS], sure[t:t + _PAIRS].copy()
            open_ = np.flatnonzero(~hit)
            hit[open_] = np.einsum("ij,ij->i", ua[x[open_]], ub[y[open_]]) >= threshold
            yield x[hit], y[hit]


def _join(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label`` (the smallest index that each node reaches) after the pairs (i, j) have linked too."""
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j = i[apart], j[apart]
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _pack(kind: str):
    def run(key, table):
        node = table.column("node").to_numpy()
        v = table.column("v").combine_chunks()
        flat = np.ascontiguousarray(v.flatten().to_numpy(zero_copy_only=False))
        return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "blk": pa.array([key[1].as_py()], pa.int32()),
                         "nodes": pa.array([node.astype("<i8").tobytes()], pa.binary()),
                         "copies": pa.array([table.column("n").to_numpy().astype("<i8").tobytes()], pa.binary()),
                         "vectors": pa.array([flat.astype(kind).tobytes()], pa.binary())})
    return run


def _tiles(kind: str, threshold: float):
    """Stream rows sorted by tile: of each tile one row per linked vector, its links and its smallest linked node."""
    def run(batches):
        rows = (r for b in batches for k in range(b.num_rows) for r in b.slice(k, 1).to_pylist())
        for (dim, _, _), blocks in groupby(rows, lambda r: (r["dim"], r["i"], r["j"])):
            sides = []
            for r in sorted(blocks, key=lambda r: r["blk"]):
                x = np.frombuffer(r["vectors"], kind).reshape(-1, dim).astype(np.float64)
                sides.append((np.frombuffer(r["nodes"], "<i8"), np.frombuffer(r["copies"], "<i8"), quantise(x)))
            (na, ca, a), (nb, cb, b) = sides[0], sides[-1]
            same = len(sides) == 1
            nodes = na if same else np.concatenate([na, nb])
            n = np.zeros(len(nodes), np.int64)
            shift = 0 if same else len(na)
            label = np.arange(len(nodes))
            for i, j in linked_pairs(a, b, threshold, same):
                np.add.at(n, i, cb[j])
                np.add.at(n, j + shift, ca[i])
                label = _join(label, i, j + shift)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at]), pa.array(n[at]), pa.array(nodes[label[at]])],
                                             names=["node", "n", "root"])
    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, id_col: str = "vec_id",
                    v_col: str = "embedding") -> DataFrame:
    """``(id_col, n_links, component_id, kept)`` per row.

    Rows link at a cosine of ``threshold`` (over 0) or more, in double precision. Vectors that are NULL, empty,
    zero, or hold a NULL or non-finite component link with nothing, and vectors of unequal dimension not with
    each other. ``n_links`` counts the other rows linked directly; ``component_id`` is the smallest id reachable,
    the own one included; ``kept``: the row has that id (or neither has one). Rows with a NULL id take part, but
    name a component only as NULL; rows that repeat an id are vectors of their own.

    Equal vectors are compared once and counted as often as they occur. Each pair of blocks of distinct
    vectors is a tile; it gives one row per linked vector, its links and its smallest linked node, never the
    pairs. Input empty, output empty.
    """
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col), F.col(v_col).alias("v"))
    ok = F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))
    kind = "<f4" if "float" in dict(rows.dtypes)["v"] else "<f8"
    if kind == "<f8":
        rows = rows.withColumn("v", v.cast("array<double>"))
    distinct = rows.where(ok).groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first"))
    distinct = materialize(distinct.withColumn("node", F.monotonically_increasing_id()))
    size = F.size("v")
    blocks = distinct.groupBy(size.alias("dim")).agg(F.count(F.lit(1)).alias("m"))
    per = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), (F.lit(BLOCK_BYTES) / (F.col("dim") * int(kind[2]))).cast("int")))
    blocks = blocks.select("dim", F.ceil(F.col("m") / per).cast("int").alias("nb"))
    # a row for each dimension that occurs: one, as a rule
    placed = distinct.withColumn("dim", size).join(blocks, "dim").select(
        "dim", "nb", "node", "n", "v", F.pmod(F.xxhash64("v"), "nb").cast("int").alias("blk"))
    packed = placed.groupBy("dim", "blk", "nb").applyInArrow(
        _pack(kind), "dim int, blk int, nodes binary, copies binary, vectors binary")
    packed = materialize(packed).join(blocks, "dim")
    tiles = packed.select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o"))
    tiles = tiles.select("dim", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "blk", "nodes",
                         "copies", "vectors")
    # tiles are dealt one by one to tasks of their own: their bytes say nothing of their work
    n_tiles = int(blocks.agg(F.sum(F.col("nb").cast("long") * (F.col("nb") + 1) / 2)).first()[0] or 1)
    tasks = min(n_tiles, max(MOST_TASKS, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    number = F.col("j").cast("long") * (F.col("j") + 1) / 2 + F.col("i") + F.col("dim")
    tiles = tiles.repartitionById(tasks, F.pmod(number.cast("long"), F.lit(tasks)).cast("int")).sortWithinPartitions("dim", "i", "j")
    found = materialize(tiles.mapInArrow(_tiles(kind, threshold), "node long, n long, root long"))
    links = found.groupBy("node").agg(F.sum("n").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    of = (distinct.join(links, "node", "left").join(roots, "node", "left")
          .select("v", "n", "first", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root")))
    of = materialize(of)
    names = of.groupBy("root").agg(F.min("first").alias("component"))
    labels = materialize(of.join(names, "root").select(F.col("v").alias("_v"), F.col("component"),
                                                      (F.col("links") + F.col("n") - 1).alias("links")))
    out = rows.withColumn("v", F.when(ok, v)).join(labels, v == F.col("_v"), "left")
    linked = F.col("_v").isNotNull()
    component = F.when(linked, F.col("component")).otherwise(F.col(id_col))
    return out.select(id_col, F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), component.eqNullSafe(F.col(id_col)).alias("kept"))
