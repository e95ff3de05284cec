"""SimHash near-duplicates by deletion variants (operator 2).

A fingerprint is cut into ``distance // 2 + 1`` segments, fewer than a plain pigeonhole needs: of two
fingerprints at most ``distance`` bits apart one segment then differs in at most one bit. Each segment is
indexed whole and with each single bit left out; two fingerprints that agree on an index key are compared
in full. Work is done on distinct fingerprints only, so copies cost nothing, and links leave a bucket as a
spanning forest, never as all pairs.
"""

from __future__ import annotations

from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (binary_list, components, dealt, materialize, passed_columns, schema_of, sliced,
                                with_columns)

SEED = 42
#: Fingerprints of a bucket that meet in one comparison; larger buckets are split into blocks of this size.
BLOCK = 512
_CHUNK = 1 << 15


def fingerprint_of(text: bytes | None, shingle: int) -> int:
    """SimHash of the word shingles of one text (see :func:`fingerprints`)."""
    words = text.lower().split() if text else []  # of bytes: only A-Z, and only \\x20 \\x09-\\x0D
    n = max(len(words) - shingle + 1, 1 if words else 0)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    h = xxhash.xxh64_intdigest
    for s in range(0, n, _CHUNK):
        part = words[s:s + _CHUNK + shingle - 1]
        if len(words) < shingle:
            rows = [b" ".join(words)]
        else:
            rows = map(b" ".join, zip(*(part[i:] for i in range(shingle))))
        hs = np.fromiter((h(x, SEED) for x in rows), np.uint64)
        counts += np.unpackbits(hs.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """``docs`` with a long column ``out``: the 64-bit SimHash of each whole text.

    A-Z is lowered, words are runs without \\x20 and \\x09-\\x0D, shingles are ``shingle`` words joined by a
    space, repeats included; a text of fewer words is one shingle, a text of none (NULL too) has fingerprint
    0. A bit is 1 if it is set in over half of the shingles' XXH64 values (seed 42). An input column named
    ``out`` is replaced.
    """
    keep = passed_columns(docs, [out])

    def run(batches):
        for b in sliced(batches, 1 << 25, text):
            fps = np.array([fingerprint_of(t, shingle) for t in binary_list(b.column(text))], np.uint64)
            yield with_columns(b, keep, {out: pa.array(fps.view(np.int64))})

    return docs.mapInArrow(run, schema_of(docs, keep, f"{out} long"))


def _keys(fp: Column, distance: int) -> Column:
    """Array of ``(key, side)``: each segment whole (side 2), and with each of its bits left out (side: that bit).

    Two fingerprints whose segments differ in one bit meet in that bit's key on different sides; those with
    equal segments meet in the whole key.
    """
    n = distance // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    out = []
    for s in range(n):
        width = cuts[s + 1] - cuts[s]
        seg = F.shiftrightunsigned(fp, cuts[s]).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))
        out.append(F.struct(F.xxhash64(F.lit(s), F.lit(-1), seg).alias("key"), F.lit(2).alias("side")))
        for p in range(width):
            bit = F.shiftright(seg, p).bitwiseAND(F.lit(1))
            out.append(F.struct(F.xxhash64(F.lit(s), F.lit(p), seg.bitwiseXOR(F.shiftleft(bit, p))).alias("key"),
                                bit.cast("int").alias("side")))
    return F.array(*out)


def _forest(fps: np.ndarray, distance: int) -> np.ndarray:
    """(k, 2) spanning forest of the links between the given fingerprints: each one and its smallest reachable one."""
    fps = np.sort(fps.view(np.uint64))
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(1)
        if (new == label).all():
            break
        label = new
    far = label != np.arange(len(fps))
    return np.stack([fps[far], fps[label[far]]], 1).view(np.int64)


def _bucket_forests(distance: int):
    """Stream rows sorted by (key, i, j): the spanning forest of each bucket's links."""
    def run(batches):
        held: list = []

        def rows():
            for b in batches:
                yield from zip(*(b.column(c).to_pylist() for c in ("key", "i", "j", "fp")))

        for _, members in groupby(rows(), lambda r: r[:3]):
            held.append(_forest(np.unique(np.array([r[3] for r in members], np.int64)), distance))
            if sum(map(len, held)) > 4096:
                yield _edges(held)
                held = []
        yield _edges(held)
    return run


def _edges(found: list) -> pa.RecordBatch:
    e = np.unique(np.concatenate([np.empty((0, 2), np.int64), *found]), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], names=["a", "b"])


def links(fps: DataFrame, distance: int = 3, block: int = BLOCK) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct fingerprints (column ``fp``) at most ``distance`` bits apart.

    Not every link is an edge: those of a bucket come as a spanning forest, with the same components.
    A bucket of two is one comparison in the aggregate itself. Larger buckets are split into blocks of about
    ``block`` fingerprints; each pair of blocks is compared by one group of at most about 2 * ``block`` rows.
    """
    index = dealt(fps.select("fp"), "fp").select("fp", F.explode(_keys(F.col("fp"), distance)).alias("k")).select("fp", "k.key", "k.side")
    def of(*sides):
        return F.when(F.col("side").isin(*sides), F.col("fp"))

    n = F.col("n")
    # left-out bits on one side only: equal segments, which meet in the whole key
    buckets = (index.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("side").alias("s0"), F.max("side").alias("s1"),
                                        F.min(of(0, 2)).alias("lo"), F.max(of(1, 2)).alias("hi"))
               .where((n > 1) & ((F.col("s0") == 2) | (F.col("s0") != F.col("s1")))))
    buckets = materialize(buckets.select("key", "n", "lo", "hi"))
    pairs = (buckets.where(n == 2).select(F.col("lo").alias("a"), F.col("hi").alias("b"))
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance))
    big = buckets.where(n > 2).select("key", F.ceil(n / F.lit(block)).cast("int").alias("nb"))
    members = index.join(big, "key").withColumn("blk", F.pmod(F.xxhash64("fp"), F.col("nb")).cast("int"))
    tiles = members.select("key", "fp", "blk", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("o")).select(
        "key", F.least("blk", "o").alias("i"), F.greatest("blk", "o").alias("j"), "fp")
    tiles = tiles.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return pairs.unionByName(tiles.mapInArrow(_bucket_forests(distance), "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
                    distance: int = 3) -> DataFrame:
    """``(id_col, fp, root, component)`` per row: SimHash, the component's smallest fingerprint, and the
    smallest id reachable over links.

    Fingerprints link at ``distance`` or fewer differing bits. NULL and empty texts have fingerprint 0, which
    links like any other. A row with a NULL id belongs to its component, but names it only if no other row
    does (the component is then NULL). Repeated rows come out as often as they went in. Empty in, empty out.
    """
    rows = materialize(fingerprints(docs.select(id_col, text), text, shingle).select(F.col(id_col), "fp"))
    classes = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("first")))
    roots = components(links(classes.select("fp"), distance))
    of = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    names = of.groupBy("root").agg(F.min("first").alias("component"))
    labels = materialize(of.join(names, "root").select(F.col("fp").alias("_fp"), "root", "component"))
    return rows.join(labels, F.col("fp") == F.col("_fp")).select(id_col, "fp", "root", "component")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3,
             distance: int = 3) -> DataFrame:
    """One row of each group of near copies, with the columns of ``docs``: the row of the smallest id.

    A group without any id keeps a row of its smallest fingerprint. Of rows that share the survivor's id and
    fingerprint, one of the smallest text stays.
    """
    near = near_duplicates(docs, id_col, text, shingle, distance)
    # a group is named by its smallest id, but the rows without ids by their fingerprints
    group = near.groupBy("root").agg(F.min(F.struct(F.isnull(id_col), F.col(id_col).alias("id"), "fp")).alias("s"))
    kept = materialize(group.select(F.col("s.id").alias("__id"), F.col("s.fp").alias("__kept")).distinct())
    rows = fingerprints(docs, text, shingle, out="__fp")
    rows = rows.join(kept, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__fp") == F.col("__kept")), "left_semi")
    one = rows.groupBy(id_col, "__fp").agg(F.min_by(F.struct(*docs.columns), F.coalesce(text, F.lit(""))).alias("r"))
    return one.select("r.*")
