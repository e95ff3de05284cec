"""Shared helpers of the training-data operators: columns, Arrow access, written tables, components."""

from __future__ import annotations

import sys
import types
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: Connected components: nodes of a higher degree than edges / HUBS (and than HUB_DEGREE) are looked up by
#: broadcast, so there are at most 2 * HUBS of them whatever the number of edges.
HUBS = 10_000
HUB_DEGREE = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared checkpoint folder, reread, and its path: the lineage ends here.

    A table rather than a checkpoint: that would hand on the partitionings and constraints of its plan, which
    multiply with each join of a loop.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame) -> DataFrame:
    return written(df)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Delete a written table that nothing reads any more."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt to ``spark.sql.shuffle.partitions`` tasks: a small table may cause much work for each row."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def looked_up(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left`` with the other columns of ``right`` (unique by ``key``); NULL where ``right`` has no such key.

    ``left`` is read twice, so it should be a written table. Keys on over 1/HUBS of its rows (and on over HUB_DEGREE)
    meet ``right`` by broadcast: there are HUBS of them at most, whatever the input. Rows without a key pass by both joins.
    """
    spark = left.sparkSession
    found = left.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    n = int(found.agg(F.sum("__n")).first()[0] or 0)
    hot = found.where(F.col("__n") > max(HUB_DEGREE, n // HUBS)).where(F.col(key).isNotNull()).select(key)
    hot, path = written(hot)
    new = [c for c in right.columns if c != key]
    hot_rows, path2 = written(right.join(F.broadcast(hot), key))
    discard(spark, path)
    marked = left.join(F.broadcast(hot_rows.select(F.col(key).alias("__hot"), *(F.col(c).alias(f"__h_{c}") for c in new))),
                       F.col(key) == F.col("__hot"), "left")
    at_hot = marked.where(F.col("__hot").isNotNull()).select(*left.columns, *(F.col(f"__h_{c}").alias(c) for c in new))
    rest = marked.where(F.col("__hot").isNull() & F.col(key).isNotNull()).select(*left.columns).join(right, key, "left")
    bare = left.where(F.col(key).isNull()).select(*left.columns, *(F.lit(None).cast(right.schema[c].dataType).alias(c) for c in new))
    return at_hot.unionByName(rest.select(*at_hot.columns)).unionByName(bare)


def passed_columns(df: DataFrame, new: list[str]) -> list[str]:
    """Columns that an operator hands through: all but those that carry the name of one of its results."""
    low = {c.lower() for c in new}
    return [c for c in df.columns if c.lower() not in low]


def binary_list(col: pa.Array) -> list:
    """UTF-8 bytes (or None) of each value of a string column."""
    kind = pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()
    return col.cast(kind).to_pylist()


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """The ``keep`` columns of ``batch`` and the ``new`` ones after them."""
    return pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + list(new.values()),
                                      names=[*keep, *new])


def schema_of(df: DataFrame, keep: list[str], new: str):
    """Schema of ``keep`` columns of ``df`` followed by the DDL ``new``."""
    from pyspark.sql import types as T
    return T.StructType([df.schema[c] for c in keep] + T.StructType.fromDDL(new).fields)


def kept_by_worker(kind: str, key, make):
    """``make()``, kept by the Python worker for its next tasks (one value of each kind).

    The operators' code is pickled by value, so state in their own modules would be new for each task.
    """
    held = sys.modules.setdefault("_tessera_worker", types.ModuleType("_tessera_worker")).__dict__
    if held.get(kind, (None,))[0] != key:
        held[kind] = (key, make())
    return held[kind][1]


def pieces(text: bytes, size: int, blank):
    """``text`` in pieces of about ``size`` bytes, cut where the pattern ``blank`` matches, so that no word is cut."""
    at = 0
    while len(text) - at > size:
        cut = blank.search(text, at + size)
        if not cut:
            break
        yield text[at:cut.start()]
        at = cut.end()
    yield text[at:]


def sliced(batches, max_bytes: int, text: str):
    """Cut record batches so that each holds about ``max_bytes`` of text at most (one row at least)."""
    for b in batches:
        if not b.num_rows:
            continue
        size = max(1, b.column(text).nbytes)
        step = b.num_rows if size <= max_bytes else max(1, b.num_rows * max_bytes // size)
        for s in range(0, b.num_rows, step):
            yield b.slice(s, step)


def _min_label(edges: DataFrame, key: str, value: str, n_edges: int, old: list[str]) -> DataFrame:
    """``edges`` with column ``m``, the smallest ``value`` of the row's ``key``.

    Keys of a high degree come by broadcast (there are at most 2 * HUBS of them), so that no task of
    the join gathers the edges of one hub; the others meet in an equality join.
    """
    low, path = written(edges.groupBy(key).agg(F.min(value).alias("m"), F.count(F.lit(1)).alias("deg")))
    old.append(path)
    limit = max(HUB_DEGREE, n_edges // HUBS)
    hubs = low.where(F.col("deg") > limit).select(F.col(key).alias("_hub"), F.col("m").alias("_hm"))
    first = edges.join(F.broadcast(hubs), F.col(key) == F.col("_hub"), "left")
    at_hub = first.where(F.col("_hub").isNotNull()).select(*edges.columns, F.col("_hm").alias("m"))
    rest = (first.where(F.col("_hub").isNull()).select(*edges.columns)
            .join(low.where(F.col("deg") <= limit).select(key, "m"), key))
    return at_hub.unionByName(rest.select(*edges.columns, "m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node of the undirected ``edges``; root is the component's smallest node.

    Alternating large-star and small-star rounds: each edge moves to the smallest neighbour, until the
    edges are stars around the smallest node. A round is a partial aggregate and an equality join; its
    edges are written to the checkpoint folder, so a lost executor costs a round at most, and the tables of
    the round before are deleted. NULL nodes and loops are ignored. An empty table gives an empty result.
    """
    spark = edges.sparkSession
    u, v = F.col("u"), F.col("v")
    e, path = written(edges.where(F.col(a) != F.col(b))
                      .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    sign = None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == sign or not now[0]:
            break
        sign, n, old = tuple(now), int(now[0]), [path]
        both = e.unionByName(e.select(v.alias("u"), u.alias("v")))
        large, path = written(_min_label(both, "u", "v", 2 * n, old).where(v > u)
                              .select(v.alias("u"), F.least("m", "u").alias("v")).distinct())
        old.append(path)
        small = _min_label(large, "u", "v", n, old)
        e, path = written(small.select(u, F.col("m").alias("v"))
                          .unionByName(small.where(v != F.col("m")).select(v.alias("u"), F.col("m").alias("v"))).distinct())
        for x in old:
            discard(spark, x)
    roots = e.select(u.alias("node"), v.alias("root"))
    return roots.unionByName(e.select(v.alias("node"), v.alias("root"))).distinct()
