"""Loaders that shape the driver's Parquet tables into operator inputs.

Each loader selects only the columns it needs, so the Parquet scan prunes the
rest (``ReadSchema`` in the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scan_partitions


def spread(df: DataFrame) -> DataFrame:
    """Round-robin a scan with fewer splits than cores before costly per-row work.

    A small file with few row groups reads as a few partitions; a large input
    already has many and is left alone (no shuffle).
    """
    par = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(par) if (scan_partitions(df) or par) < par else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def event_pair_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ``<event_id> <event_type>`` lines."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.concat_ws(" ", F.col("event_id").cast("string"),
                                 F.col("event_type")).alias("value"))


def event_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("id"), F.col("event_type").alias("class"))


def lineitem_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("class"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, text)``; spread when the file has fewer splits than cores,
    since tokenizing costs far more per row than the shuffle."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-D points ``(id, v)`` from ``embeddings`` (FLOAT cast to DOUBLE)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))


def part_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """2-D points ``(id, [p_size, p_retailprice])`` from ``part``."""
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    F.array(F.col("p_size").cast("double"), F.col("p_retailprice")).alias("v"))


# fixed values: the columns that identify a lineitem row, in id-string order
LINEITEM_ID_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                       "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-D points ``(id, [l_quantity, l_extendedprice, l_discount, l_tax])``.

    ``(l_orderkey, l_linenumber)`` is not unique in the driver data, so the id
    is the first 60 bits of md5 over the '|'-joined key and measure columns:
    deterministic, layout-independent, and computed the same way by DuckDB.
    """
    li = spread(table(spark, sf_dir, "lineitem").select(*LINEITEM_ID_COLUMNS))
    v = F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in LINEITEM_ID_COLUMNS])
    ident = F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")
    return li.select(ident.alias("id"), v.alias("v"))
