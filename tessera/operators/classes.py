"""Class counting over ``(id, class)`` pairs.

Every count is a hash aggregate with a map-side partial step, so a class that
holds a third of all rows still ships one row per map task through the shuffle.
Shards are ``pmod(id, K)``: results depend on the data and K only, never on the
physical layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _check_k(K: int) -> None:
    if not isinstance(K, int) or K <= 0:
        raise ValueError("K must be a positive integer")


def shard_of(id_col: str, K: int):
    return F.pmod(F.col(id_col), F.lit(K)).cast("int")


def class_count_by_shard(pairs: DataFrame, K: int, id_col: str = "id",
                         class_col: str = "class") -> DataFrame:
    """``(shard, class, n)``: counts per class inside each deterministic shard."""
    _check_k(K)
    return (pairs.select(shard_of(id_col, K).alias("shard"), F.col(class_col).alias("class"))
            .groupBy("shard", "class").agg(F.count(F.lit(1)).alias("n")))


def class_count(pairs: DataFrame, K: int, id_col: str = "id", class_col: str = "class") -> DataFrame:
    """``(class, n)`` by two rounds: per-shard counts, then their sum."""
    return (class_count_by_shard(pairs, K, id_col, class_col)
            .groupBy("class").agg(F.sum("n").alias("n")))


def class_count_direct(pairs: DataFrame, class_col: str = "class") -> DataFrame:
    """``(class, n)`` in one aggregate (partial per partition, then final)."""
    return pairs.groupBy(F.col(class_col).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def shard_sizes(pairs: DataFrame, K: int | None = None, id_col: str = "id") -> DataFrame:
    """``(shard, n)``; ``K=None`` uses the physical partitions (layout-dependent)."""
    if K is None:
        key = F.spark_partition_id()
    else:
        _check_k(K)
        key = shard_of(id_col, K)
    return pairs.groupBy(key.alias("shard")).agg(F.count(F.lit(1)).alias("n"))


def max_partition_size(pairs: DataFrame, K: int | None = None, id_col: str = "id") -> DataFrame:
    """One row ``max_partition_size``: the largest shard, 0 for empty input."""
    return shard_sizes(pairs, K, id_col).agg(
        F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("max_partition_size"))


def class_count_with_max(pairs: DataFrame, K: int, id_col: str = "id",
                         class_col: str = "class") -> DataFrame:
    """Class counts plus the largest-shard row in one result: ``(kind, class, n)``.

    ``kind`` is ``'class'`` or ``'max_partition_size'`` (class NULL), so a class
    literally named like the statistic cannot collide with it.
    """
    # both statistics come from one (shard, class) aggregate, so the input is
    # scanned and shuffled once and the exchange is reused by both branches
    by_shard = class_count_by_shard(pairs, K, id_col, class_col)
    counts = by_shard.groupBy("class").agg(F.sum("n").cast("long").alias("n")).select(
        F.lit("class").alias("kind"), "class", "n")
    mx = by_shard.groupBy("shard").agg(F.sum("n").alias("n")).agg(
        F.coalesce(F.max("n"), F.lit(0)).cast("long").alias("n")).select(
        F.lit("max_partition_size").alias("kind"), F.lit(None).cast("string").alias("class"), "n")
    return counts.unionByName(mx)


def most_frequent_class(counts: DataFrame) -> DataFrame:
    """The class with the largest ``n``; ties go to the alphabetically smaller class."""
    return counts.orderBy(F.col("n").desc(), F.col("class").asc()).limit(1)


def class_count_sorted(pairs: DataFrame, K: int, id_col: str = "id",
                       class_col: str = "class") -> DataFrame:
    return class_count(pairs, K, id_col, class_col).orderBy("class")


def pair_count(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"))


def class_count_line(counts: DataFrame) -> DataFrame:
    """One row ``line``: ``('A', 2) ('B', 1) ...`` sorted by class.

    Built from the already aggregated counts, so its size is the number of
    distinct classes, which is the size of the report itself.
    """
    quoted = F.when(F.col("class").contains("'") & ~F.col("class").contains('"'),
                    F.concat(F.lit('"'), F.col("class"), F.lit('"'))).otherwise(
        F.concat(F.lit("'"), F.regexp_replace(F.regexp_replace(F.col("class"), r"\\", r"\\\\"),
                                              "'", r"\\'"), F.lit("'")))
    item = F.struct(F.col("class").alias("k"),
                    F.concat(F.lit("("), quoted, F.lit(", "), F.col("n").cast("string"),
                             F.lit(")")).alias("s"))
    return counts.agg(F.coalesce(F.array_join(
        F.transform(F.array_sort(F.collect_list(item)), lambda x: x["s"]), " "),
        F.lit("")).alias("line"))
