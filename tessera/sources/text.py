"""Text sources: line files, point files, ``<id> <class>`` pairs, line documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scan_partitions
from tessera.sources.splits import lines_with_place


def read_lines(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """One row per text line (column ``value``), at least ``min_partitions`` splits."""
    df = spark.read.text(path)
    if min_partitions and scan_partitions(df) < min_partitions:
        df = df.repartition(min_partitions)
    return df


def parse_points(lines: DataFrame, sep: str = ",", col: str = "value",
                 permissive: bool = False, id_col: str | None = None) -> DataFrame:
    """Lines of ``sep``-separated numbers to ``(id, v ARRAY<DOUBLE>)``.

    ``sep`` is taken literally. Strict: a blank line, an empty token or a bad number raises. ``permissive``: a line
    with any of these is dropped whole. The id is that of ``id_col``; nothing is shuffled then. Without one it is a 64-bit
    hash of the line and of its number among equal lines, so it does not depend on the splits; equal lines are counted, not
    gathered, and of n lines two share an id with a probability of n²/2^65.
    """
    line = F.col(col)
    parts = F.transform(F.split(line, "\\Q" + sep + "\\E", -1), lambda x: F.trim(x).try_cast("double"))
    bad = F.exists(parts, lambda x: x.isNull())
    raw = parts if permissive else F.when(bad, F.raise_error(F.concat(F.lit("bad point line: "), line))).otherwise(parts)
    if id_col:
        some = lines.where(line.isNotNull())
        return (some.where(~bad) if permissive else some).select(F.col(id_col).alias("id"), raw.alias("v"))
    counted = lines.where(line.isNotNull()).groupBy(line.alias("_line")).agg(F.count(F.lit(1)).alias("_n"))
    copies = counted.select(F.col("_line").alias(col), F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_k"))
    copies = copies.where(~bad) if permissive else copies
    return copies.select(F.xxhash64(line, F.col("_k")).alias("id"), raw.alias("v"))


def read_points(spark: SparkSession, path: str, sep: str = ",",
                permissive: bool = False) -> DataFrame:
    """Comma- (or space-) separated point file to ``(id, v)``; the id is the line's file and byte offset (``sources.splits``)."""
    return parse_points(lines_with_place(spark, path), sep=sep, permissive=permissive, id_col="id")


def parse_pairs(lines: DataFrame, mode: str = "rest", col: str = "value",
                permissive: bool = False) -> DataFrame:
    """``<id> <class>`` lines to ``(id LONG, class STRING)``.

    ``mode='rest'`` keeps everything after the first space as the class;
    ``mode='token'`` keeps only the second space-separated token.
    A missing class or a non-integer id raises unless ``permissive``.
    """
    if mode == "rest":
        parts = F.split(F.col(col), " ", 2)
    elif mode == "token":
        parts = F.split(F.col(col), " ")
    else:
        raise ValueError(f"mode must be 'rest' or 'token', not {mode!r}")
    if permissive:
        ident = F.try_element_at(parts, F.lit(1)).try_cast("long")
        klass = F.try_element_at(parts, F.lit(2))
        return lines.select(ident.alias("id"), klass.alias("class")).where(
            F.col("id").isNotNull() & F.col("class").isNotNull())
    ident = F.element_at(parts, 1).cast("long")
    klass = F.when(F.size(parts) < 2, F.raise_error(F.concat(
        F.lit("pair line without a class: "), F.col(col)))).otherwise(F.element_at(parts, 2))
    return lines.select(ident.alias("id"), klass.alias("class"))


def pair_lines(df: DataFrame, id_col: str, class_col: str) -> DataFrame:
    """Render a table as ``<id> <class>`` lines (column ``value``)."""
    return df.select(F.concat_ws(" ", F.col(id_col).cast("string"), F.col(class_col)).alias("value"))


def line_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Split multi-line texts into one document per line: ``(doc_id, line_no, text)``.

    The whole text is split; nothing is truncated. ``line_no`` starts at 0.
    """
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.posexplode(F.split(F.col(text_col), "\n")).alias("line_no", "text"))
