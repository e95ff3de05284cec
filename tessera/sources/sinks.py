"""Sinks (S6). Operators return DataFrames; these write them out.

Writes are plain DataFrame writes, so a failed task is retried and the output is
committed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Write a result as Parquet (optionally partitioned, e.g. by ``shard``)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_report_line(df: DataFrame, path: str, col: str = "line", mode: str = "overwrite") -> None:
    """Write a one-column text report (e.g. ``class_count_line``) as a text file."""
    df.select(col).coalesce(1).write.mode(mode).text(path)
