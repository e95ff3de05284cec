"""Structured Streaming form of the counting operators.

The batch operators are plain aggregations, so they run unchanged on a
streaming DataFrame: a folder of text files read with ``readStream`` yields
lines, and the word or class counts are kept as streaming state (complete or
update output mode). The source has no event time, so there is no watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.operators import classes as C
from tessera.operators import text as T
from tessera.sources.text import parse_pairs


def text_lines_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming lines ``(doc_id, line_no, text)`` of the text files arriving in ``folder``.

    Each line is one document (as in the batch reader); ``doc_id`` is a hash of
    the file name and the line, ``line_no`` is 0.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.load(folder)
    return raw.select(F.xxhash64(F.input_file_name(), F.col("value")).alias("doc_id"),
                      F.lit(0).alias("line_no"), F.col("value").alias("text"))


def word_count_stream(lines: DataFrame) -> DataFrame:
    """Running ``(word, n)`` over a streaming line source."""
    return T.word_count(lines)


def class_count_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Running ``(class, n)`` over ``<id> <class>`` lines arriving in ``folder``."""
    lines = spark.readStream.format("text").load(folder)
    return C.class_count_direct(parse_pairs(lines))


def start(counts: DataFrame, checkpoint_location: str, sink: str = "memory",
          name: str | None = None, output_mode: str = "complete", **options) -> StreamingQuery:
    """Start a counting query; ``checkpoint_location`` must be a shared folder on a cluster."""
    w = counts.writeStream.outputMode(output_mode).format(sink).option(
        "checkpointLocation", checkpoint_location)
    for k, v in options.items():
        w = w.option(k, v)
    if name:
        w = w.queryName(name)
    return w.start()
