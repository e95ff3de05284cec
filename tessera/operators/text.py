"""Word counting over line documents ``(doc_id, line_no, text)``.

Tokens are split on the single space character and empty tokens are kept, as
in Python's ``str.split(' ')``. Whole texts are processed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOC_KEYS = ("doc_id", "line_no")


def tokens(lines: DataFrame, text_col: str = "text", keys=DOC_KEYS) -> DataFrame:
    """One row per token: ``(*keys, word)``."""
    return lines.select(*keys, F.explode(F.split(F.col(text_col), " ")).alias("word"))


def doc_term_count(lines: DataFrame, text_col: str = "text", keys=DOC_KEYS) -> DataFrame:
    """Per-document term counts ``(*keys, word, n)``; a document is one row, so nothing is shuffled.

    Equal words of the sorted words of a row are runs; a run's length is its word's count.
    """
    words = F.array_sort(F.split(F.col(text_col), " "))
    rows = lines.where(F.col(text_col).isNotNull()).select(*keys, words.alias("_words"))
    w = F.col("_words")
    starts = F.array_compact(F.transform(w, lambda x, i: F.when((i == 0) | (x != F.get(w, i - 1)), i)))
    rows = rows.select(*keys, "_words", starts.alias("_starts"))
    s = F.col("_starts")
    runs = F.transform(s, lambda i, k: F.struct(
        F.get(w, i).alias("word"), (F.coalesce(F.get(s, k + 1), F.size(w)) - i).cast("long").alias("n")))
    return rows.select(*keys, F.inline(runs))


def word_count(lines: DataFrame, text_col: str = "text", strategy: str = "combine",
               K: int = 8, keys=DOC_KEYS) -> DataFrame:
    """``(word, n)`` over all documents.

    ``strategy``:
      * ``combine`` / ``partial`` — one aggregate; Spark's partial aggregate is
        the per-partition combine, so a hot word ships one row per map task.
      * ``salted`` — two rounds: counts per ``(salt, word)`` with
        ``salt = pmod(xxhash64(doc, line, word), K)``, then per word. Each
        first-round group holds about 1/K of a hot word's documents.
    """
    if strategy in ("combine", "partial"):
        words = lines.select(F.explode(F.split(F.col(text_col), " ")).alias("word"))
        return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    if strategy == "salted":
        if K <= 0:
            raise ValueError("K must be positive")
        tok = tokens(lines, text_col, keys)
        salted = tok.select(F.pmod(F.xxhash64(*keys, "word"), F.lit(K)).alias("salt"), "word")
        first = salted.groupBy("salt", "word").agg(F.count(F.lit(1)).alias("n"))
        return first.groupBy("word").agg(F.sum("n").alias("n"))
    raise ValueError(f"unknown strategy {strategy!r}")


def distinct_words(lines: DataFrame, text_col: str = "text", approx: bool = False) -> DataFrame:
    words = lines.select(F.explode(F.split(F.col(text_col), " ")).alias("word"))
    if approx:
        return words.agg(F.approx_count_distinct("word").alias("n_distinct"))
    return words.agg(F.countDistinct("word").alias("n_distinct"))


def avg_word_length(lines: DataFrame, text_col: str = "text") -> DataFrame:
    """Mean length (in characters) of the distinct words, unweighted by frequency."""
    words = lines.select(F.explode(F.split(F.col(text_col), " ")).alias("word")).distinct()
    return words.agg(F.avg(F.length("word")).alias("avg_len"))


def doc_count(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("n_docs"))
