"""Language identification: multinomial naive Bayes over hashed character n-grams (operator 4)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import binary_list, passed_columns, schema_of, sliced, with_columns

UNKNOWN = "und"
#: Grams that are hashed and scored at once (bounds the memory of a task, whatever a text's length).
CHUNK = 1 << 18


@dataclass(frozen=True)
class LanguageModel:
    """``langs`` in order, ``logp`` (buckets x langs, float32) and ``prior`` (langs)."""

    langs: list[str]
    logp: np.ndarray
    prior: np.ndarray
    orders: tuple[int, ...]


def _codes(text: bytes) -> np.ndarray:
    s = text.decode("utf-8", "replace").lower()
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def has_letter(text: bytes | None) -> bool:
    return bool(text) and any(map(str.isalpha, text.decode("utf-8", "replace")))


def gram_buckets(codes: np.ndarray, orders: tuple[int, ...], buckets: int):
    """Yield arrays of bucket numbers: the hashed n-grams of one text, ``CHUNK`` at a time."""
    for n in orders:
        for s in range(0, max(0, len(codes) - n + 1), CHUNK):
            part = codes[s:s + CHUNK + n - 1]
            h = np.full(len(part) - n + 1, n, np.uint32)
            for i in range(n):
                h *= np.uint32(0x01000193)
                h ^= part[i:len(part) - n + 1 + i] * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x85EBCA6B)
            yield (h >> np.uint32(8)) & np.uint32(buckets - 1)


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id", buckets: int = 1 << 16,
        orders: tuple[int, ...] = (2, 3), per_lang: int = 4_000, max_langs: int = 256,
        alpha: float = 0.1, partitions: int = 12) -> LanguageModel:
    """Fit on about ``per_lang`` texts of each language at most (all of them if there are fewer).

    The sample takes the rows whose hashed id lies under the language's share, so it is the same on each
    run and spread over the whole table. Rows with a NULL text, language or id teach nothing. Gram counts are
    added up by Spark; the driver gets ``buckets`` x languages sums. More than ``max_langs`` languages are an
    error: the matrix that goes to each task has buckets x max_langs floats at most.
    """
    rows = docs.select(F.col(text).alias("t"), F.col(lang).alias("l"), F.col(id_col).alias("i"))
    rows = rows.where(F.col("t").isNotNull() & F.col("l").isNotNull() & F.col("i").isNotNull())
    sizes = rows.groupBy("l").count().orderBy("l").limit(max_langs + 1).collect()
    if len(sizes) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs = [r["l"] for r in sizes]
    if not langs:
        return LanguageModel([], np.zeros((buckets, 0), np.float32), np.zeros(0), orders)
    n = np.array([r["count"] for r in sizes], float)
    share = F.element_at(F.create_map(*(F.lit(x) for k, c in zip(langs, n) for x in (k, min(1.0, per_lang / c)))),
                         F.col("l"))
    u = F.xxhash64("i").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    sample = rows.where(u < share).repartition(partitions, F.xxhash64("i"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in sliced(batches, 1 << 25, "t"):
            for t, k in zip(binary_list(b.column("t")), b.column("l").to_pylist()):
                acc = sums.setdefault(k, np.zeros(buckets, np.int64))
                for g in gram_buckets(_codes(t), orders, buckets):
                    acc += np.bincount(g, minlength=buckets)
        for k, acc in sums.items():
            at = np.flatnonzero(acc)
            yield pa.RecordBatch.from_arrays([pa.array([k] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                                              pa.array(acc[at])], names=["l", "g", "n"])

    found = (sample.select("t", "l").mapInArrow(count, "l string, g int, n long")
             .groupBy("l", "g").agg(F.sum("n").alias("n")).toArrow())
    counts = np.full((buckets, len(langs)), alpha)
    at = {k: i for i, k in enumerate(langs)}
    cols = np.array([at[k] for k in found.column("l").to_pylist()], np.int64)
    counts[found.column("g").to_numpy(), cols] += found.column("n").to_numpy()
    logp = np.log(counts / counts.sum(0)).astype(np.float32)
    return LanguageModel(langs, logp, np.log(n / n.sum()), orders)


def score_texts(model: LanguageModel, texts: list) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability of each text; ``und`` and 0 for NULL and texts without letters."""
    langs, scores = [], np.zeros(len(texts))
    buckets = len(model.logp)
    for r, t in enumerate(texts):
        if not model.langs or not has_letter(t):
            langs.append(UNKNOWN)
            continue
        total = model.prior.copy()
        for g in gram_buckets(_codes(t), model.orders, buckets):
            total += model.logp[g].sum(0, dtype=np.float64)
        best = int(total.argmax())  # the first of equals
        langs.append(model.langs[best])
        scores[r] = 1.0 / np.exp(total - total[best]).sum()
    return langs, scores


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score`` (0 to 1), from the whole text alone.

    NULL texts and texts without a letter are ``und`` with score 0, as are all texts under a model of no
    language. Ties go to the first language in sorted order. Input columns named like the results are replaced.
    Repeated rows score alike. Texts of any length are scored whole, one at a time. Empty in, empty out.
    """
    keep = passed_columns(docs, ["lang_pred", "lang_score"])
    # plain values: at most buckets x max_langs floats
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.logp, model.prior, model.orders))

    def run(batches):
        held = LanguageModel(*shared.value)
        for b in sliced(batches, 1 << 25, text):
            langs, scores = score_texts(held, binary_list(b.column(text)))
            yield with_columns(b, keep, {"lang_pred": pa.array(langs, pa.string()), "lang_score": pa.array(scores)})

    return docs.mapInArrow(run, schema_of(docs, keep, "lang_pred string, lang_score double"))


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4 (NULL for a NULL id)."""
    return F.crc32(F.col(id_col).cast("string")) % 4
