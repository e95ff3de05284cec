"""The registered queries of the training-data operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, embdedup, filteraudit, langid, lexical, licenses, oracle, packing, pii, quality, sadedup, secrets, simhash, warc
from tessera.llm.common import table

WINDOW = 13
#: Tokens of a packed sequence; as many pieces may be in it.
TOKENS = 2048
#: The pseudonyms' key where the session sets none.
PII_KEY = "documents"


def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = decontam.decontaminate(docs, table(spark, sf, "benchmark"), window=WINDOW)
    return out.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op3_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return embdedup.near_duplicates(table(spark, sf, "embeddings"), threshold=0.9)


def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(langid.fold() != 2))
    return langid.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(langid.fold() == 2, F.lit(False)).alias("held_out"), "lang_pred",
        F.col("lang_score").alias("score"))


def op5_secrets(spark: SparkSession, sf: str) -> DataFrame:
    out = secrets.scan(table(spark, sf, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", *(count(k) for k, *_ in secrets.BASE), F.sha2(secrets.as_text(F.col("base")), 256).alias("base_sha256"),
                      secrets.as_text(F.col("spans")).alias("spans"))


def op6_repeats(spark: SparkSession, sf: str) -> DataFrame:
    out = sadedup.remove_repeats(table(spark, sf, "documents"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_licenses(spark: SparkSession, sf: str) -> DataFrame:
    out = licenses.scan(table(spark, sf, "documents"), keep=["doc_id"])
    labels = F.array_sort(F.array_union("base_labels", F.transform("found", lambda s: s["label"])))
    return out.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                      F.array_min("places").alias("first_word"), F.array_max("places").alias("last_word"),
                      F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), "score")


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.pseudonymize(docs, key=pii.key_of(spark, PII_KEY)).select("doc_id", "text", *(f"n_{k}" for k in pii.KINDS))


def op9_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"), packing.tokenizer_file(), tokens=TOKENS, segments=TOKENS,
                        specials=True).drop("ids")


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.classify(table(spark, sf, "documents").select("doc_id", "text"), labels=table(spark, sf, "labels"))
    return out.drop("text")


def op11_warc(spark: SparkSession, sf: str) -> DataFrame:
    archive = warc.archive_pages(table(spark, sf, "pages"))
    return warc.read_pages(archive).withColumnRenamed("id", "page_id")


def op12_lexical(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filteraudit.interactions(filteraudit.failure_masks(table(spark, sf, "documents"), table(spark, sf, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_simhash": op2_simhash,
    "op3_embeddings": op3_embeddings,
    "op4_language": op4_language,
    "op5_secrets": op5_secrets,
    "op6_repeats": op6_repeats,
    "op7_licenses": op7_licenses,
    "op8_pii": op8_pii,
    "op9_packing": op9_packing,
    "op10_quality": op10_quality,
    "op11_warc": op11_warc,
    "op12_lexical": op12_lexical,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE_SQL: dict[str, str] = {
    "op1_decontaminate": oracle.DECONTAMINATE,
    "op3_embeddings": oracle.EMBEDDINGS,
    "op6_repeats": oracle.REPEATS,
    "op11_warc": oracle.WARC,
    "op12_lexical": oracle.LEXICAL,
    "op13_filter_audit": oracle.FILTER_AUDIT,
}
