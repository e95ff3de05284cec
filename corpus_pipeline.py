"""The corpus pipeline: language ID, near-dedup, decontamination, PII, packing, over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame;
all but the last return the columns of ``documents``, also those named like an operator's results. ``run`` writes each stage's rows as Parquet under the
checkpoint folder and hands the reread table to the next.

Empty tables give empty tables. NULL ids, NULL texts, repeated rows and extra columns pass through the stages
by the rules in each stage's docstring.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, packing, pii, simhash
from tessera.llm.common import table
from tessera.session import ensure_checkpoint_dir

#: Contract of SimHash near-dedup: words in a shingle, most differing bits of a link.
SHINGLE, DISTANCE = 3, 3
#: Tokens of a packed sequence; as many pieces may be in it.
TOKENS = 2048
#: A document whose language has a posterior below this is rejected, as is one of unknown language.
LEAST_SCORE = 0.5
#: The pseudonyms' key where the session sets none (``pii.KEY_SETTING``).
KEY = "corpus-pipeline"


#: The columns that the stages read.
READ = ("doc_id", "text", "lang")


def _hidden(docs: DataFrame) -> DataFrame:
    """``docs`` with names for the other columns that no operator's result carries."""
    return docs.toDF(*(c if c in READ else f"__doc_column_{k}" for k, c in enumerate(docs.columns)))


def _restored(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` in ``out``, which an operator made of ``_hidden(docs)``."""
    return out.select(*(F.col(h).alias(c) for h, c in zip(_hidden(docs).columns, docs.columns)))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a language the model knows; NULL texts and texts without a letter go.

    The model learns from the stage's own labelled documents. Without any label nothing can be told, and
    every document with a letter stays.
    """
    model = langid.fit(docs.where(langid.fold() != 2))
    if not model.langs:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    out = langid.predict(_hidden(docs), model)
    return _restored(out.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= LEAST_SCORE)), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies: that of the smallest id.

    Rows without an id are a group's survivor only if it has no other; of rows that repeat an id one stays.
    """
    return _restored(simhash.keep_one(_hidden(docs), shingle=SHINGLE, distance=DISTANCE), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents contaminated by ``benchmark``; all others stay as they are, NULL texts too."""
    out = decontam.decontaminate(_hidden(docs), table(spark, sf_dir, "benchmark"))
    return _restored(out.where(~F.col("contaminated")), docs)


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in ``text`` by pseudonyms of the same format (and length); no document goes."""
    return _restored(pii.pseudonymize(_hidden(docs), key=pii.key_of(spark, KEY)), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed training sequences, with their ids."""
    return packing.pack(docs, packing.tokenizer_file(), tokens=TOKENS, segments=TOKENS, specials=True)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("pii", pii_pseudonyms), ("packing", pack_sequences)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each written to the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    base = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs


#: SQL can express neither the classifier nor the tokenizer: the stages are tested against brute force.
ORACLE_SQL = None
