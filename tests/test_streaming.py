import os
import tempfile

from tessera.operators import text as T
from tessera.sources import tables
from tessera.streaming import counts as S

SF = "/root/testdata/sf0.001"


def test_streaming_word_count_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="tessera-stream-")
    src = os.path.join(base, "in")
    # the driver's documents, written as text files (one line = one document)
    tables.documents(spark, SF).select("text").repartition(3).write.text(src)
    q = S.start(S.word_count_stream(S.text_lines_stream(spark, src, 1)),
                os.path.join(base, "ckpt"), name="wc_stream")
    try:
        q.processAllAvailable()
        got = {r["word"]: r["n"] for r in spark.sql("SELECT * FROM wc_stream").collect()}
    finally:
        q.stop()
    batch_lines = spark.read.text(src).selectExpr("0L AS doc_id", "0 AS line_no", "value AS text")
    want = {r["word"]: r["n"] for r in T.word_count(batch_lines).collect()}
    assert got == want and len(got) > 100


def test_streaming_class_count_equals_batch(spark):
    from tessera.operators import classes as C
    from tessera.sources.text import pair_lines
    base = tempfile.mkdtemp(prefix="tessera-stream-cc-")
    src = os.path.join(base, "in")
    pair_lines(tables.event_pairs(spark, SF), "id", "class").repartition(4).write.text(src)
    q = S.start(S.class_count_stream(spark, src), os.path.join(base, "ckpt"), name="cc_stream")
    try:
        q.processAllAvailable()
        got = {r["class"]: r["n"] for r in spark.sql("SELECT * FROM cc_stream").collect()}
    finally:
        q.stop()
    want = {r["class"]: r["n"] for r in C.class_count_direct(tables.event_pairs(spark, SF)).collect()}
    assert got == want
