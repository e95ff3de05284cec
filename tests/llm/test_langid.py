import math
import zlib
from collections import Counter

import numpy as np

from tessera.llm import langid
from tessera.llm.common import table
from tessera.llm.queries import op4_language
import brute


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in table(spark, brute.SF, "documents").collect()}
    got = op4_language(spark, brute.SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in held) >= 0.97 * len(held) > 0


def test_scores_match_a_plain_naive_bayes(spark):
    docs = [(0, "la casa", "es"), (1, "el perro y la casa", "es"), (2, "the house", "en"), (3, "the dog and the house", "en"), (4, "lost", None), (None, "none", "xx")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    m = langid.fit(df, orders=(2,), alpha=0.5)
    assert m.langs == ["en", "es"]
    grams = lambda t: Counter(t[i:i + 2] for i in range(len(t) - 1))
    train = {k: sum((grams(t) for _, t, x in docs if x == k), Counter()) for k in m.langs}
    for text in ("the cat", "La Perra", "zz"):
        logs = [math.log(0.5) + sum(n * math.log((train[k][g] + 0.5) / (sum(train[k].values()) + 0.5 * len(m.logp)))
                                    for g, n in grams(text.lower()).items()) for k in m.langs]
        want = np.exp(np.array(logs) - max(logs))
        langs, score = langid.score_texts(m, [text.encode()])
        assert langs == [m.langs[int(np.argmax(logs))]] and abs(score[0] - 1 / want.sum()) < 1e-4


def test_edges(spark):
    df = spark.createDataFrame([(0, "hello there", "en"), (1, "bonjour tous", "fr")], "doc_id long, text string, lang string")
    m = langid.fit(df)
    long = "hello there " * 60_000
    rows = [(0, None), (1, ""), (2, "123 ... 4"), (None, "hello"), (4, long), (4, long), (5, "é")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, lang_score int")
    out = langid.predict(docs, m)
    assert out.columns == ["doc_id", "text", "lang_pred", "lang_score"]
    got = [(r.doc_id, r.lang_pred, round(r.lang_score, 3)) for r in out.collect()]
    assert got[:3] == [(0, "und", 0.0), (1, "und", 0.0), (2, "und", 0.0)]
    assert got[3][:2] == (None, "en") and got[4] == got[5] == (4, "en", 1.0) and got[6][1] in m.langs
    assert langid.predict(docs.limit(0), m).count() == 0
    none = langid.fit(df.limit(0))
    assert none.langs == [] and {r.lang_pred for r in langid.predict(docs, none).collect()} == {"und"}


def test_long_texts_are_scored_whole(spark):
    codes = langid._codes(("ab" * langid.CHUNK + "c").encode())
    n = sum(len(g) for g in langid.gram_buckets(codes, (2, 3), 1 << 16))
    assert n == 2 * len(codes) - 3
