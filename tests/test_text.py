from tessera.operators import text as T
from tessera.sources.text import line_documents


def lines_of(spark, rows):
    return spark.createDataFrame([(i, 0, t) for i, t in rows], "doc_id long, line_no int, text string")


def test_word_count_f2(spark):
    # fixture F2: (0,'a b a'), (1,'b  c ')
    df = lines_of(spark, [(0, "a b a"), (1, "b  c ")])
    want = {"a": 2, "b": 2, "": 2, "c": 1}
    for strategy in ("combine", "salted", "partial"):
        got = {r["word"]: r["n"] for r in T.word_count(df, strategy=strategy, K=3).collect()}
        assert got == want, strategy
    assert T.distinct_words(df).collect()[0][0] == 4
    assert abs(T.avg_word_length(df).collect()[0][0] - 0.75) < 1e-12
    assert T.doc_count(df).collect()[0][0] == 2
    terms = {(r["doc_id"], r["word"]): r["n"] for r in T.doc_term_count(df).collect()}
    assert terms[(0, "a")] == 2 and terms[(1, "")] == 2


def test_line_documents_whole_text(spark):
    long_text = "\n".join(f"line {i} " + "w " * 50 for i in range(1000))
    docs = spark.createDataFrame([(7, long_text), (8, "one")], "doc_id long, text string")
    out = line_documents(docs)
    assert out.count() == 1001
    assert out.where("doc_id = 7 and line_no = 999").collect()[0]["text"].startswith("line 999")
    assert T.word_count(out).where("word = 'w'").collect()[0]["n"] == 50_000


def test_non_ascii_and_tabs(spark):
    df = lines_of(spark, [(0, "é\tx é")])
    got = {r["word"]: r["n"] for r in T.word_count(df).collect()}
    assert got == {"é\tx": 1, "é": 1}


def test_doc_term_count_plans_no_exchange(spark):
    from tessera.operators import text as T
    df = spark.createDataFrame([(0, 0, "b a b  a"), (0, 1, ""), (1, 0, None)], "doc_id long, line_no int, text string")
    out = T.doc_term_count(df)
    assert sorted(map(tuple, out.collect())) == [(0, 0, "", 1), (0, 0, "a", 2), (0, 0, "b", 2), (0, 1, "", 1)]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
