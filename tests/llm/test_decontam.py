import pytest

from tessera.llm import decontam
from tessera.llm.common import table
from tessera.llm.queries import op1_decontaminate
import brute


def judged(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated", "longest_match").collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in table(spark, brute.SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, brute.SF, "benchmark").collect()]
    want = {i: (n, h, len(f), brute.sha(",".join(f)), c) for i, n, h, f, c, m in brute.decontaminated(docs, items)}
    assert {r[0]: tuple(r)[1:] for r in op1_decontaminate(spark, brute.SF).collect()} == want
    assert any(v[4] for v in want.values()) and not all(v[4] for v in want.values())


ITEMS = [(1, "a b c d e f g h i j k l m n o p"), (2, "x y"), (2, "c d e f g h i j k l m n o q"), (3, "..."), (None, "lost"),
         (4, None), (5, "y"), (6, "b c d e f g h i j k l m n")]
DOCS = [(0, "zero A b C d e f g h i j k l m n end"), (1, "x Y x"), (2, None), (3, ""), (None, "x y"), (4, "y " * 3000),
        (1, "x Y x"), (5, "lost " * 30), (6, "a b c d e f g h i j k l"), (7, "q " * 100 + "x y " + "q " * 20)]


@pytest.mark.parametrize("shard_bytes", [2_000_000, 20])
def test_edges_and_shards(spark, shard_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    out = decontam.decontaminate(docs, items, shard_bytes=shard_bytes)
    assert judged(out) == sorted(brute.decontaminated(DOCS, ITEMS), key=repr)


def test_random_texts_against_brute_force(spark):
    import random
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, text(rng.randint(1, 9))) for i in range(12)]
    docs = [(i, text(rng.randint(0, 60))) for i in range(40)]
    out = decontam.decontaminate(spark.createDataFrame(docs, "doc_id long, text string"),
                                 spark.createDataFrame(items, "item_id long, text string"), window=5)
    assert judged(out) == sorted(brute.decontaminated(docs, items, 5), key=repr)


def test_clean_text_and_limits(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id long, text string")
    hit = "A b, c d e f g h i j k l m"
    docs = spark.createDataFrame([(0, f"Keep é {hit}. tail"), (1, "w " * 500 + hit + "! end"), (2, None)], "doc_id long, text string")
    got = lambda **k: {r.doc_id: r.clean_text for r in decontam.decontaminate(docs, items, clean_text=True, **k).collect()}
    assert got() == {0: "Keep é . tail", 1: "w " * 500 + "! end", 2: None}
    assert got(max_span=13)[1] == "w " * 500 + hit + "! end"  # under the length limit, and not contaminated
    assert got(max_span=13)[0] == "Keep é . tail"  # contaminated: all spans go


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x y", 7, "s")], "doc_id long, text string, n_hit int, item_ids string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    row = decontam.decontaminate(docs, items).first()
    assert row.n_hit == 2 and row.item_ids == ["2", "5"]
    assert decontam.decontaminate(docs.limit(0), items).count() == 0
    assert decontam.decontaminate(docs, items.limit(0)).first().n_hit == 0
