import math
import random
import re
from collections import Counter

import brute
import pytest
from tessera.llm import lexical
from tessera.llm.common import table
from tessera.llm.queries import op12_lexical


def terms(text):
    return [w.translate(brute.LOWER) for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def ranked(docs, items, k=10):
    """Every document scored in full: sorted (item, rank, doc, score)."""
    tf = [(i, Counter(terms(t))) for i, t in docs]
    tf = [(i, c) for i, c in tf if c]
    n_docs, n_terms = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(w for _, c in tf for w in c)
    out = []
    for item, text in items:
        found = []
        for i, c in tf:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                        for w in terms(text) if w in c)
            if score > 0:
                found.append((-score, i is None, i, score))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in table(spark, brute.SF, "documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in table(spark, brute.SF, "benchmark").select("item_id", "text").collect()]
    assert rows(op12_lexical(spark, brute.SF)) == ranked(docs, items)


DOCS = [(1, "Red fox, RED hen"), (2, None), (3, ""), (4, "..."), (5, "fox"), (6, "fox"), (None, "fox"), (6, "fox"),
        (7, "É1 é1 x\x7fy fox"), (8, "a " * 3000 + "fox"), (9, "hen hen hen"), (10, "none of these")]
ITEMS = [(1, "fox red FOX"), (2, "É1 hen"), (3, None), (4, ""), (5, "unknown words"), (None, "hen"), (1, "y x"), (6, "fox red FOX")]


@pytest.mark.parametrize("shard_bytes", [500_000, 10])
def test_edges_and_shards(spark, shard_bytes):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert rows(lexical.search(docs, items, k=4, shard_bytes=shard_bytes)) == ranked(DOCS, ITEMS, 4)


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "1 as k", "'x' as n", "2 as item", "3 as score", "4 as t")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 as t", "2 as doc_id")
    assert rows(lexical.search(docs, items, k=3)) == ranked(DOCS, ITEMS, 3)
    assert lexical.search(docs.limit(0), items).collect() == [] == lexical.search(docs, items.limit(0)).collect()
    assert lexical.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


@pytest.mark.parametrize("asks", [1_000_000, 0])
def test_many_blocks_with_ties(spark, monkeypatch, asks):
    monkeypatch.setattr(lexical, "ASKS", asks)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]

    def text(n):
        return " ".join(words[min(int(rng.expovariate(0.2)), 39)] for _ in range(n))

    docs = [(i, text(rng.randint(1, 60))) for i in range(500)]
    docs += [(500 + i, docs[i % 7][1]) for i in range(200)]  # copies: equal scores
    items = [(i, text(rng.randint(1, 12))) for i in range(12)]
    log = []
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                         spark.createDataFrame(items, "item_id long, text string"), first_block=4, growth=3, log=log)
    assert rows(got) == ranked(docs, items)
    assert len(log) > 3


def test_reading_closes_to_new_documents_and_asks_for_few(spark):
    # 20 documents hold the item, a common word stands in all: after the first block no other document can enter
    filler = [f"f{i}" for i in range(50)]
    rng = random.Random(6)
    item = " ".join(f"q{i}" for i in range(8)) + " the"
    docs = [(i, " ".join(rng.choices(filler, k=30)) + " the" * rng.randint(1, 9)) for i in range(2000)]
    docs = [(i, t + " " + item) if i % 100 == 0 else (i, t + " the") for i, t in docs]
    log = []
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string"),
                         first_block=64, log=log)
    assert rows(got) == ranked(docs, [(1, item)])
    assert log[0]["open"] == 0 and log[0]["candidates"] <= 40


def test_long_texts_are_taken_in_pieces(monkeypatch):
    text = ("Ab,cD 1é " * 500).encode()
    whole = [w for b in lexical.terms_of(text) for w in b]
    monkeypatch.setattr(lexical, "PIECE", 7)
    assert [w for b in lexical.terms_of(text) for w in b] == whole
    assert list(lexical.terms_of(None)) == [[]]
