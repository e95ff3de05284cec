import numpy as np

from tessera.llm import quality as Q
from tessera.llm.common import table
from tessera.llm.queries import op10_quality

SF = "/root/testdata/sf0.01"


def test_labels_are_found_again(spark):
    """No gold quality label is used; toxic ones name words. Measured on all labelled documents."""
    labels = {r.doc_id: r for r in table(spark, SF, "labels").collect()}
    got = {r.doc_id: r for r in op10_quality(spark, SF).collect()}
    assert len(got) == table(spark, SF, "documents").count()
    assert all(0 <= r.score <= 1 for r in got.values())
    bad = [i for i, r in labels.items() if r.quality == 0]
    fine = [i for i, r in labels.items() if r.quality == 1 and r.toxic == 0]
    assert sum(got[i].quality < 0.5 for i in bad) >= 0.85 * len(bad) > 0
    assert sum(got[i].keep for i in fine) >= 0.97 * len(fine) > 0


def test_em_finds_accuracies_again():
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.8
    votes = np.full((len(y), 5), Q.ABSTAIN)
    acc = [0.95, 0.85, 0.9, 0.8, 0.9]
    for j, a in enumerate(acc):
        says = np.where(rng.random(len(y)) < a, y, ~y)
        seen = rng.random(len(y)) < 0.8
        votes[seen, j] = says[seen]
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    m = Q.expectation_maximisation(patterns, n.astype(float))
    assert abs(m.prior - 0.8) < 0.02
    for j, a in enumerate(acc):
        assert abs(m.table[j, 1, Q.GOOD] - a) < 0.02 and abs(m.table[j, 0, Q.BAD] - a) < 0.04
    assert ((m.posterior(votes) > 0.5) == y).mean() > 0.95


def test_edges(spark):
    good = "The weather was mild today. We walked along the river and talked about books. "
    rows = [(0, None), (1, ""), (2, " \n"), (None, good * 3), (4, good * 30_000), (5, good * 3), (5, good * 3), (6, "you stupid pathetic idiot " + good)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    out = Q.classify(docs)
    assert out.columns == ["doc_id", "text", "score", "keep", "quality", "clean", "weak_quality", "weak_clean"]
    got = out.collect()
    assert [r.score for r in got[:3]] == [0, 0, 0] and not any(r.keep for r in got[:3])
    assert got[3].score == got[5].score == got[6].score
    assert Q.classify(docs.limit(0)).count() == 0


def test_marked_words(spark):
    docs = spark.createDataFrame([(k, f"plain words {'zorg' if k % 4 == 0 else 'fine'} n{k}") for k in range(80)] + [(None, "zorg"), (81, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(80)] + [(1, None), (None, 1), (81, 1)], "doc_id long, toxic int")
    assert Q.marked_words(docs, labels, "toxic") == {b"zorg"}
    assert Q.marked_words(docs, labels.limit(0), "toxic") == frozenset()
