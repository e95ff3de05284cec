import brute

from tessera.llm import licenses as L
from tessera.llm.common import table
from tessera.llm.queries import op7_licenses


def scanned(text):
    """(words, places, base labels, labels, score) by hand."""
    w = brute.words(text)
    places, base = [], set()
    for phrase, label in L.PHRASES:
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    labels, best = set(base), 0.0
    for label, t in L.TEMPLATES:
        t = brute.words(t)
        on = sorted({i - j for j in range(len(t) - L.GRAM + 1) for i in range(len(w) - L.GRAM + 1) if w[i:i + L.GRAM] == t[j:j + L.GRAM]})
        groups = []
        for d in on:
            if groups and d - groups[-1][-1] <= L.SLACK:
                groups[-1].append(d)
            else:
                groups.append([d])
        for g in groups:
            share = sum(any(0 <= d + j < len(w) and w[d + j] == x for d in g) for j, x in enumerate(t)) / len(t)
            if share >= L.VERIFIED:
                labels.add(label)
                best = max(best, share)
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best


def test_query_matches_brute_force(spark):
    want = {r.doc_id: scanned(r.text) for r in table(spark, brute.SF, "documents").collect()}
    assert {r[0]: tuple(r)[1:] for r in op7_licenses(spark, brute.SF).collect()} == want


NOTICE = L.TEMPLATES[1][1]
CASES = [None, "", "mit", "MIT  License, the mit-license", "license mit", "general Public LICENSE general public license x apache license",
         "foo " * 5000 + NOTICE + " bar" * 10, NOTICE.replace("free of charge", "free of any charge at all"), NOTICE[:120],
         " ".join(NOTICE.split()[::2]), "Licensed under CC BY-NC 4.0. " * 40, "é licensed under cc by é nc 4.0", "to this", NOTICE + " " + NOTICE]


def test_edges(spark):
    df = spark.createDataFrame([(k if k != 4 else None, t, 1) for k, t in enumerate(CASES + CASES[3:4])], "doc_id long, text string, n_words int")
    out = L.scan(df)
    assert out.columns == ["doc_id", "text", "n_words", "places", "base_labels", "found", "score"]
    got = out.collect()
    assert len(got) == len(CASES) + 1
    for r in got:
        labels = ",".join(sorted({*r.base_labels, *(f.label for f in r.found)}))
        places = r.places
        assert (r.n_words, len(places), min(places, default=None), max(places, default=None), ",".join(r.base_labels), labels, r.score) == scanned(r.text)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert L.scan(df.limit(0)).count() == 0


def test_found_spans(spark):
    df = spark.createDataFrame([("a b c " + NOTICE + " tail",)], "text string")
    f = L.scan(df).first().found
    assert [(x.label, x.share, x.first, x.last) for x in f] == [("mit", 1.0, 3, 2 + len(brute.words(NOTICE)))]
