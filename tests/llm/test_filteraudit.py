import itertools
import random
import re

import brute
import pytest
from tessera.llm import filteraudit as A
from tessera.llm.common import table
from tessera.llm.queries import op13_filter_audit


def fails(rows):
    """(part, failing filters) of (id, text, part) rows, in plain Python."""
    out = []
    for i, t, part in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A"} if len(w) < 200 else set()
        f |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        f |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        f |= {"E"} if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows) else set()
        out.append((part or "", f))
    return out


def audited(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    docs = [(p, f, i in good, i in toxic) for (i, _, _), (p, f) in zip(rows, fails(rows))]
    out = {}
    for part in {p for p, *_ in docs}:
        mine = [d[1:] for d in docs if d[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                total[x] += len(gone)
                out[part, "".join(order), step] = (
                    len(left), len(gone), sum(x in d[0] for d in mine) - len(gone), sum(d[0] == {x} for d in mine),
                    sum(d[1] for d in gone), sum(d[2] for d in gone))
        for key in [k for k in out if k[0] == part]:
            out[key] += (total[key[1][key[2] - 1]],)
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    out = {r[:3]: r[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in table(spark, brute.SF, "documents").select("doc_id", "text", "source").collect()]
    labels = [tuple(r) for r in table(spark, brute.SF, "labels").select("doc_id", "quality", "toxic").collect()]
    assert got(op13_filter_audit(spark, brute.SF)) == audited(docs, labels)


ROWS = [(1, None, None), (2, "", "a"), (3, "x " * 300, "a"), (3, "x " * 300, "a"), (9, "x " * 300, "b"), (None, "x " * 300, "a"),
        (4, " ".join(f"w{i}" for i in range(200)), "a"), (5, " ".join(f"w{i}" for i in range(200)) + " É#", ""),
        (6, "ABC", "b"), (7, "a\x0bb c " * 150, "b"), (None, None, "b"), (8, "X" + "y" * 49, "c"), (10, "X" + "y" * 48, "c"),
        (11, "é" * 98 + "XX", "c"), (12, "é" * 97 + "XX", "c")]
LABELS = [(2, 1, 1), (3, 1, 0), (3, 0, 1), (9, None, 1), (None, 1, 1), (4, 1, None), (99, 1, 1)]


def test_edges(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    want = audited(ROWS, LABELS)
    assert got(A.interactions(A.failure_masks(docs, labels))) == want
    clash = docs.selectExpr("*", "1 as mask", "'p' as part", "2 as n", "'x' as doc", "0 as digest", "1 as good")
    assert got(A.interactions(A.failure_masks(clash, labels))) == want
    assert all(v[4] == v[5] == 0 for v in got(A.interactions(A.failure_masks(docs))).values())
    assert got(A.interactions(A.failure_masks(docs.limit(0), labels))) == {}
    assert got(A.interactions(A.failure_masks(docs, labels.limit(0)))).keys() == want.keys()


def test_a_text_and_an_id_that_a_third_of_all_rows_hold(spark, monkeypatch):
    from tessera.llm import common
    monkeypatch.setattr(common, "HUB_DEGREE", 3)
    monkeypatch.setattr(common, "HUBS", 10)
    rng = random.Random(1)
    rows = [(i if i % 4 else 7, "same" if i % 3 else f"t {i}", f"s{i % 3}") for i in range(300)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 300, 2)] + [(7, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    masks = A.failure_masks(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got(A.interactions(masks)) == audited(rows, labels)


def test_long_texts_are_taken_in_pieces(monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(n)) for n in (150, 250, 400)] + ["y" * 400, " " * 300]
    whole = [A.text_mask(t.encode()) for t in texts]
    monkeypatch.setattr(A, "PIECE", 5)
    assert [A.text_mask(t.encode()) for t in texts] == whole


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
def test_swaps_visit_every_order_once_and_keep_the_counts(k):
    rng = random.Random(k)
    masks = {m: (rng.randint(1, 9),) for m in range(1 << k) if rng.random() < 0.6} or {0: (1,)}
    d = A.Diagram(k, masks, 1)
    seen = set()
    for level in [None, *A.adjacent_swaps(k)]:
        if level is not None:
            d.swap(level)
        assert tuple(d.order) not in seen
        seen.add(tuple(d.order))
        gone = 0
        for f, left, out in d.all_pass():
            gone |= 1 << f
            assert left == (sum(w[0] for m, w in masks.items() if not m & gone),)
            assert out == (sum(w[0] for m, w in masks.items() if m & 1 << f and not m & (gone ^ 1 << f)),)
    assert len(seen) == len(list(itertools.permutations(range(k))))
