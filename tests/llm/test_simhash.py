from tessera.llm import simhash
from tessera.llm.common import components, table
from tessera.llm.queries import op2_simhash
import brute


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in table(spark, brute.SF, "documents").select("doc_id", "text").collect()]
    got = {r[0]: (r[1], r[2]) for r in op2_simhash(spark, brute.SF).collect()}
    want = brute.simhash_groups(rows)
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_links_find_every_pair(spark):
    import random
    rng = random.Random(5)
    fps = []
    for _ in range(60):
        x = rng.getrandbits(64)
        fps += [x] + [x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5))) for _ in range(4)]
    fps += [fps[0] ^ 1 << a ^ 1 << b for a in range(24) for b in range(a)]  # a large group of near copies
    fps = sorted(set(fps))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    for distance in (0, 1, 3, 4):
        g = brute.Groups(signed)
        for i, x in enumerate(fps):
            for j in range(i):
                if (x ^ fps[j]).bit_count() <= distance:
                    g.join(signed[i], signed[j])
        edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), distance, block=50)
        got = {r.node: r.root for r in components(edges).collect()}
        assert {x: got.get(x, x) for x in signed} == {x: g.find(x) for x in signed}


def test_edges(spark):
    long = "word " * 40_000
    rows = [(5, None), (3, ""), (9, " \t\n"), (4, "one two"), (8, "ONE two"), (2, long), (7, long), (7, long), (None, "one two"), (None, "solo text here now")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, component string")
    got = sorted(((r.doc_id, r.component) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (4, 4), (8, 4), (2, 2), (7, 2), (7, 2), (None, 4), (None, None)], key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one_keeps_columns_and_one_row_of_each_group(spark):
    rows = [(3, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "z"), (None, "q r s", "n"), (None, "q r s", "m"), (4, None, "e"), (6, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted([(1, "a b c d"), (None, "q r s"), (4, None)], key=repr)


def test_components_of_a_long_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(60)]
    hub = [(1000, 1001 + i) for i in range(400)]
    edges = spark.createDataFrame(path + hub + [(7, 7), (None, 3)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(401)}}
    assert components(edges.limit(0)).count() == 0
