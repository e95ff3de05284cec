import subprocess
import sys

import numpy as np

from tessera.llm import embdedup
from tessera.llm.common import table
from tessera.llm.queries import op3_embeddings
import brute


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, brute.SF, "embeddings").collect()]
    assert {r[0]: tuple(r)[1:] for r in op3_embeddings(spark, brute.SF).collect()} == brute.cosine_groups(rows)


def vectors():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    near = [c + rng.normal(size=16) * s for c in centres for s in (0.05, 0.2, 0.3, 0.4, 0.5, 0.6)]
    rows = [(k, v.tolist()) for k, v in enumerate(near)]
    return rows + [(100, rows[3][1]), (101, rows[3][1]), (102, (np.array(rows[3][1]) * 1e-30).tolist()), (103, [0.0] * 16), (104, None),
                   (105, [float("nan")] * 16), (106, [float("inf")] + [0.0] * 15), (107, [None] + [1.0] * 15), (108, []), (109, [1.0]), (110, [2.0])]


def test_tiles_edges_and_copies(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, n_links string")
    want = brute.cosine_groups(rows)
    for per in (3, 8192):
        monkeypatch.setattr(embdedup, "BLOCK_ROWS", per)
        assert {r[0]: tuple(r)[1:] for r in embdedup.near_duplicates(df).collect()} == want
    assert embdedup.near_duplicates(df.limit(0)).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0]), (4, [1.0, 0.01]), (4, [1.0, 0.02]), (None, [0.0, 1.0]), (9, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((tuple(r) for r in embdedup.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(None, 2, 4, False), (4, 2, 4, True), (4, 2, 4, True), (None, 0, None, True), (9, 0, 9, True)], key=repr)


def test_error_bound_holds_in_high_dimension():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(40, 2100)), rng.normal(size=(30, 2100))
    b[:20] = a[:20] + rng.normal(size=(20, 2100)) * np.linspace(0.3, 0.7, 20)[:, None]
    qa, qb = embdedup.quantise(a), embdedup.quantise(b)
    exact = qa[0] @ qb[0].T
    approx = (qa[1].astype(float) @ qb[1].T) * qa[2][:, None] * qb[2]
    bound = (1 + qa[3])[:, None] * qb[3] + qa[3][:, None] * (1 + qb[3]) + qa[3][:, None] * qb[3]
    assert (np.abs(exact - approx) <= bound).all()
    for t in (0.8, 0.9, 0.95):
        got = {(int(i), int(j)) for x, y in embdedup.linked_pairs(qa, qb, t, False) for i, j in zip(x, y)}
        assert got == set(zip(*(z.tolist() for z in np.nonzero(exact >= t))))


def test_dense_tiles_keep_no_pairs():
    code = """
import resource, numpy as np, pyarrow as pa
from tessera.llm import embdedup as E
rng = np.random.default_rng(1)
x = (rng.normal(size=64) + rng.normal(size=(6000, 64)) * 0.05).astype("<f4")
one, two = x[:3000], x[3000:]
row = lambda blk, v: dict(dim=64, i=0, j=1, blk=blk, nodes=(np.arange(3000) + 3000 * blk).astype("<i8").tobytes(),
                          copies=np.ones(3000, "<i8").tobytes(), vectors=v.tobytes())
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
out = pa.Table.from_batches(E._tiles("<f4", 0.9)([pa.RecordBatch.from_pylist([row(0, one), row(1, two)])]))
assert out.num_rows == 6000 and set(out["root"].to_pylist()) == {0} and set(out["n"].to_pylist()) == {3000}
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 300


def test_labels_of_streamed_pairs():
    rng = np.random.default_rng(3)
    for n, m in ((50, 30), (300, 290), (40, 400)):
        i, j = rng.integers(0, n, (2, m))
        label = np.arange(n)
        for s in range(0, m, 7):
            label = embdedup._join(label, i[s:s + 7], j[s:s + 7])
        want = np.arange(n)
        for _ in range(n):
            for a, b in zip(i, j):
                want[a] = want[b] = min(want[a], want[b])
        assert (label == want).all()
