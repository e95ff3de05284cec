"""Lines with their place: the same under any ranges, and ids that cost no exchange."""

import io
import os
import random

import pytest

from tessera.sources import splits as L
from tessera.sources.text import read_points


def whole(data):
    out, at = [], 0
    for m in list(L._ENDS.finditer(data)):
        out.append((at, data[at:m.start()]))
        at = m.end()
    return out + ([(at, data[at:])] if at < len(data) else [])


def test_ranges_cut_anywhere_give_each_line_once(monkeypatch):
    rng = random.Random(9)
    for _ in range(400):
        data = "".join(rng.choice(["a", "é", "\n", "\r", "\r\n", "bc"]) for _ in range(rng.randint(0, 40))).encode()
        monkeypatch.setattr(L, "CHUNK_BYTES", rng.randint(1, 9))
        cuts = sorted({0, len(data), *(rng.randint(0, len(data)) for _ in range(4))})
        got = [x for a, b in zip(cuts, cuts[1:]) for x in L._lines(io.BytesIO(data), a, b)]
        assert got == whole(data), (data, cuts)


def test_ids_are_places_whatever_the_ranges(spark, tmp_path):
    texts = {"a.txt": "1,2\n3,4\r\n1,2\n", "b.txt": "5,6", "_hidden": "x", "c.txt": ""}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    want = [(0, "1,2"), (4, "3,4"), (9, "1,2"), (1 << L.OFFSET_BITS, "5,6")]
    for size in (1, 5, 1 << 20):
        df = L.lines_with_place(spark, str(tmp_path), range_bytes=size)
        assert sorted((r["id"], r["value"]) for r in df.collect()) == want
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    lines = spark.read.text(str(tmp_path / "a.txt")).collect()
    assert [r[0] for r in lines] == ["1,2", "3,4", "1,2"]
    points = read_points(spark, str(tmp_path))
    assert sorted((r["id"], tuple(r["v"])) for r in points.collect()) == [(i, tuple(map(float, v.split(",")))) for i, v in want]
    assert "Exchange" not in points._jdf.queryExecution().executedPlan().toString()


def test_refusals(spark, tmp_path, monkeypatch):
    with pytest.raises(FileNotFoundError):
        L.lines_with_place(spark, str(tmp_path / "none*"))
    (tmp_path / "a.gz").write_bytes(b"x")
    with pytest.raises(ValueError, match="compressed"):
        L.lines_with_place(spark, str(tmp_path))
    monkeypatch.setattr(L, "MOST_FILES", 0)
    with pytest.raises(ValueError, match="files"):
        L.lines_with_place(spark, str(tmp_path))


def test_a_centre_loop_over_shuffled_points_asks_for_no_partitions(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    from tessera.operators import kcenter as KC
    df = spark.range(200).selectExpr("id", "array(double(id * id % 31), double(id)) AS v").repartition(3, "id")
    monkeypatch.setattr(Frame, "rdd", property(lambda self: pytest.fail("an input's shuffle as a job of its own")))
    assert KC.k_center(df, 3).count() == 3


def test_equal_sixty_bits_fall_back_to_the_whole_key(monkeypatch):
    import hashlib

    import numpy as np
    import pyarrow as pa

    from tessera.plans import kernels as K
    ids = np.arange(20)
    best = K._Best(42)
    vecs = pa.array([[float(i)] for i in ids])
    best.offer(np.zeros(12, np.int64), np.zeros(12, np.int64), ids[:12], vecs[:12])
    best.offer(np.zeros(8, np.int64), np.zeros(8, np.int64), ids[12:], vecs[12:])
    assert best.rows[0][2] == min(range(20), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
