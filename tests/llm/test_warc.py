import hashlib
import os
import random

import brute
import pytest
from pyspark.errors import PySparkException
from tessera.llm import common, warc
from tessera.llm.common import table
from tessera.llm.queries import op11_warc


def told(rows, least=100):
    """(page, bytes, digest, type, refers to) of (page, url, html) rows."""
    first, out = {}, []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    for i, _, html in order:
        b = (html or "").encode()
        again = b in first and len(b) >= least
        first.setdefault(b, i)
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    return sorted(out, key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_matches_brute_force(spark):
    pages = [tuple(r) for r in table(spark, brute.SF, "pages").select("page_id", "url", "html").collect()]
    assert rows(op11_warc(spark, brute.SF)) == told(pages)


LONG = "<p>é" * 40 + "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nx"
PAGES = [(5, "u5", LONG), (2, "u2", LONG), (9, None, LONG), (None, "u", LONG), (3, "a\r\nWARC-Type: x y", "s" * 99), (4, "u4", "s" * 99), (6, "", "t" * 100),
         (7, "u7", "t" * 100), (8, "u8", None), (10, "u8", ""), (11, "u11", "é" * 50), (12, "big", "b\n" * 2_000_000), (2, "u2", LONG), (None, None, "only once" * 20)]
DDL = "page_id long, url string, html string"


@pytest.fixture()
def archive(spark):
    return warc.archive_pages(spark.createDataFrame(PAGES, DDL).repartition(4))


def test_edges(spark, archive):
    assert rows(warc.read_pages(archive)) == told(PAGES)
    assert rows(archive.payloads.groupBy("digest").count().select("count").distinct()) == [(1,)]
    assert archive.payloads.count() == len({p[2] or "" for p in PAGES})
    clash = spark.createDataFrame(PAGES, DDL).selectExpr("*", "1 as id", "'x' as digest", "2 as payload", "3 as copy", "4 as part")
    assert rows(warc.read_pages(warc.archive_pages(clash))) == told(PAGES)
    none = spark.createDataFrame([], DDL)
    assert warc.read_pages(warc.archive_pages(none)).collect() == []


def test_names_as_ids_come_back(spark):
    pages = [("a:b>c\r\nd", "u", "x" * 200), ("é", "u", "x" * 200), ("z z", "u", "y")]
    got = rows(warc.read_pages(warc.archive_pages(spark.createDataFrame(pages, "page_id string, url string, html string"))))
    assert [(r[0], r[3], r[4]) for r in got] == [("a:b>c\r\nd", "response", None), ("z z", "response", None), ("é", "revisit", "a:b>c\r\nd")]


def parse(data):
    """WARC records of a file, by the format alone: (fields, block)."""
    out = []
    while data:
        head, rest = data.split(b"\r\n\r\n", 1)
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        fields = dict(x.split(b": ", 1) for x in lines[1:])
        assert len(fields) == len(lines) - 1
        n = int(fields[b"Content-Length"])
        out.append((fields, rest[:n]))
        assert rest[n:n + 4] == b"\r\n\r\n"
        data = rest[n + 4:]
    return out


def test_files_are_warc_and_come_back_exactly(spark, archive, tmp_path):
    warc.write_warc(warc.records(archive), str(tmp_path / "w"))
    found = []
    for name in os.listdir(tmp_path / "w"):
        if name.startswith("part"):
            found += parse((tmp_path / "w" / name).read_bytes())
    assert len(found) == len(PAGES) == len({f[b"WARC-Record-ID"] for f, _ in found})
    ids = {f[b"WARC-Record-ID"]: b for f, b in found}
    for f, block in found:
        http, payload = block.split(b"\r\n\r\n", 1)
        kind, digest = f[b"WARC-Type"], f[b"WARC-Payload-Digest"].decode()
        if kind == b"revisit":
            assert payload == b""
            payload = ids[f[b"WARC-Refers-To"]].split(b"\r\n\r\n", 1)[1]
        assert digest == "sha256:" + hashlib.sha256(payload).hexdigest()
        assert f"Content-Length: {len(payload)}".encode() in http
    read = warc.read_warc(spark, str(tmp_path / "w"))
    again = warc.archive_records(read)
    assert sorted(map(tuple, warc.records(again, full=True).select("header", "payload").collect())) == \
        sorted(map(tuple, warc.records(archive).select("header", "payload").collect()))
    assert sorted(map(tuple, read.select("header", "payload").collect())) == sorted(map(tuple, warc.records(archive).select("header", "payload").collect()))


def test_other_records_keep_their_bytes(spark):
    rng = random.Random(4)
    given = [(i, bytes(rng.randrange(256) for _ in range(rng.randint(0, 40))), rng.choice([b"", b"\x00\xff\xfe", bytes(range(256))])) for i in range(60)] + [(1, None, None)] * 2
    kept = warc.archive_records(spark.createDataFrame(given, "place long, header binary, payload binary"))
    assert kept.payloads.count() == 3
    assert rows(warc.records(kept, full=True).selectExpr("id", "header", "payload")) == sorted(((i, bytearray(h or b""), bytearray(p or b"")) for i, h, p in given), key=repr)


def test_a_payload_that_a_third_of_all_pages_have_is_dealt(spark, monkeypatch):
    monkeypatch.setattr(common, "HUB_DEGREE", 3)
    monkeypatch.setattr(common, "HUBS", 10)
    monkeypatch.setattr(warc, "TOGETHER", 7)
    pages = [(i, f"u{i}", "same " * 30 if i % 3 == 0 else f"page {i} " * 20) for i in range(300)] + [(7, "u7", "again " * 20)] * 30
    archive = warc.archive_pages(spark.createDataFrame(pages, DDL))
    assert rows(warc.read_pages(archive)) == told(pages)
    assert archive.headers.groupBy("digest").agg({"part": "max"}).agg({"max(part)": "max"}).first()[0] == 14  # 100 records in 15 parts
    full = {r.id: r.payload.decode() for r in warc.records(archive, full=True).collect()}
    assert {i: h for i, h in full.items() if i != 7} == {i: h for i, _, h in pages if i != 7}


def test_changed_or_missing_payloads_raise(spark, tmp_path):
    archive = warc.archive_pages(spark.createDataFrame(PAGES[:6], DDL))
    for name, rows_ in (("changed", archive.payloads.selectExpr("digest", "cast('no' as binary) payload", "records", "first", "parts")),
                        ("missing", archive.payloads.limit(1))):
        path = str(tmp_path / name)
        archive.headers.write.parquet(path + "/headers")
        rows_.write.parquet(path + "/payloads")
        with pytest.raises(PySparkException, match="payload"):
            warc.read_pages(warc.Archive(spark, path)).collect()
    (tmp_path / "bad").write_bytes(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort\r\n\r\n")
    with pytest.raises(PySparkException, match="no WARC record"):
        warc.read_warc(spark, str(tmp_path / "bad")).collect()
