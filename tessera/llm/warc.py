"""Content-addressed WARC archive: payloads once by digest, exact record headers apart, records by joins (operator 11).

An archive is two tables in a folder. ``payloads`` holds the bytes of each different payload once, under their SHA-256,
which is computed again whenever they are read. ``headers`` holds each record's own bytes before its payload (WARC
and HTTP header, byte for byte) and its payload's digest. A record is header + payload + CRLF CRLF.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import dealt, discard, looked_up, written
from tessera.session import ensure_checkpoint_dir

#: Fixed values of the WARC format.
VERSION = "WARC/1.1"
END = "\r\n\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of one payload that meet it in the same task at most; those of a frequent one are dealt to several.
TOGETHER = 10_000


@dataclass
class Archive:
    """A written archive's folder."""

    spark: SparkSession
    path: str

    @property
    def headers(self) -> DataFrame:
        """``(id, copy, header, digest, part)``, a row for each record."""
        return self.spark.read.parquet(f"{self.path}/headers")

    @property
    def payloads(self) -> DataFrame:
        """``(digest, payload, records, parts, ...)``, a row for each different payload."""
        return self.spark.read.parquet(f"{self.path}/payloads")


def _folder(spark: SparkSession, path: str | None) -> str:
    return path or f"{ensure_checkpoint_dir(spark)}/archive-{uuid.uuid4().hex}"


def _store(rows: DataFrame, path: str) -> DataFrame:
    """Write the payloads of ``rows`` (digest, payload, key) once each, and read back all but their bytes.

    One exchange, behind a partial aggregate: a payload that a third of all rows have costs a row for each task.
    Payloads of one digest must agree in size and in a second hash. ``first`` is the smallest key, NULLs last.
    """
    check = F.xxhash64("payload")
    kept = rows.groupBy("digest").agg(
        F.first("payload").alias("payload"), F.count(F.lit(1)).alias("records"), F.min("key").alias("first"),
        F.min(F.octet_length("payload")).alias("size"), F.max(F.octet_length("payload")).alias("most"), F.min(check).alias("c0"), F.max(check).alias("c1"))
    digest = F.when((F.col("size") != F.col("most")) | (F.col("c0") != F.col("c1")), F.raise_error(F.lit("payloads of one digest differ"))).otherwise(F.col("digest"))
    (kept.select(digest.alias("digest"), "payload", "records", "first", F.ceil(F.col("records") / TOGETHER).cast("int").alias("parts"))
     .write.parquet(f"{path}/payloads"))
    return rows.sparkSession.read.parquet(f"{path}/payloads").drop("payload")


def _uri(url: Column) -> Column:
    """A URL that fits on a header line: white space and control characters are percent-encoded."""
    out = F.coalesce(url.cast("string"), F.lit(""))
    for code in [*range(0x21), 0x7F]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return out


def _lines(*lines) -> Column:
    """Header lines, those that are NULL left out, and the empty line after them."""
    return F.concat(F.concat_ws("\r\n", *(F.lit(x) if isinstance(x, str) else x for x in lines)), F.lit(END))


def _record_uri(id_: Column, mark: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(id_.cast("string")), F.lit("")), F.lit(":"), mark, F.lit(":"), copy.cast("string"), F.lit(">"))


def archive_pages(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url", body: str = "html",
                  least: int = 100) -> Archive:
    """Write one WARC record for each row of ``pages``; the payload is ``body`` in UTF-8 (NULL: empty).

    Of the records whose payloads are equal and of ``least`` bytes or more, that of the smallest id is a ``response``,
    and the others are ``revisit`` records that refer to it. Records of smaller payloads are all responses. In
    ``payloads`` the bytes of any payload are held once.

    Rows without an id come last when the smallest is looked for (then the smallest URL decides); rows that repeat an id and URL are
    numbered copies, of which the first may be the response. Texts of any length are one payload. No rows give an archive
    without records. Other columns are not read. ``path`` is a new folder (None: one under the checkpoint folder).

    Payloads are shuffled once; everything else moves ids, URLs and digests only.
    """
    spark, path = pages.sparkSession, _folder(pages.sparkSession, path)
    payload = F.coalesce(F.col(body).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(page_id).alias("id"), _uri(F.col(url)).alias("url"), payload.alias("payload")).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    key = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("url").alias("url"))
    stored = _store(rows.select("digest", "payload", key.alias("key")), path)
    small, at = written(rows.select("id", "url", "digest", F.octet_length("payload").alias("size"))
                       .groupBy("id", "url", "digest", "size").agg(F.count(F.lit(1)).alias("copies")))
    known = looked_up(small, stored.select("digest", "first", "parts"), "digest")
    some = ["id", "url", "digest", "size", "first", "parts"]
    # copies of a row that is there very often are numbered by several tasks
    runs = F.explode(F.expr(f"sequence(1L, copies, {TOGETHER}L)"))
    often = dealt(known.where(F.col("copies") > TOGETHER).select(*some, "copies", runs.alias("from")))
    each = (known.where(F.col("copies") <= TOGETHER).select(*some, "copies", F.lit(1).cast("long").alias("from")).unionByName(often)
            .select(*some, F.explode(F.expr(f"sequence(from, least(copies, from + {TOGETHER} - 1))")).alias("copy")))
    same = (F.col("id").eqNullSafe(F.col("first.id"))) & (F.col("url") == F.col("first.url")) & (F.col("copy") == 1)
    revisit = (F.col("size") >= least) & ~same

    def mark(u: Column) -> Column:
        return F.substring(F.md5(F.concat(F.hex("digest"), F.lit(" "), u)), 1, 16)

    uri = _record_uri(F.col("id"), mark(F.col("url")), F.col("copy"))
    origin = _record_uri(F.col("first.id"), mark(F.col("first.url")), F.lit(1))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(END))
    length = F.octet_length("http") + F.when(F.col("revisit"), 0).otherwise(F.col("size"))
    head = _lines(
        VERSION, F.concat(F.lit("WARC-Type: "), F.when(F.col("revisit"), "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), uri), F.concat(F.lit("WARC-Target-URI: "), F.col("url")), "WARC-Date: 1970-01-01T00:00:00Z",
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.lower(F.hex("digest"))), "Content-Type: application/http; msgtype=response",
        F.when(F.col("revisit"), F.concat(F.lit("WARC-Refers-To: "), origin)), F.when(F.col("revisit"), F.lit(f"WARC-Profile: {SAME_PAYLOAD}")),
        F.concat(F.lit("Content-Length: "), length.cast("string")))
    made = (each.select("*", revisit.alias("revisit"), http.alias("http"))
            .select("id", "copy", F.concat(head, F.col("http")).cast("binary").alias("header"), "digest",
                    F.pmod(F.xxhash64("id", "url", "copy"), F.col("parts")).cast("int").alias("part")))
    made.write.parquet(f"{path}/headers")
    discard(spark, at)
    return Archive(spark, path)


def field(name: str) -> Column:
    """The value of a field in the WARC part of the column ``header``; NULL if it is not there."""
    text = F.substring_index(F.col("header").cast("string"), END, 1)
    return F.nullif(F.regexp_extract(text, rf"(?i)\r\n{re.escape(name)}:[ \t]*([^\r\n]*)", 1), F.lit(""))


def verified(payloads: DataFrame) -> DataFrame:
    """``payloads`` with ``size``; a payload whose bytes don't have its digest raises."""
    right = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    checked = F.when(right, F.octet_length("payload").cast("long")).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.hex("digest"))))
    return payloads.select("*", checked.alias("size"))


def _met(archive: Archive, columns: list[str]) -> DataFrame:
    """Each record's header with ``columns`` of its payload.

    An equality join by (digest, part): the payload goes to each of its parts, so no task gets more than about
    ``TOGETHER`` records of a frequent payload.
    """
    dealt = verified(archive.payloads).select("digest", *columns, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return archive.headers.join(dealt, ["digest", "part"], "left")


def read_pages(archive: Archive) -> DataFrame:
    """``(id, payload_bytes, payload_digest, record_type, refers_to)`` of each record, read back from its header and payload.

    The digest in the header must be that of the stored bytes, which is computed again; else the read raises, also for a
    record whose payload is missing. ``refers_to`` is the id of the response that a revisit names; NULL for responses, and where
    that response has no id.
    """
    kind = archive.headers.schema["id"].dataType

    def page(name: str) -> Column:
        return F.url_decode(F.nullif(F.regexp_extract(field(name), "^<urn:page:([^:]*):[0-9a-f]{16}:[0-9]+>$", 1), F.lit(""))).cast(kind)

    stated = F.regexp_extract(field("WARC-Payload-Digest"), "^sha256:([0-9a-f]{64})$", 1)
    found = _met(archive, ["size"]).select(
        page("WARC-Record-ID").alias("id"), "size", "digest", stated.alias("stated"), field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"))
    right = F.col("size").isNotNull() & (F.unhex("stated") == F.col("digest"))
    size = F.when(right, F.col("size")).otherwise(F.raise_error(F.concat(F.lit("record without its payload: "), F.col("stated"))))
    return found.select("id", size.alias("payload_bytes"), F.col("stated").alias("payload_digest"), "record_type", "refers_to")


def records(archive: Archive, full: bool = False) -> DataFrame:
    """``(id, copy, header, payload)``: the records as they were written; a revisit's payload is empty.

    ``full`` gives revisits the payload they stand for as well.
    """
    out = _met(archive, ["payload"])
    own = F.col("payload") if full else F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return out.select("id", "copy", "header", own.alias("payload"))


def write_warc(rows: DataFrame, path: str) -> None:
    """Write ``(header, payload)`` rows as WARC files, one for each task, in any file system that Spark writes to.

    A record ends with CRLF CRLF, which is the separator of Spark's text writer: its lines are the records' bytes.
    """
    record = F.concat(F.col("header"), F.col("payload")).cast("string")
    rows.select(record.alias("value")).write.option("lineSep", END).text(path)


_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*(\d+)", re.I)
_HTTP = re.compile(rb"\r\nContent-Type:[ \t]*application/http", re.I)


def _parsed(data: bytes):
    """(place, header with the HTTP header, payload) of each record of a WARC file."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at) + 4
        length = _LENGTH.search(data, at, end)
        if not data.startswith(b"WARC/", at) or end < 4 or not length or end + int(length[1]) > len(data):
            raise ValueError(f"no WARC record at byte {at}")
        stop = end + int(length[1])
        body = end
        if _HTTP.search(data, at, end):
            cut = data.find(b"\r\n\r\n", end, stop)
            body = stop if cut < 0 else cut + 4
        yield at, data[at:body], data[body:stop]
        at = stop + 4


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``(file, place, header, payload)`` of each record of uncompressed WARC files.

    ``place`` is the record's first byte; ``header`` ends before the payload, after an HTTP header if the record has one.
    A file is read by one task, and must be under 2 GB; bytes that are no record raise.
    """
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0).select(F.col("path").alias("file"), "content")

    def run(batches):
        for b in batches:
            for name, data in zip(b.column("file").to_pylist(), b.column("content")):
                for place, header, payload in _parsed(data.as_py()):
                    yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([place], pa.int64()), pa.array([header], pa.binary()), pa.array([payload], pa.binary())],
                                                     names=["file", "place", "header", "payload"])

    return files.mapInArrow(run, "file string, place long, header binary, payload binary")


def archive_records(rows: DataFrame, path: str | None = None, key: str = "place") -> Archive:
    """Archive any ``(key, header, payload)`` records: headers as they are, each different payload once.

    ``records(archive, full=True)`` gives the very same headers and payloads. Rows that repeat are kept as often.
    NULL headers and payloads are empty. ``id`` in the archive is ``key``.
    """
    spark, path = rows.sparkSession, _folder(rows.sparkSession, path)
    whole = rows.select(F.col(key).alias("id"), F.coalesce("header", F.lit(b"")).alias("header"), F.coalesce("payload", F.lit(b"")).alias("payload")) \
        .withColumn("digest", F.unhex(F.sha2("payload", 256)))
    stored = _store(whole.select("digest", "payload", F.col("id").alias("key")), path)
    small, at = written(whole.select("id", "header", "digest"))
    known = looked_up(small, stored.select("digest", "parts"), "digest")
    known.select("id", F.lit(1).cast("long").alias("copy"), "header", "digest",
                 F.pmod(F.xxhash64("id", "header"), F.col("parts")).cast("int").alias("part")).write.parquet(f"{path}/headers")
    discard(spark, at)
    return Archive(spark, path)
