"""Text lines with their place: file, byte offset, and a 64-bit id made of both.

A Python data source reads files in ranges of bytes, as Spark's own text reader does: a range owns the lines that begin
in it. The place of a line does not depend on the ranges, so neither does its id, and nothing is shuffled for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Bytes of a range, and bytes read at once.
RANGE_BYTES = 128 << 20
CHUNK_BYTES = 1 << 22
# An id holds the file's number above this many bits of the offset: files of up to 1 PB, 8,191 of them.
OFFSET_BITS = 50
MOST_FILES = (1 << (63 - OFFSET_BITS)) - 1
SCHEMA = "file int, place long, value string"


class _Range(InputPartition):
    def __init__(self, file: int, path: str, start: int, end: int):
        self.file, self.path, self.start, self.end = file, path, start, end


_ENDS = re.compile(rb"\r\n|\r|\n")


def _lines(f, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines of a file that begin in [start, end); lines end with LF, CR LF or CR as in Spark's reader."""
    pos = max(0, start - 1)  # an end of a line right before the range shows that one begins with it
    f.seek(pos)
    at = None if start else 0
    parts: list[bytes] = []
    held = b""
    while True:
        chunk = f.read(CHUNK_BYTES)
        data, base = held + chunk, pos - len(held)
        pos += len(chunk)
        held = b""
        if chunk and data.endswith(b"\r"):
            held, data = b"\r", data[:-1]  # perhaps the first half of CR LF
        i = 0
        for m in _ENDS.finditer(data):
            if at is not None:
                yield at, b"".join(parts) + data[i:m.start()]
            parts, i = [], m.end()
            at = base + i
            if at >= end:
                return
        if at is not None:
            parts.append(data[i:])
        if not chunk:
            if at is not None and at < pos:
                yield at, b"".join(parts)
            return


class LineReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]], range_bytes: int):
        self.files, self.range_bytes = files, range_bytes

    def partitions(self) -> list[_Range]:
        return [_Range(k, path, s, min(size, s + self.range_bytes))
                for k, (path, size) in enumerate(self.files) for s in range(0, size, self.range_bytes)]

    def read(self, part: _Range) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        files, path = fs.FileSystem.from_uri(part.path)
        rows: list[tuple[int, bytes]] = []
        held = 0
        with files.open_input_file(path) as f:
            for place, line in _lines(f, part.start, part.end):
                rows.append((place, line))
                held += len(line) + 16
                if held >= CHUNK_BYTES:
                    yield _batch(part.file, rows)
                    rows, held = [], 0
        if rows:
            yield _batch(part.file, rows)


def _batch(file: int, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    text = [line.decode("utf-8", "replace") for _, line in rows]
    return pa.RecordBatch.from_arrays([pa.array([file] * len(rows), pa.int32()), pa.array([p for p, _ in rows], pa.int64()), pa.array(text, pa.string())],
                                      names=["file", "place", "value"])


class LineSource(DataSource):
    """``lines_with_place``: options ``files`` (a line of path, tab, size for each file) and ``rangeBytes``."""

    @classmethod
    def name(cls) -> str:
        return "lines_with_place"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineReader:
        files = [x.rsplit("\t", 1) for x in self.options["files"].split("\n") if x]
        return LineReader([(p, int(n)) for p, n in files], int(self.options["rangebytes"]))


def _listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """URI and size of the files of a path (a file, a folder or a glob), in order of their URIs; hidden ones are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    system = at.getFileSystem(conf)
    out = []
    for found in system.globStatus(at) or []:
        walk = system.listFiles(found.getPath(), True)
        while walk.hasNext():
            f = walk.next()
            if not f.getPath().getName().startswith(("_", ".")):
                out.append((f.getPath().toUri().toString(), int(f.getLen())))
    if not out:
        raise FileNotFoundError(path)
    return sorted(out)


def lines_with_place(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(id, file, place, value)`` of the lines of uncompressed text files.

    ``file`` numbers the files by their URIs, ``place`` is the byte a line begins at, and ``id`` is made of both, so ids are
    distinct, ascend with the text and are the same however the files are split. More than ``MOST_FILES`` files, or files of
    2^50 bytes, are refused: join them first. Empty files have no lines; bytes that are no UTF-8 are replaced. Tasks
    open the files by ``pyarrow.fs`` (local, HDFS, S3, GCS).
    """
    files = _listed(spark, path)
    if len(files) > MOST_FILES or any(n >= 1 << OFFSET_BITS for _, n in files):
        raise ValueError(f"{len(files)} files: ids hold {MOST_FILES} of up to 2^{OFFSET_BITS} bytes")
    if any(p.endswith((".gz", ".bz2", ".zst", ".snappy", ".lz4")) for p, _ in files):
        raise ValueError("compressed files have no places to split at")
    spark.dataSource.register(LineSource)
    rows = (spark.read.format("lines_with_place").option("files", "\n".join(f"{p}\t{n}" for p, n in files))
            .option("rangeBytes", str(range_bytes)).load())
    return rows.select((F.shiftleft(F.col("file").cast("long"), OFFSET_BITS) + F.col("place")).alias("id"), "file", "place", "value")
