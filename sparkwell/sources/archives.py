"""Zip and gzip files: delivered as files below ``name=`` folders, read as binary files, and unpacked in parts.

One archive is one feed slice, so its compressed bytes fit a cell; what it unpacks to is never held whole.
"""

from __future__ import annotations

import csv
import gzip
import io
import itertools
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that are unpacked at a time, and rows of a CSV member that are handed on at a time.
PART_BYTES, PART_ROWS = 1 << 16, 10_000


def read_binary(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """(path, content, length) of every matching file; files of no bytes are not listed."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return files.select("path", "content", "length")


def publish(files: DataFrame, folder: str) -> None:
    """Write (path, content) as one file each, below a ``name=`` folder with its path.

    The writer of text ends each file in one zero byte, which both formats allow as padding.
    """
    raw = files.select(F.col("path").alias("name"), F.col("content").cast("string").alias("value"))
    raw.write.partitionBy("name").option("lineSep", "\0").text(folder)


def delivered(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content, length) of the files below ``name=`` folders; the path is the name of the folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.url_decode(F.regexp_extract("path", r"/name=([^/]*)/", 1))
    return files.select(name.alias("path"), "content", "length")


def zip_text(df: DataFrame, name: str = "path", text: str = "text") -> DataFrame:
    """(path, content): each text becomes a zip with one member."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for member, body in zip(pdf[name], pdf[text]):
                buffer = io.BytesIO()
                with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                    z.writestr(zipfile.ZipInfo(member.removesuffix(".zip")), body)
                out.append(buffer.getvalue())
            yield pd.DataFrame({"path": pdf[name], "content": out})

    return df.select(name, text).mapInPandas(pack, "path STRING, content BINARY")


def unzip_csv(files: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of the single CSV member of each zip as text columns; (path, columns...)."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as member:
                    rows = csv.DictReader(io.TextIOWrapper(member, "utf-8", newline=""))
                    while part := list(itertools.islice(rows, PART_ROWS)):
                        frame = pd.DataFrame(part, columns=columns, dtype="object")
                        frame.insert(0, "path", path)
                        yield frame

    schema = ", ".join(["path STRING", *[f"`{c}` STRING" for c in columns]])
    return files.select("path", "content").mapInPandas(unpack, schema)


def verify_checksums(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, ok): SHA-1 and length of the content against the manifest (path, sha1, length)."""
    facts = files.select(
        "path", F.sha1("content").alias("got_sha1"), F.octet_length("content").cast("bigint").alias("got_length")
    )
    same = F.col("got_sha1").eqNullSafe(F.col("sha1")) & F.col("got_length").eqNullSafe(F.col("length"))
    return manifest.join(facts, "path", "left").select("path", F.coalesce(same, F.lit(False)).alias("ok"))


def gzip_text(df: DataFrame, name: str = "path", text: str = "text") -> DataFrame:
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            packed = [gzip.compress(body.encode(), mtime=0) for body in pdf[text]]
            yield pd.DataFrame({"path": pdf[name], "content": packed})

    return df.select(name, text).mapInPandas(pack, "path STRING, content BINARY")


def inflated(content: bytes) -> Iterator[bytes | bool]:
    """What all members of a gzip file hold, in parts of at most PART_BYTES and up to the first damage; then whether it ends properly."""
    at, size = 0, len(content)
    while True:
        stream, step = zlib.decompressobj(wbits=31), PART_BYTES
        while at < size and not stream.eof:
            piece, before = content[at : at + step], stream.copy()
            try:
                out = stream.decompress(piece, PART_BYTES)
            except zlib.error:
                if step == 1:
                    yield False
                    return
                stream, step = before, 1  # byte by byte, to keep what stands before the damage
                continue
            at += len(piece) - len(stream.unconsumed_tail) - len(stream.unused_data)
            if out:
                yield out
        while not stream.eof and (out := stream.decompress(b"", PART_BYTES)):
            yield out
        while at < size and content[at] == 0:  # zero bytes may pad the end
            at += 1
        if not stream.eof or at == size:
            yield stream.eof
            return


def whole_lines(content: bytes) -> Iterator[list[bytes] | bool]:
    """The whole lines of a gzip file before any cut, in parts; then whether it ends properly, in which case the last line needs no end."""
    begun: list[bytes] = []
    for part in inflated(content):
        if isinstance(part, bool):
            last = b"".join(begun)
            if part and last:
                yield [last]
            yield part
            return
        head, *more = part.split(b"\n")
        begun.append(head)
        if more:
            yield [b"".join(begun), *more[:-1]]
            begun = [more[-1]]


LINE_SCHEMA = "path STRING, line_no BIGINT, line STRING, complete BOOLEAN"


def gunzip_lines(files: DataFrame) -> DataFrame:
    """(path, line_no, line, complete): a row for each whole line of each gzip file (path, content), and one for the file.

    The row of a file has the number of its lines, no line, and whether the stream ends properly; rows of lines have null there.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                path, n = batch.column(0)[row].as_py(), 0
                for part in whole_lines(batch.column(1)[row].as_py()):
                    file = isinstance(part, bool)
                    lines = [None] if file else [line.decode("utf-8", "replace") for line in part]
                    numbers = [n] if file else range(n + 1, n + 1 + len(lines))
                    n += 0 if file else len(lines)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(lines), pa.string()), pa.array(numbers, pa.int64()), pa.array(lines, pa.string())]
                        + [pa.array([part if file else None] * len(lines), pa.bool_())],
                        names=["path", "line_no", "line", "complete"],
                    )

    return files.select("path", "content").mapInArrow(unpack, LINE_SCHEMA)
