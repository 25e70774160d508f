"""Files of a release: listed without being opened, and digested in one pass in the executors, whatever their size."""

from __future__ import annotations

import hashlib
import io
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.functions.columns import basename

#: Folders of indexes that are no part of a release (a fixed value), and names of files that are none.
SKIPPED, NO_PRODUCT = ("*genmap_index",), r"\.(fai|log)$"
#: Bytes that are read, and inflated, at a time.
CHUNK = 1 << 20


def opened(path: str) -> pa.NativeFile:
    """A stream over a file that Spark has named; local names may hold any character."""
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_stream(path.split(":", 1)[1] if parts.scheme else path, compression=None)
    system, name = fs.FileSystem.from_uri(f"{parts.scheme}://{parts.netloc}/")
    return system.open_input_stream(f"{name.rstrip('/')}/{unquote(parts.path).lstrip('/')}", compression=None)


class _Inflated:
    """Digest of what a stream of gzip members holds, of which no more than a chunk is in memory."""

    def __init__(self) -> None:
        self.hash, self.size, self.member, self.fine = hashlib.md5(usedforsecurity=False), 0, zlib.decompressobj(31), True

    def update(self, data: bytes) -> None:
        while data and self.fine:
            if self.member.eof:
                data = data.lstrip(b"\0")  # padding between members
                if not data:
                    return
                self.member = zlib.decompressobj(31)
            try:
                out = self.member.decompress(data, CHUNK)
            except zlib.error:
                self.fine = False
                return
            self.hash.update(out)
            self.size += len(out)
            data = self.member.unused_data if self.member.eof else self.member.unconsumed_tail

    def digest(self) -> str | None:
        # what a member holds back has no end of its own: ask until nothing more comes
        while self.fine and not self.member.eof:
            try:
                out = self.member.decompress(b"", CHUNK)
            except zlib.error:
                self.fine = False
                break
            if not out:
                self.fine = self.member.eof
                break
            self.hash.update(out)
            self.size += len(out)
        return self.hash.hexdigest() if self.fine else None


def digests(read: Callable[[int], bytes]) -> tuple[int, str, str, str | None]:
    """bytes, md5, sha256 and content_md5 of a stream, read once: the last is of what gzip members hold, if the stream is made of them, else md5.

    Null if it begins as gzip but cannot be inflated to its end.
    """
    whole, strong, size, inner = hashlib.md5(usedforsecurity=False), hashlib.sha256(), 0, None
    while data := read(CHUNK):
        while size == 0 and len(data) == 1 and (more := read(CHUNK)):  # a stream may give less than it is asked for
            data += more
        if size == 0 and data[:2] == b"\x1f\x8b":
            inner = _Inflated()
        whole.update(data)
        strong.update(data)
        size += len(data)
        if inner:
            inner.update(data)
    return size, whole.hexdigest(), strong.hexdigest(), inner.digest() if inner else whole.hexdigest()


_FOUND = "bytes long, md5 string, sha256 string, content_md5 string"


def _table(rows: DataFrame, column: str, stream: Callable) -> DataFrame:
    """Rows with bytes, md5, sha256 and content_md5 of what `stream` opens of a column; null for a null."""
    schema = [(f.name, f.dataType.simpleString()) for f in rows.schema]
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for x in batch.column(at):
                if x.as_py() is None:
                    found.append((None,) * 4)
                    continue
                with stream(x.as_py()) as f:
                    found.append(digests(f.read))
            new = [pa.array([r[k] for r in found], pa.string() if k else pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[n for n, _ in schema] + ["bytes", "md5", "sha256", "content_md5"])

    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in schema) + f", {_FOUND}")


def digested(rows: DataFrame, content: str = "content") -> DataFrame:
    """Rows with bytes, md5, sha256 and content_md5 of a binary column."""
    return _table(rows, content, io.BytesIO)


def _regex(pattern: str) -> str:
    """A shell pattern of stars and question marks as a regular expression."""
    return "".join({"*": ".*", "?": "."}.get(c, c if c.isalnum() or c == "_" else f"[{c}]" if c not in "^\\]" else "\\" + c) for c in pattern)


def listed(spark: SparkSession, path: str, skip: tuple[str, ...] = SKIPPED) -> DataFrame:
    """path, filename and length of all files under a folder, but for indexes, logs and what is below folders of these names.

    Spark reads names and lengths alone, as no content is asked for.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    folders = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
    if skip:
        names = "|".join(map(_regex, skip))
        rows = rows.where(~F.exists(folders, lambda x: x.rlike(f"^({names})$")))
    return rows.where(~F.col("path").rlike(NO_PRODUCT)).select("path", basename(F.col("path")).alias("filename"), "length")


def files(spark: SparkSession, path: str, skip: tuple[str, ...] = SKIPPED) -> DataFrame:
    """path, filename, bytes, md5, sha256, content_md5 of the files of a folder, and the content of metadata documents alone.

    A file is read once, in chunks, by one task; tasks take files by turns.
    """
    names = listed(spark, path, skip)
    found = _table(names.select("path", "filename").repartition("path"), "path", opened)
    documents = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.metadata.json").load(path).select("path", "content")
    return found.join(documents, "path", "left")

