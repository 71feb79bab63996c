"""WARC files as rows: each file is read as a stream in one task, record by record, gzip members included.

A shard is never held as a whole: tasks get paths, and open them through Arrow's file systems (local, HDFS, S3, GCS). A
damaged record gives a row with ``error`` and the reader goes on at the next member or header; a file that ends inside a
record gives such a row too, so what is lost is counted.
"""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "file string, record_no long, id string, url string, warc_date string, content_type string, html string, error string"
COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]
_CHARSET = re.compile(rb"charset=[\"']?([\w-]+)", re.I)
_TYPE = re.compile(rb"^content-type:\s*([^\r\n;]+)", re.I | re.M)
_MEMBER = b"\x1f\x8b\x08"
_PIECE = 1 << 16


class Damaged(Exception):
    """The stream goes on after a part that cannot be read."""


class Source:
    """Lines and bytes of a stream, unpacked if it is gzipped. A broken member raises ``Damaged`` once; reading then goes on with the next."""

    def __init__(self, raw: BinaryIO):
        self.raw, self.packed, self.ready = raw, b"", bytearray()
        self.packed = raw.read(_PIECE)
        self.gzipped = self.packed[:2] == _MEMBER[:2]
        self.member = zlib.decompressobj(31) if self.gzipped else None
        self.started = False
        self.damage: str | None = None

    def _more(self) -> bool:
        """Unpack some bytes; False at the end."""
        if self.damage:
            why, self.damage = self.damage, None
            raise Damaged(why)
        if not self.packed:
            self.packed = self.raw.read(_PIECE)
        if not self.packed:
            if self.started:
                self.started = False
                raise Damaged("file ends inside a member")
            return False
        if not self.gzipped:
            self.ready += self.packed
            self.packed = b""
            return True
        try:
            self.ready += self.member.decompress(self.packed)
            self.started = not self.member.eof
            self.packed = self.member.unused_data
            if self.member.eof:
                self.member = zlib.decompressobj(31)
        except zlib.error as e:
            self._skip()
            raise Damaged(f"broken member: {e}") from e
        return True

    def _skip(self) -> None:
        """To the next member."""
        self.member, self.started = zlib.decompressobj(31), False
        self.ready.clear()
        at = self.packed.find(_MEMBER, 1)
        while at < 0:
            piece = self.raw.read(_PIECE)
            if not piece:
                self.packed = b""
                return
            self.packed = self.packed[-2:] + piece
            at = self.packed.find(_MEMBER)
        self.packed = self.packed[at:]

    def read(self, n: int) -> bytes:
        while len(self.ready) < n and self._more():
            pass
        out = bytes(self.ready[:n])
        del self.ready[:n]
        return out

    def line(self) -> bytes:
        at = self.ready.find(b"\n")
        while at < 0:
            have = len(self.ready)
            if not self._more():
                at = len(self.ready) - 1
                break
            at = self.ready.find(b"\n", have)
        out = bytes(self.ready[: at + 1])
        del self.ready[: at + 1]
        return out


def _decode(body: bytes, head: bytes) -> str:
    m = _CHARSET.search(head) or _CHARSET.search(body[:2048])
    for enc in ([m.group(1).decode()] if m else []) + ["utf-8", "cp1252"]:
        try:
            return body.decode(enc)
        except (LookupError, UnicodeDecodeError):
            continue
    return body.decode("utf-8", "replace")


def _unchunked(body: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            n = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return b"".join(out) or body
        if not n:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + n])
        at = end + 4 + n


def _content(body: bytes) -> tuple[str, str | None, str | None]:
    """(content type, text, error) of an HTTP response."""
    http, _, content = body.partition(b"\r\n\r\n")
    low = http.lower()
    m = _TYPE.search(http)
    kind = m.group(1).decode("ascii", "replace").strip() if m else ""
    if b"transfer-encoding: chunked" in low:
        content = _unchunked(content)
    if b"content-encoding: gzip" in low:
        try:
            content = gzip.decompress(content)
        except (OSError, EOFError, zlib.error) as e:
            return kind, None, f"broken body: {type(e).__name__}"
    return kind, _decode(content, http), None


def records(raw: BinaryIO) -> Iterator[tuple[str, str, str, str, str | None, str | None]]:
    """(id, url, date, content type, text, error) of each HTTP response and of each damaged place."""
    f = Source(raw)
    head: dict[str, str] = {}
    while True:
        try:
            head = {}
            line = f.line()
            if not line:
                return
            if not line.startswith(b"WARC/"):
                continue
            while (line := f.line()) not in (b"\r\n", b"\n", b""):
                k, _, v = line.decode("utf-8", "replace").partition(":")
                head[k.strip().lower()] = v.strip()
            size = head.get("content-length", "0")
            want = int(size) if size.isdigit() else 0
            body = f.read(want)
        except Damaged as e:
            yield head.get("warc-record-id", "").strip("<>"), head.get("warc-target-uri", "").strip("<>"), head.get("warc-date", ""), "", None, str(e)
            continue
        if head.get("warc-type") != "response":
            continue
        kind, text, error = _content(body) if len(body) == want else ("", None, "file ends inside a record")
        yield head.get("warc-record-id", "").strip("<>"), head.get("warc-target-uri", "").strip("<>"), head.get("warc-date", ""), kind, text, error


def list_files(spark: SparkSession, path: str, glob: str = "*.warc*") -> DataFrame:
    """(path) of the shards below a folder; their content is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path")


def _opened(path: str) -> BinaryIO:
    from pyarrow import fs

    files, inner = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return files.open_input_stream(inner, compression=None)


def read_warc(spark: SparkSession, path: str | DataFrame, glob: str = "*.warc*") -> DataFrame:
    """The records of the shards below ``path``, or of a table of paths (``list_files`` less those that are finished)."""
    paths = path if isinstance(path, DataFrame) else list_files(spark, path, glob)

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            for name in pdf["path"]:
                part, held = [], 0
                with _opened(name) as raw:
                    for n, r in enumerate(records(raw)):
                        part.append((name, n, *r))
                        held += len(r[4] or "")
                        if len(part) == 500 or held > 16_000_000:
                            yield pd.DataFrame(part, columns=COLUMNS)
                            part, held = [], 0
                yield pd.DataFrame(part, columns=COLUMNS)

    tasks = spark.sparkContext.defaultParallelism
    return paths.select("path").repartition(tasks * 4, "path").mapInPandas(run, SCHEMA)
