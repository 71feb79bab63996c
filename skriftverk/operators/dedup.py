"""Exact deduplication: keep the first of equal texts; against a table of seen keys; with an optional sketch.

The first of a group is found by a partial aggregate, not a window, so a text that a third of all rows share costs a
row per task.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..session import read_text, write_text
from .filters import text_of


def content_key(text: Column) -> Column:
    """SHA-256 of the stripped text, as hex; null counts as empty."""
    return F.sha2(strip(text_of(text)), 256)


def first_ids(df: DataFrame, key: Column, order: list[str], id_col: str) -> DataFrame:
    """(_first, copies): the id of the first row of each key; ``order`` and the id settle which one that is.

    Only the key, ``order`` and the id are shuffled, after a partial aggregate, so a hot key costs a row a task."""
    keyed = df.select(key.alias("_key"), *dict.fromkeys([*order, id_col]))
    return keyed.groupBy("_key").agg(F.min(F.struct(*order, id_col)).alias("_m"), F.count("*").alias("copies")).select(F.col(f"_m.`{id_col}`").alias("_first"), "copies")


def exact_dedup(df: DataFrame, text: str = "text", order: list[str] | None = None, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(kept, removed): semi and anti joins with the first rows' ids, which spread however many rows share a text. Ids are taken to be
    unique and not null; the rows of a null id are removed."""
    firsts = first_ids(df, content_key(F.col(text)), order or [], id_col)
    same = F.col(id_col) == F.col("_first")
    return df.join(firsts, same, "left_semi"), df.join(firsts, same, "left_anti")


def unseen(df: DataFrame, seen: DataFrame, text: str = "text", order: list[str] | None = None, id_col: str = "doc_id") -> DataFrame:
    """Rows whose text is not among ``seen`` (column ``key``) and that are the first of their text."""
    keys = df.select(content_key(F.col(text)).alias("_k"), *dict.fromkeys([*(order or []), id_col])).join(seen.select(F.col("key").alias("_k")).distinct(), "_k", "left_anti")
    return df.join(first_ids(keys, F.col("_k"), order or [], id_col), F.col(id_col) == F.col("_first"), "left_semi")


class BloomSketch:
    """An approximate set of keys. False positives at about ``rate`` once ``capacity`` keys are in, and more beyond that; ``missing`` with
    the keys themselves is exact, whatever the sketch holds."""

    BLOCK = 1 << 16

    def __init__(self, capacity: int = 15_000_000, rate: float = 0.001):
        self.capacity, self.rate = capacity, rate
        self.bits = max(64, math.ceil(-capacity * math.log(rate) / math.log(2) ** 2))
        self.hashes = max(1, round(self.bits / capacity * math.log(2)))
        self.data = np.zeros(-(-self.bits // 8), np.uint8)

    def places(self, key: str) -> np.ndarray:
        d = hashlib.sha256(key.encode()).digest()
        a, b = int.from_bytes(d[:8], "big"), int.from_bytes(d[8:16], "big") | 1
        return np.array([(a + i * b) % self.bits for i in range(self.hashes)])

    def add(self, key: str) -> None:
        p = self.places(key)
        np.bitwise_or.at(self.data, p >> 3, (1 << (p & 7)).astype(np.uint8))

    def __contains__(self, key: str) -> bool:
        p = self.places(key)
        return bool(np.all(self.data[p >> 3] & (1 << (p & 7))))

    def save(self, spark: SparkSession, path: str) -> None:
        """Write the sketch to a file of any file system that the session knows, replaced as a whole."""
        state = {"capacity": self.capacity, "rate": self.rate, "data": base64.b64encode(zlib.compress(self.data.tobytes(), 1)).decode()}
        write_text(spark, path, json.dumps(state))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BloomSketch | None:
        """The saved sketch, or None where there is none."""
        text = read_text(spark, path)
        if text is None:
            return None
        state = json.loads(text)
        out = cls(state["capacity"], state["rate"])
        out.data = np.frombuffer(zlib.decompress(base64.b64decode(state["data"])), np.uint8).copy()
        return out

    def add_all(self, keys: DataFrame) -> BloomSketch:
        """Add a column of keys: each task sends the blocks of bytes that it sets, which are united before they reach the driver."""
        places, size, block = self.places, len(self.data), self.BLOCK

        def sent(bits: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, size, block):
                if bits[at : at + block].any():
                    yield pa.RecordBatch.from_arrays([pa.array([at // block]), pa.array([bits[at : at + block].tobytes()], pa.binary())], names=["block", "data"])

        def mark(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(size, np.uint8)
            for b in it:
                for k in b.column(0).to_pylist():
                    if k is not None:
                        p = places(k)
                        np.bitwise_or.at(bits, p >> 3, (1 << (p & 7)).astype(np.uint8))
            yield from sent(bits)

        def unite(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(size, np.uint8)
            for b in it:
                for i, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    part = np.frombuffer(data, np.uint8)
                    bits[i * block : i * block + len(part)] |= part
            yield from sent(bits)

        united = keys.mapInArrow(mark, "block long, data binary").repartition("block").mapInArrow(unite, "block long, data binary")
        for i, data in united.toLocalIterator():  # the sketch's own bytes
            part = np.frombuffer(bytes(data), np.uint8)
            self.data[i * self.BLOCK : i * self.BLOCK + len(part)] |= part
        return self

    def missing(self, df: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
        """Rows whose key is surely not in the sketch. Those that are taken for members wrongly are left out, unless ``keys`` (a column of
        all keys in it) is given: then the supposed members, and only they, are looked up there."""
        sketch = df.sparkSession.sparkContext.broadcast(self)  # capacity bounds its size: 27 MB by default
        names, at = df.columns, df.columns.index(key)

        def rows(member: bool) -> DataFrame:
            def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for b in it:
                    keep = [(k is not None and k in sketch.value) == member for k in b.column(at).to_pylist()]
                    yield b.filter(pa.array(keep, pa.bool_())).select(names)

            return df.mapInArrow(run, df.schema)

        if keys is None:
            return rows(False)
        known = keys.toDF("_key")
        return rows(False).unionByName(rows(True).join(known, F.col(key) == F.col("_key"), "left_anti"))
