"""Near-duplicates by MinHash and locality-sensitive bands: 5-word sequences, 14 bands of 8 hashes.

A sequence's base hash is the first 28 bits of its MD5 sum; the i-th hash is ``(a_i h + b_i) mod (2^31 - 1)``, so any
engine can repeat the signatures. Texts that share all hashes of a band are linked through the least id of the band's
bucket, never pair by pair; components of links form a cluster, and its least id survives.

Texts of fewer words than a sequence, blank and null ones have no signature and survive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .components import connected_components

PRIME = (1 << 31) - 1
_WORD = re.compile(r"[^\W_]+")


def coefficients(n: int) -> list[tuple[int, int]]:
    """Fixed multipliers and offsets by a linear congruential rule."""
    x, out = 20240607, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % PRIME
        a = x or 1
        x = (x * 1103515245 + 12345) % PRIME
        out.append((a, x))
    return out


def signatures(df: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, bands: int = 14, rows: int = 8) -> DataFrame:
    """(id, signature array<long>)."""
    ab = np.array(coefficients(bands * rows), np.int64)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            keep, sig = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                ws = _WORD.findall((t or "").lower())
                if len(ws) < k:
                    continue
                grams = {" ".join(ws[j : j + k]) for j in range(len(ws) - k + 1)}
                h = np.array([int(hashlib.md5(g.encode()).hexdigest()[:7], 16) for g in grams], np.int64)
                keep.append(i)
                best = np.full(len(ab), PRIME, np.int64)
                for s in range(0, len(h), 4096):
                    best = np.minimum(best, ((h[s : s + 4096, None] * ab[:, 0] + ab[:, 1]) % PRIME).min(axis=0))
                sig.append(best)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keep, pa.int64())), pa.array([s.tolist() for s in sig], pa.list_(pa.int64()))], names=[id_col, "signature"])

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text}` as t"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, signature array<long>")


def band_buckets(sig: DataFrame, id_col: str = "doc_id", bands: int = 14, rows: int = 8) -> DataFrame:
    """(id, band, bucket): the hash of each band of a signature."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.md5(F.array_join(F.slice("signature", i * rows + 1, rows).cast("array<string>"), ",")))
    return sig.select(id_col, F.posexplode(parts).alias("band", "bucket"))


def links(buckets: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(a, b): each text of a bucket with the least id in it."""
    low = buckets.groupBy("band", "bucket").agg(F.min(id_col).alias("a"), F.count("*").alias("n")).filter("n > 1")
    return buckets.join(low, ["band", "bucket"]).filter(F.col(id_col) != F.col("a")).select("a", F.col(id_col).alias("b")).distinct()


def clusters(df: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, bands: int = 14, rows: int = 8) -> DataFrame:
    """(id, cluster) of the texts with a link."""
    found = links(band_buckets(signatures(df, id_col, text, k, bands, rows), id_col, bands, rows), id_col)
    return connected_components(found).select(F.col("id").alias(id_col), F.col("component").alias("cluster"))


def removed_ids(df: DataFrame, id_col: str = "doc_id", text: str = "text", **config: int) -> DataFrame:
    return clusters(df, id_col, text, **config).filter(f"`{id_col}` <> cluster").select(id_col)


def near_dedup(df: DataFrame, id_col: str = "doc_id", text: str = "text", **config: int) -> tuple[DataFrame, DataFrame]:
    """(kept, removed) by anti and semi join with the ids to remove."""
    gone = removed_ids(df, id_col, text, **config)
    return df.join(gone, id_col, "left_anti"), df.join(gone, id_col, "left_semi")
