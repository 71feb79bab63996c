"""Problem 8: the corpus as token ids of a public byte-level tokenizer.

Forced-boundary splitting. The tokenizer cuts a text into pieces by its pattern and merges bytes only inside a piece. A
pair of neighbouring bytes that occurs inside no vocabulary token can never be merged across, so each such pair marks a
certain cut: the fragments between cuts are encoded on their own, kept in a memo shared by all documents of a worker,
and concatenated. Cuts are placed inside pieces only, as the pattern looks across pieces.

Null, empty: an empty list. Blank texts are encoded as any text. Special tokens' strings count as ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ..session import spread
from .common import chunks, lists

#: Fixed value: the public pattern of byte-level BPE with 50,257 ids.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
DEFAULT_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


class Encoder:
    """Encodes texts by ranks read from ``path`` (lines of base64 token and rank)."""

    def __init__(self, path: str, memo_limit: int = 500_000):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
        inside = np.zeros((256, 256), bool)
        for t in self.ranks:
            if len(t) > 1:
                a = np.frombuffer(t, np.uint8)
                inside[a[:-1], a[1:]] = True
        self.inside = inside
        self.pieces = regex.compile(PATTERN).findall
        self.memo: dict[str, tuple[int, ...]] = {}
        self.memo_limit = memo_limit

    def fragments(self, piece: bytes) -> list[bytes]:
        if len(piece) < 2:
            return [piece]
        a = np.frombuffer(piece, np.uint8)
        cuts = np.flatnonzero(~self.inside[a[:-1], a[1:]]) + 1
        if not len(cuts):
            return [piece]
        at = [0, *cuts.tolist(), len(piece)]
        return [piece[i:j] for i, j in zip(at, at[1:])]

    def merge(self, frag: bytes) -> list[int]:
        """Merge the lowest-ranked neighbours first, leftmost on ties; a heap over a linked list, so long runs cost n log n."""
        whole = self.ranks.get(frag)
        if whole is not None:
            return [whole]
        n, get = len(frag), self.ranks.get
        part: list[bytes | None] = [frag[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, 2) for i in range(n - 1) if (r := get(frag[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = after[i] if part[i] is not None else n
            if j >= n or len(part[i]) + len(part[j]) != size:
                continue  # one of the two has changed since
            part[i] += part[j]
            part[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := get(part[i] + part[k])) is not None:
                    heapq.heappush(heap, (r, i, len(part[i]) + len(part[k])))
            if (h := before[i]) >= 0 and (r := get(part[h] + part[i])) is not None:
                heapq.heappush(heap, (r, h, len(part[h]) + len(part[i])))
        return [self.ranks[p] for p in part if p is not None]

    def piece(self, p: str) -> tuple[int, ...]:
        ids = tuple(t for f in self.fragments(p.encode()) for t in self.merge(f))
        if len(self.memo) >= self.memo_limit:
            self.memo.clear()
        if len(p) <= 64:
            self.memo[p] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        memo, extend = self.memo, out.extend
        for p in self.pieces(text):
            ids = memo.get(p)
            extend(self.piece(p) if ids is None else ids)
        return out

    def decode(self, ids: list[int]) -> str:
        back = getattr(self, "_back", None)
        if back is None:
            back = self._back = {v: k for k, v in self.ranks.items()}
        return b"".join(back[i] for i in ids).decode()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """One row per input row: ``id_col`` and ``ids array<int>``. A narrow stage; the vocabulary is read on each worker."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in chunks(it, "t"):
            coded = [enc.encode(t) for t in b.column(1).to_pylist()]
            flat = np.fromiter((i for c in coded for i in c), np.int32)
            ids = lists(flat, np.fromiter(map(len, coded), np.int64, len(coded)), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), ids], names=[id_col, "ids"])

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, ids array<int>")
