"""Words, hashed words and 5-sequences, as Arrow batches.

A *word* is a maximal run of Unicode letters and numbers, lower-cased. A text's *sequences* are the hashes of its runs
of ``k`` consecutive words; word hashes do not depend on the process.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_WORD = re.compile(r"[^\W_]+")
_MEMO_LIMIT = 2_000_000
M64 = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    if not text:
        return []
    if "İ" in text:  # its lower case has a combining mark, which would split the word
        return [w.lower() for w in _WORD.findall(text)]
    return _WORD.findall(text.lower())


class _Memo(dict):
    """Word to signed 64-bit hash; emptied when large, which changes no value."""

    def __missing__(self, w: str) -> int:
        if len(self) >= _MEMO_LIMIT:
            self.clear()
        h = xxhash.xxh3_64_intdigest(w)
        h = self[w] = h - (1 << 64) if h >= 1 << 63 else h
        return h


_memo = _Memo()


def hashed(ws: list[str]) -> np.ndarray:
    return np.fromiter(map(_memo.__getitem__, ws), np.int64, len(ws))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h.astype(np.uint64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def sequences(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` values, as int64; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.int64)
    u = h.view(np.uint64)
    acc = u[:n].copy()
    for j in range(1, k):
        acc *= M64
        acc += u[j : j + n]
        acc ^= acc >> np.uint64(29)
    return mix(acc).view(np.int64)


def batch_sequences(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row number, sequence hash) of every run of ``k`` words inside each text, in order."""
    parts = [words(t) for t in texts]
    lens = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = hashed([w for p in parts for w in p])
    row = np.repeat(np.arange(len(parts)), lens)
    if len(flat) < k:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    g = sequences(flat, k)
    inside = row[: len(g)] == row[k - 1 :]
    return row[: len(g)][inside], g[inside]


def distinct_sets(row: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), sorted by both."""
    if not len(row):
        return row, g
    order = np.lexsort((g, row))
    row, g = row[order], g[order]
    keep = np.r_[True, (row[1:] != row[:-1]) | (g[1:] != g[:-1])]
    return row[keep], g[keep]


def chunks(it: Iterator[pa.RecordBatch], text: str, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about so many bytes of text, at least a row each."""
    for b in it:
        n, start = b.num_rows, 0
        if b.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + chars, "right")))
            yield b.slice(start, stop - start)
            start = stop


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values, kind))


ArrowMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
