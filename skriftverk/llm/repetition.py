"""Problem 6: repetition inside a single document.

A suffix array over the words of each document, built by prefix doubling for many documents at once: suffixes that are
already unique inside their document are set aside, so prose costs a few passes and only repetitive text goes on.
Longest-common-prefix values of neighbours give the repeated runs; the spans of runs of ``k`` words or more, other than
their first occurrence, are united.

A text of fewer than ``k`` words, blank or null: no repetition, share 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .common import chunks, hashed, words


def suffix_order(doc: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by (document, words) and the ranks after 1, 2, 4, ... words.

    ``rank[h][i]`` is the place of the first suffix that has the same document and first ``2**h`` words as ``i``.
    """
    n = len(word)
    order = np.lexsort((word, doc))
    start = np.r_[True, (doc[order][1:] != doc[order][:-1]) | (word[order][1:] != word[order][:-1])]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    levels, step = [rank], 1
    while True:
        counts = np.bincount(rank, minlength=n)
        act = np.flatnonzero(counts[rank] > 1)
        if not len(act):
            break
        to = act + step
        ok = to < n
        nxt = np.full(len(act), -1, np.int64)
        t = to[ok]
        same = doc[t] == doc[act[ok]]
        nxt[np.flatnonzero(ok)[same]] = rank[t[same]]
        o = np.lexsort((nxt, rank[act]))
        r, x = rank[act][o], nxt[o]
        new_group = np.r_[True, r[1:] != r[:-1]]
        new_sub = np.r_[True, (r[1:] != r[:-1]) | (x[1:] != x[:-1])]
        at = np.arange(len(act))
        base = np.maximum.accumulate(np.where(new_group, at, 0))
        sub = np.maximum.accumulate(np.where(new_sub, at, 0))
        rank = rank.copy()
        rank[act[o]] = r + (sub - base)
        levels.append(rank)
        step *= 2
    return np.argsort(rank, kind="stable"), levels


def common_prefix(a: np.ndarray, b: np.ndarray, doc: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Number of words that suffixes ``a[i]`` and ``b[i]`` have in common (same documents)."""
    n, got = len(doc), np.zeros(len(a), np.int64)
    for h in range(len(levels) - 1, -1, -1):  # the last ranks are all different, so each level applies once at most
        i, j = a + got, b + got
        ok = (i < n) & (j < n)
        ok[ok] = (doc[i[ok]] == doc[a[ok]]) & (doc[j[ok]] == doc[b[ok]]) & (levels[h][i[ok]] == levels[h][j[ok]])
        got[ok] += 1 << h
    return got


def repeats(doc: np.ndarray, word: np.ndarray, docs: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: covered words, the longest repeated run, and the number of repeating positions."""
    covered, longest, count = (np.zeros(docs, np.int64) for _ in range(3))
    if len(word) < k:
        return covered, longest, count
    sa, levels = suffix_order(doc, word)
    a, b = sa[:-1], sa[1:]
    same = doc[a] == doc[b]
    lcp = np.zeros(len(a), np.int64)
    lcp[same] = common_prefix(a[same], b[same], doc, levels)
    np.maximum.at(longest, doc[a], lcp)
    # intervals of lcp >= k; in each, all but the earliest position repeat an earlier one
    group = np.r_[0, np.cumsum(lcp < k)]
    first = np.full(group[-1] + 1, len(word), np.int64)
    np.minimum.at(first, group, sa)
    again = sa[sa != first[group]]
    edge = np.zeros(len(word) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + k, -1)
    inside = np.cumsum(edge[:-1]) > 0
    np.add.at(covered, doc[inside], 1)
    np.add.at(count, doc[again], 1)
    return covered, longest, count


def repetition_stats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5) -> DataFrame:
    """One row per input row: words, repeated_words, share, longest_repeat (in words) and repeats. A narrow stage."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t", 2_000_000):
            parts = [words(t) for t in b.column(1).to_pylist()]
            lens = np.fromiter(map(len, parts), np.int64, len(parts))
            doc = np.repeat(np.arange(len(parts)), lens)
            covered, longest, count = repeats(doc, hashed([w for p in parts for w in p]), len(parts), k)
            share = covered / np.maximum(lens, 1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(lens), pa.array(covered), pa.array(share), pa.array(np.where(longest >= k, longest, 0)), pa.array(count)],
                names=[id_col, "words", "repeated_words", "share", "longest_repeat", "repeats"],
            )

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, words long, repeated_words long, share double, longest_repeat long, repeats long")


def repetitive(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, share: float = 0.30) -> DataFrame:
    return repetition_stats(df, id_col, text_col, k).filter((F.col("words") > 0) & (F.col("share") >= share)).select(id_col)
