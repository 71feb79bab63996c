"""Problem 9: evaluation passages inside the corpus, by latent semantic retrieval.

1. Corpus passages (overlapping windows of ``window`` words) are weighted by TF-IDF over the words of the evaluation
   items; document frequencies are counted over all documents.
2. A randomised SVD, in one distributed pass over all passages, gives each word a place in a space of ``rank``
   dimensions: each task adds its passages' share of ``A'(A W)`` for a fixed random ``W``; the sums are joined on the
   driver, where their size is (words of the items) x (rank + oversampling), whatever the corpus.
3. A window's place is the sum of its words' places. The item windows lie in buckets by the signs of ``bits`` fixed
   projections of their places, in ``tables`` tables; a corpus window is compared with those of its own buckets, and pairs
   whose cosine is ``cosine`` or more are candidates. Equal windows always share their buckets.
4. Candidates are checked word by word, on their whole diagonals: the longest common run, the longest common subsequence with the item
   (for paraphrases) and the item's answer options in the document.

A run of ``run`` words holds a whole window at one of the places that are searched (every ``run - window + 1`` words, and
each place for items shorter than ``run``), and equal windows have cosine 1, so no leak is lost in step 3; rows come from these
candidates alone, but which pairs pass is settled by the words.

The items are an evaluation set of bounded size: more than ``max_words`` words in all raise an error. Items of fewer than
``shortest`` words, null and blank texts are ignored. Repeated items are each reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .common import chunks, words


class Items:
    """The evaluation items as arrays of word numbers, with all their windows."""

    def __init__(self, rows: list[tuple[int, str | None]], window: int, run: int, shortest: int):
        self.window, self.run = window, run
        self.vocab: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray, int]] = []
        for i, text in rows:
            ws = words(text)
            if i is not None and len(ws) >= shortest:
                ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in ws])
                self.items.append((i, ids, min(run, len(ws))))
        owner, at, wins = [], [], []
        for j, (_, ids, _) in enumerate(self.items):
            v = np.lib.stride_tricks.sliding_window_view(ids, window)
            wins.append(v)
            owner += [j] * len(v)
            at += range(len(v))
        self.windows = np.concatenate(wins) if wins else np.empty((0, window), int)
        self.owner, self.at = np.array(owner, int), np.array(at, int)
        self.short = np.zeros(len(self.vocab), bool)
        for _, ids, need in self.items:
            if need < run:
                self.short[ids] = True

    def ids(self, ws: list[str]) -> np.ndarray:
        get = self.vocab.get
        return np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))

    def places(self, ids: np.ndarray, known: int) -> np.ndarray:
        """Where windows of a document are looked at: every stride, and each place made of short items' words."""
        n = len(ids) - self.window + 1
        if n <= 0:
            return np.empty(0, np.int64)
        c = np.r_[0, np.cumsum(ids >= 0)]
        ok = (c[self.window :] - c[:-self.window] >= known) & (np.arange(n) % (self.run - self.window + 1) == 0)
        if self.short.any():
            s = np.r_[0, np.cumsum((ids >= 0) & self.short[ids])]
            ok |= s[self.window :] - s[:-self.window] == self.window
        return np.flatnonzero(ok)


def document_frequencies(docs: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(items.vocab) + 1, np.int64), 0
        for b in chunks(it, "t"):
            for t in b.column(1).to_pylist():
                ids = np.unique(items.ids(words(t)))
                df[ids[ids >= 0]] += 1
                n += 1
        df[-1] = n
        has = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(df[has])], names=["w", "c"])

    out = np.zeros(len(items.vocab) + 1, np.int64)
    for w, c in docs.mapInArrow(run, "w long, c long").groupBy("w").agg(F.sum("c")).collect():  # at most a row per word of the items
        out[w] = c
    return out[:-1], int(out[-1])


def latent_words(docs: DataFrame, items: Items, idf: np.ndarray, rank: int, oversampling: int = 16, seed: int = 7) -> np.ndarray:
    """(words, rank): idf-weighted places of the items' words."""
    m, p = len(items.vocab), min(rank + oversampling, len(items.vocab))
    omega = np.random.default_rng(seed).standard_normal((m, p)).astype(np.float32)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((m, p), np.float32)
        weighted = omega * idf[:, None].astype(np.float32)
        for b in chunks(it, "t"):
            wins = []
            for t in b.column(1).to_pylist():
                ids = items.ids(words(t))
                if len(ids) >= items.window:
                    wins.append(np.lib.stride_tricks.sliding_window_view(ids, items.window)[:: items.run - items.window + 1])
            if not wins:
                continue
            w = np.concatenate(wins)
            w = w[(w >= 0).any(axis=1)]
            for s in range(0, len(w), 20_000):
                x = w[s : s + 20_000]
                have = x >= 0
                weight = np.where(have, idf[x], 0).astype(np.float32)
                norm = np.sqrt((weight**2).sum(axis=1, keepdims=True)) + 1e-9
                y = np.einsum("nlp,nl->np", weighted[np.where(have, x, 0)], have / norm, optimize=True)
                flat, row = x[have], np.repeat(np.arange(len(x)), have.sum(axis=1))
                o = np.argsort(flat, kind="stable")
                u, start = np.unique(flat[o], return_index=True)
                acc[u] += np.add.reduceat(y[row[o]] * (weight / norm)[have][o, None], start, axis=0)
        has = np.flatnonzero(np.abs(acc).sum(axis=1))
        for s in range(0, len(has), 4096):
            h = has[s : s + 4096]
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(acc[h].tolist(), pa.list_(pa.float64()))], names=["w", "y"])

    part = docs.mapInArrow(run, "w long, y array<double>").select("w", array_to_vector("y").alias("y"))
    y = np.zeros((m, p))
    for w, v in part.groupBy("w").agg(vector_to_array(Summarizer.sum(F.col("y"))).alias("y")).collect():  # words of the items x p
        y[w] = v
    q, _ = np.linalg.qr(y)
    small = (q.T @ y) @ np.linalg.pinv(q.T @ omega)  # q'(A'A)q, from the one pass
    value, vector = np.linalg.eigh((small + small.T) / 2)
    basis = q @ vector[:, np.argsort(-value)[:rank]]
    return (basis * idf[:, None]).astype(np.float32)


def lcs_length(a: np.ndarray, b: np.ndarray) -> int:
    """Longest common subsequence, a row at a time."""
    best = np.zeros(len(b) + 1, np.int64)
    for x in a:
        here = np.r_[0, np.where(b == x, best[:-1] + 1, best[1:])]
        best = np.maximum.accumulate(here)
    return int(best[-1])


def lcs_lengths(a: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The same of ``a`` with each row."""
    best = np.zeros((len(rows), rows.shape[1] + 1), np.int16)
    for x in a:
        best[:, 1:] = np.where(rows == x, best[:, :-1] + 1, best[:, 1:])
        np.maximum.accumulate(best, axis=1, out=best)
    return best[:, -1]


def leaks(docs: DataFrame, items_df: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
          run: int = 12, shortest: int = 8, window: int = 8, rank: int = 48, cosine: float = 0.95, known: int | None = None, paraphrases: bool = False, bits: int = 14, tables: int = 1, max_words: int = 2_000_000) -> DataFrame:
    """(id, item, run, lcs, exact) for each document and item with a candidate window that passes a check.

    ``exact``: the document holds ``run`` consecutive words of the item (all of a shorter item). With ``paraphrases``, also
    pairs whose longest common subsequence, around some matching window, is 0.6 of the item's words or more; ``lcs`` is the best over
    all matching windows. ``known`` is the number of the items' words that a window needs to be looked at (all of them by default;
    fewer find looser paraphrases, as do a lower ``cosine``, fewer ``bits`` and more ``tables``). ``answers`` is how many of the item's
    last twelve words stand anywhere in the document; the items have no answer options apart from their text.
    """
    rows = items_df.select(item_col, item_text).limit(max_words + 1).collect()  # bounded by the check that follows
    if len(rows) > max_words or sum(len(words(t)) for _, t in rows) > max_words:
        raise ValueError(f"the evaluation items have more than max_words = {max_words} words")
    items = Items(rows, window, run, shortest)
    kinds = dict(docs.dtypes)
    schema = f"`{id_col}` {kinds[id_col]}, `{item_col}` {dict(items_df.dtypes)[item_col]}, run int, lcs double, answers int, exact boolean"
    if not items.items:
        return docs.sparkSession.createDataFrame([], schema)
    src = spread(docs.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t"))
    df, n = document_frequencies(src, items)
    idf = np.log((n + 1) / (df + 1)) + 0.5
    place = latent_words(src, items, idf, rank)
    known = window if known is None else known
    item_kind = pa.int64() if dict(items_df.dtypes)[item_col] == "bigint" else None

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.vstack([place, np.zeros((1, place.shape[1]), np.float32)])  # the last row: a word of no item

        def embed(w: np.ndarray) -> np.ndarray:
            e = np.zeros((len(w), place.shape[1]), np.float32)
            for j in range(w.shape[1]):
                e += table[w[:, j]]
            return e / (np.sqrt((e**2).sum(axis=1, keepdims=True)) + 1e-9)

        # projections are summed word by word as well, so that equal windows get equal signs to the last bit
        planes = np.random.default_rng(11).standard_normal((place.shape[1], bits * tables)).astype(np.float32)
        sides = np.vstack([place @ planes, np.zeros((1, bits * tables), np.float32)])
        powers = 1 << np.arange(bits)

        def buckets(w: np.ndarray) -> list[np.ndarray]:
            x = np.zeros((len(w), bits * tables), np.float32)
            for j in range(w.shape[1]):
                x += sides[w[:, j]]
            return [(x[:, k * bits : (k + 1) * bits] > 0) @ powers for k in range(tables)]

        ours = embed(items.windows)
        order, starts = [], []
        for h in buckets(items.windows):
            o = np.argsort(h, kind="stable")
            order.append(o)
            starts.append(np.searchsorted(h[o], np.arange((1 << bits) + 1)))

        def near(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """(window, item window) pairs of the same bucket with enough cosine."""
            e, out = embed(w), []
            for k, h in enumerate(buckets(w)):
                lo, n = starts[k][h], starts[k][h + 1] - starts[k][h]
                for s in range(0, len(w), 4096):
                    c = n[s : s + 4096]
                    r = s + np.repeat(np.arange(len(c)), c)
                    q = order[k][np.repeat(lo[s : s + 4096] - np.r_[0, np.cumsum(c)[:-1]], c) + np.arange(len(r))]
                    for u in range(0, len(r), 200_000):
                        rr, qq = r[u : u + 200_000], q[u : u + 200_000]
                        ok = np.einsum("ij,ij->i", e[rr], ours[qq]) >= cosine
                        out.append(np.stack([rr[ok], qq[ok]]))
            both = np.unique(np.concatenate(out, axis=1), axis=1) if out else np.empty((2, 0), np.int64)
            return both[0], both[1]

        for b in chunks(it, "t", 1_000_000):
            docs_ids, wins, doc_of, at = [], [], [], []
            for d, t in enumerate(b.column(1).to_pylist()):
                ids = items.ids(words(t))
                docs_ids.append(ids)
                p = items.places(ids, known)
                if len(p):
                    wins.append(np.lib.stride_tricks.sliding_window_view(ids, window)[p])
                    doc_of.append(np.full(len(p), d))
                    at.append(p)
            out: dict[tuple[int, int], list] = {}
            if wins:
                w, doc_of, at = np.concatenate(wins), np.concatenate(doc_of), np.concatenate(at)
                uniq, back = np.unique(w, axis=0, return_inverse=True)
                back = back.reshape(-1)
                r, c = near(uniq)
                occurs = np.argsort(back, kind="stable")
                many = np.bincount(back, minlength=len(uniq))
                first = np.cumsum(many) - many
                reps = many[r]
                z = occurs[np.repeat(first[r] - np.r_[0, np.cumsum(reps)[:-1]], reps) + np.arange(int(reps.sum()))] if len(r) else np.empty(0, np.int64)
                c = np.repeat(c, reps)
                d_, j_, p_, q_ = doc_of[z], items.owner[c], at[z], items.at[c]
                _, one = np.unique(np.stack([j_, d_, p_ - q_]), axis=1, return_index=True)  # each diagonal of a pair that has a candidate
                same = np.flatnonzero((w[z] == items.windows[c]).all(axis=1))  # a run holds a candidate window that is equal word by word
                _, run_at = np.unique(np.stack([j_[same], d_[same], p_[same] - q_[same]]), axis=1, return_index=True)
                for d, j, p, q in np.stack([d_, j_, p_, q_])[:, same[run_at]].T.tolist():
                    run_check(out, docs_ids[d], d, j, p, q)
                if paraphrases and len(z):
                    for part in np.split(one, np.flatnonzero(np.diff(j_[one])) + 1):
                        for s in range(0, len(part), 2048):
                            x = part[s : s + 2048]
                            lcs_check(out, docs_ids, d_[x], int(j_[part[0]]), p_[x] - q_[x])
            keys = sorted(out)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array([k[0] for k in keys], pa.int64())), pa.array([items.items[k[1]][0] for k in keys], item_kind)]
                + [pa.array([out[k][i] for k in keys], kind) for i, kind in enumerate((pa.int32(), pa.float64(), pa.int32(), pa.bool_()))],
                names=[id_col, item_col, "run", "lcs", "answers", "exact"],
            )

    def run_check(out: dict, doc: np.ndarray, d: int, j: int, p: int, q: int) -> None:
        """The longest common run on the diagonal of an equal candidate."""
        _, item, need = items.items[j]
        lo, hi = min(p, q), min(len(doc) - p, len(item) - q)
        eq = doc[p - lo : p + hi] == item[q - lo : q + hi]
        longest = int(np.diff(np.flatnonzero(np.r_[True, ~eq, True])).max()) - 1
        old = out.get((d, j))
        if longest >= need or old is not None:
            out[d, j] = [max(longest, old[0] if old else 0), 0.0, 0, longest >= need or bool(old and old[3])]

    def lcs_check(out: dict, docs_ids: list[np.ndarray], d: np.ndarray, j: int, diagonal: np.ndarray) -> None:
        """The best subsequence of each document with an item, over all diagonals that have a candidate."""
        _, item, _ = items.items[j]
        near = np.full((len(d), len(item) + 10), -1)
        for r, (i, a) in enumerate(zip(d.tolist(), diagonal.tolist())):
            x = docs_ids[i][max(0, a - 5) : a + len(item) + 5]
            near[r, : len(x)] = x
        may = np.isin(near, item).sum(axis=1) >= 0.6 * len(item)  # no subsequence is longer than what is common
        may |= np.fromiter(((i, j) in out for i in d.tolist()), bool, len(d))
        for i, n in zip(d[may].tolist(), lcs_lengths(item, near[may]).tolist()):
            lcs, old = n / len(item), out.get((i, j))
            if old is not None:
                old[1:3] = [max(lcs, old[1]), old[2] or int(np.isin(item[-12:], docs_ids[i]).sum())]
            elif lcs >= 0.6:
                out[i, j] = [0, lcs, int(np.isin(item[-12:], docs_ids[i]).sum()), False]

    return src.mapInArrow(search, schema)
