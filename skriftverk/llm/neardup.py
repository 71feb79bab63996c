"""Problem 4: near-duplicate texts in one collection, by token-combination prefixes.

The tokens of a text are its distinct 5-word sequences. All tokens stand in one global order, rare before frequent. Two
texts of similarity ``t`` or more share at least ``k`` tokens among the first ``n - ceil(t n) + k`` of each. So the
prefix is extended to ``k = 2``: rare tokens (``rare`` texts or fewer) of the prefix are indexed singly, frequent ones by
each combination of two. A pair of similar texts either shares a rare token of both prefixes or two frequent ones, so no
link is lost at any setting of ``rare``; the setting only balances index size against candidates. Candidates are
verified on the whole token sets. Tokens of one text only can be shared by no pair and leave after counting.

Copies (texts with the same token set) are one entity from the first shuffle on and are expanded at the end. Texts of
fewer than five words, blank and null ones are similar to nothing. Repeated ids count as separate rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import materialize, spread
from .common import M64, batch_sequences, chunks, distinct_sets, lists, mix


def fingerprints(row: np.ndarray, g: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit hash of each row's set, from distinct (row, hash)."""
    u = g.view(np.uint64)
    a, b = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
    np.add.at(a, row, mix(u))
    np.add.at(b, row, mix(u ^ M64))
    return mix(mix(a) + b * M64).view(np.int64)


def sequence_sets(df: DataFrame, id_col: str, text_col: str, k: int = 5, carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, carried columns, fp, n, grams) of the texts that have ``k`` words or more; grams are distinct and sorted."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t"):
            row, g = distinct_sets(*batch_sequences(b.column(1).to_pylist(), k))
            n = np.bincount(row, minlength=b.num_rows)
            has = np.flatnonzero(n)
            take = pa.array(has)
            cols = [b.column(0).take(take), *(b.column(2 + i).take(take) for i in range(len(carry)))]
            fp = fingerprints(row, g, b.num_rows)[has]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(fp), pa.array(n[has].astype(np.int32)), lists(g, n[has], pa.int64())], names=["id", *carry, "fp", "n", "grams"])

    kinds = dict(df.dtypes)
    src = spread(df.selectExpr(f"`{id_col}` as id", f"`{text_col}` as t", *(f"`{c}`" for c in carry)))
    return src.mapInArrow(run, ", ".join([f"id {kinds[id_col]}", *(f"`{c}` {kinds[c]}" for c in carry), "fp long, n int, grams array<long>"]))


def prefix_length(n: str, num: int, den: int, k: int) -> str:
    """SQL: the first tokens of a set of ``n`` among which ``k`` are shared, at similarity num/den."""
    return f"({n} - cast(ceil({n} * {num}D / {den}) as int) + {k})"


def near_duplicate_links(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: str = "0.8", k: int = 5, rare: int = 32) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (fp_a, fp_b, shared, n_a, n_b) between different token sets, fp_a < fp_b; members (id, fp)."""
    t = Fraction(similarity)
    num, den = t.numerator, t.denominator
    sets = sequence_sets(df, id_col, text_col, k)
    sets = materialize(sets, "sets")
    members = sets.select("id", "fp")
    ents = sets.groupBy("fp").agg(F.first("n").alias("n"), F.first("grams").alias("grams"))
    tokens = materialize(ents.select("fp", "n", F.explode("grams").alias("token")), "tokens")
    counts = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = tokens.join(counts, "token")
    ents = materialize(
        shared.groupBy("fp", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("toks")).select("fp", "n", "toks"),
        "repeated",
    )
    # tokens of one text come first in the order, so the prefix holds that many fewer of the repeated ones
    pre = ents.withColumn("keep", F.expr(f"{prefix_length('n', num, den, 2)} - (n - size(toks))")).filter("keep > 0")
    pre = pre.select("fp", "n", F.expr("slice(toks, 1, keep)").alias("p"))
    single = pre.select("fp", "n", F.explode(F.expr(f"transform(filter(p, x -> x.df <= {rare}), x -> x.token)")).alias("key"))
    often = pre.select("fp", "n", F.expr(f"transform(filter(p, x -> x.df > {rare}), x -> x.token)").alias("f")).filter("size(f) > 1")
    pairs = F.expr("flatten(transform(sequence(0, size(f) - 2), i -> transform(slice(f, i + 2, size(f)), y -> xxhash64(f[i], y))))")
    keys = single.union(often.select("fp", "n", F.explode(pairs)))
    a, b = (keys.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("fp", "n"))) for s in "ab")
    near = f"fp_a < fp_b and n_a * {num}L <= n_b * {den}L and n_b * {num}L <= n_a * {den}L"
    cand = a.join(b, "key").filter(near).select("fp_a", "n_a", "fp_b", "n_b").distinct()
    have = ents.select("fp", F.expr("transform(toks, x -> x.token)").alias("g"))
    links = (
        cand.join(have.withColumnsRenamed({"fp": "fp_a", "g": "g_a"}), "fp_a")
        .join(have.withColumnsRenamed({"fp": "fp_b", "g": "g_b"}), "fp_b")
        .select("fp_a", "fp_b", "n_a", "n_b", F.size(F.array_intersect("g_a", "g_b")).alias("shared"))
        .filter(f"shared * {den}L >= (n_a + n_b - shared) * {num}L")
    )
    return links, members


def near_duplicate_pairs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: str = "0.8", k: int = 5, rare: int = 32) -> DataFrame:
    """All pairs (id_a < id_b) of similarity or more, copies included."""
    links, members = near_duplicate_links(df, id_col, text_col, similarity, k, rare)
    a, b = members.withColumnsRenamed({"id": "x", "fp": "fp_a"}), members.withColumnsRenamed({"id": "y", "fp": "fp_b"})
    across = links.select("fp_a", "fp_b").join(a, "fp_a").join(b, "fp_b").select("x", "y")
    copies = a.join(b, F.col("fp_a") == F.col("fp_b")).filter("x < y").select("x", "y")
    return across.union(copies).select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b"))


def near_duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: str = "0.8", k: int = 5, rare: int = 32) -> DataFrame:
    """A row per text that has a near-duplicate or copy: id, group (the least id in it), copies (of its token set, itself
    included) and links (to other token sets)."""
    links, members = near_duplicate_links(df, id_col, text_col, similarity, k, rare)
    links = materialize(links.select("fp_a", "fp_b"), "links")
    degree = links.select(F.col("fp_a").alias("fp")).union(links.select("fp_b")).groupBy("fp").agg(F.count("*").alias("links"))
    comp = connected_components(links, "fp_a", "fp_b").withColumnRenamed("id", "fp")
    copies = members.groupBy("fp").agg(F.count("*").alias("copies"), F.min("id").alias("low"))
    ents = copies.join(degree, "fp", "left").join(comp, "fp", "left").filter("copies > 1 or links is not null")
    ents = ents.withColumn("component", F.coalesce("component", "fp")).withColumn("links", F.coalesce("links", F.lit(0)))
    low = ents.groupBy("component").agg(F.min("low").alias("group"))
    return members.join(ents.join(low, "component"), "fp").select(F.col("id").alias(id_col), "group", "copies", "links")
