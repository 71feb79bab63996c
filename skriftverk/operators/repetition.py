"""Repetition shares of lines, paragraphs and word n-grams, and the limits on them.

Lines and paragraphs are native; n-grams need counts inside each text, which one narrow Arrow stage does without a shuffle.
A text without the unit in question has share 0. Repeats are all occurrences but the first.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import REPETITION_LIMITS
from ..functions.text import lines, ratio, strip
from .filters import text_of

_WORD = re.compile(r"[^\W_]+")


def _chars(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, x: a + F.length(x))


def line_repetition(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds dup_line_share, dup_line_chars, dup_paragraph_share and dup_paragraph_chars, over stripped units that are not blank."""
    t = text_of(text)
    units = {
        "line": F.filter(F.transform(lines(t), strip), lambda x: x != ""),
        "paragraph": F.filter(F.transform(F.split(t, r"(?:\r?\n){2,}"), strip), lambda x: x != ""),
    }
    for name, parts in units.items():
        df = df.withColumn("_u", parts).withColumn("_d", F.array_distinct("_u"))
        df = df.withColumn(f"dup_{name}_share", ratio(F.size("_u") - F.size("_d"), F.size("_u")))
        df = df.withColumn(f"dup_{name}_chars", ratio(_chars(F.col("_u")) - _chars(F.col("_d")), _chars(F.col("_u"))))
    return df.drop("_u", "_d")


def ngram_shares(text: str | None) -> list[float]:
    """Shares of word characters: the top 2-, 3- and 4-gram, then words inside repeated 5- to 10-grams."""
    ws = _WORD.findall((text or "").lower())
    total = sum(map(len, ws))
    out = []
    for n in (2, 3, 4):
        grams = Counter(zip(*(ws[i:] for i in range(n))))
        out.append(max((k * sum(map(len, g)) for g, k in grams.items() if k > 1), default=0) / max(total, 1))
    size = np.fromiter(map(len, ws), np.int64, len(ws))
    for n in range(5, 11):
        seen: set[tuple[str, ...]] = set()
        inside = np.zeros(len(ws), bool)
        for i, g in enumerate(zip(*(ws[j:] for j in range(n)))):
            if g in seen:
                inside[i : i + n] = True
            else:
                seen.add(g)
        out.append(int(size[inside].sum()) / max(total, 1))
    return out


NGRAM_COLUMNS = [f"top_{n}" for n in (2, 3, 4)] + [f"dup_{n}" for n in range(5, 11)]


def ngram_repetition(df: DataFrame, text: str = "text") -> DataFrame:
    """The input with the n-gram shares; other columns pass through."""
    names = df.columns
    at = names.index(text)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            s = np.array([ngram_shares(t) for t in b.column(at).to_pylist()], float).reshape(-1, len(NGRAM_COLUMNS))
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(s[:, i]) for i in range(s.shape[1]))], names=[*names, *NGRAM_COLUMNS])

    schema = ", ".join([*(f"`{c}` {k}" for c, k in df.dtypes), *(f"{c} double" for c in NGRAM_COLUMNS)])
    return df.mapInArrow(run, schema)


def repetition_reason(limits: dict[str, float] = REPETITION_LIMITS) -> Column:
    """The first limit that a measured row exceeds."""
    out = F.lit(None).cast("string")
    for name, most in reversed(limits.items()):
        out = F.when(F.col(name) > most, name).otherwise(out)
    return out
