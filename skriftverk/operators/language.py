"""Language by a vote of frequent words, with a score in [0, 1]; no model file is needed. ``scorer`` plugs in a model."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import LANGUAGE_WORDS
from ..functions.text import tokens
from .filters import text_of


def language_scores(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``votes``, a map of language to the tokens among its frequent words."""
    toks = tokens(F.lower(text_of(text)))

    def votes(words: Column) -> Column:
        return F.size(F.filter("_t", lambda w: F.array_contains(words, w)))

    pairs = [x for lang, ws in LANGUAGE_WORDS.items() for x in (F.lit(lang), votes(F.array(*(F.lit(w) for w in ws.split()))))]
    return df.withColumn("_t", toks).withColumn("votes", F.create_map(*pairs)).drop("_t")


def language_score(lang: str) -> Column:
    """A language's share of the most votes and its own: its votes over the largest number of votes of any."""
    top = F.array_max(F.map_values("votes"))
    return F.when(top == 0, 0.0).otherwise(F.col("votes")[lang].cast("double") / top)


def best_language() -> Column:
    """The language with most votes, the first by name on ties; null without a vote."""
    return F.when(F.array_max(F.map_values("votes")) == 0, None).otherwise(
        F.array_sort(F.transform(F.map_entries("votes"), lambda e: F.struct((-e["value"]).alias("n"), e["key"].alias("k"))))[0]["k"]
    )


def in_language(lang: str, threshold: float) -> Column:
    """Whether the score is above the threshold and no other language is the best one."""
    return (language_score(lang) > threshold) & F.coalesce(best_language() == lang, F.lit(False))


def language_filter(df: DataFrame, text: str = "text", lang: str = "sv", threshold: float = 0.75) -> DataFrame:
    return language_scores(df, text).filter(in_language(lang, threshold)).drop("votes")


def model_scores(df: DataFrame, scorer: Callable[[list[str]], list[dict[str, float]]], text: str = "text") -> DataFrame:
    """Adds ``votes`` from a model: ``scorer`` gives the score of each language for a list of texts, in Arrow batches. The filters above
    take either kind of votes."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series(scorer([x or "" for x in s]), dtype=object)

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return df.withColumn("votes", F.pandas_udf(run, "map<string,double>")(F.col(text)))
