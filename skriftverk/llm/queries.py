"""Queries pN_... over the test tables; each reads its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import boilerplate, encoding, personal, quality, sentences
from .history import repeated_records
from .leakage import leaks
from .neardup import near_duplicate_groups, near_duplicate_pairs
from .repetition import repetition_stats, repetitive
from .tokens import encode_corpus

Query = Callable[[SparkSession, str], DataFrame]
SIMILARITY = "0.72"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return encoding.garbled_ids(table(spark, d, "documents"))


def p1_restored(spark: SparkSession, d: str) -> DataFrame:
    return encoding.restored(table(spark, d, "documents"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.boilerplate_lines(table(spark, d, "pages"), boilerplate.fitted(table(spark, d, "gold")))


def p2_bodies(spark: SparkSession, d: str) -> DataFrame:
    return boilerplate.main_bodies(table(spark, d, "pages"), boilerplate.fitted(table(spark, d, "gold")))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    names = personal.learn_names(docs, table(spark, d, "given_names"))
    return personal.find_personal(docs, names).select("doc_id", "start_pos", "kind")


def p3_masked(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return personal.masked(docs, personal.learn_names(docs, table(spark, d, "given_names")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_pairs(table(spark, d, "documents"), similarity=SIMILARITY)


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicate_groups(table(spark, d, "documents"), similarity=SIMILARITY)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return repeated_records(table(spark, d, "extracted"), similarity=SIMILARITY)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return repetitive(table(spark, d, "documents"), share=0.30)


def p6_stats(spark: SparkSession, d: str) -> DataFrame:
    return repetition_stats(table(spark, d, "documents"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return quality.not_prose(table(spark, d, "documents"))


def p7_statistics(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_statistics(table(spark, d, "documents"))


def p7_types(spark: SparkSession, d: str) -> DataFrame:
    return quality.text_types(table(spark, d, "documents"))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return encode_corpus(table(spark, d, "documents"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    got = leaks(table(spark, d, "documents"), table(spark, d, "benchmark"))
    return got.filter("exact").select("doc_id", "item_id")


def p9_leaks(spark: SparkSession, d: str) -> DataFrame:
    got = leaks(table(spark, d, "documents"), table(spark, d, "benchmark"), cosine=0.75, known=5, paraphrases=True, bits=8, tables=6)
    return got.select("doc_id", "item_id", "run", F.round("lcs", 4).alias("lcs"), "answers", "exact")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """The sample's documents; its ids are unique and far smaller than the texts, so the texts stay where they are if it fits."""
    docs = table(spark, d, "documents").join(table(spark, d, "sentence_sample").filter("doc_id is not null").distinct(), "doc_id", "left_semi")
    return sentences.sentence_units(docs).select("doc_id", "start_pos")


def p10_units(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentence_units(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[:1] == "p" and k[1:2].isdigit()}
