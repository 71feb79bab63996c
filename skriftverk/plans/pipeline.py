"""Steps from frame to frame, folded into a plan. A step never drops rows: it gives a reason to those that it rejects.

Rows with a reason stay as they are in later steps, which do no work on them (they see a null page or text), so one pass
gives survivors and the audit of all the others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import html as H
from ..operators.classify import document_class
from ..operators.evaluate import percent_label, retention, rouge1
from ..operators.filters import is_html_page, long_enough, quality_measures, quality_reason
from ..operators.language import in_language, language_scores
from ..operators.repetition import NGRAM_COLUMNS, line_repetition, ngram_repetition, repetition_reason
from ..session import materialize

REASON = "filter_reason"


@dataclass(frozen=True)
class Step:
    name: str
    apply: Callable[[DataFrame], DataFrame]

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.apply(df)


def alive(column: str) -> Column:
    """The column in rows without a reason, else null."""
    return F.when(F.col(REASON).isNull(), F.col(column))


def rejecting(name: str, reason: Column, prepare: Callable[[DataFrame], DataFrame] | None = None, drop: list[str] | None = None) -> Step:
    """A filter step: where ``reason`` is not null, alive rows get it, or the step's name where it is empty."""

    def apply(df: DataFrame) -> DataFrame:
        df = prepare(df) if prepare else df
        why = F.when(reason == "", f"dropped by {name}").otherwise(F.concat(F.lit(f"{name}: "), reason))
        return df.withColumn(REASON, F.coalesce(REASON, why)).drop(*(drop or []))

    return Step(name, apply)


def custom(name: str, keep: Callable[[DataFrame], Column]) -> Step:
    """A user's predicate as a step."""
    return Step(name, lambda df: df.withColumn(REASON, F.coalesce(REASON, F.when(~keep(df), f"dropped by {name}"))))


def run(df: DataFrame, steps: list[Step]) -> DataFrame:
    if REASON not in df.columns:
        df = df.withColumn(REASON, F.lit(None).cast("string"))
    for s in steps:
        df = df.transform(s)
    return df


def survivors(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def only_html() -> Step:
    return rejecting("html", F.when(~is_html_page(F.col("url"), F.col("html")), ""))


def classify() -> Step:
    return Step("class", lambda df: df.withColumn("document_class", document_class(F.col("url"), alive("html"), alive("html"))))


def preprocess() -> Step:
    def apply(df: DataFrame) -> DataFrame:
        df = df.withColumn("_p", H.preprocess(alive("html")))
        df = df.withColumn(REASON, F.coalesce(REASON, F.col("_p.error")))
        return df.withColumn("html", F.coalesce("_p.page", "html")).withColumn("og_title", F.col("_p.og_title")).withColumn("tables", F.col("_p.tables")).drop("_p")

    return Step("preprocess", apply)


def extract(article: int = 150, discussion: int = 70, dense: bool = False) -> Step:
    def apply(df: DataFrame) -> DataFrame:
        df = df.withColumn("_x", (H.dense if dense else H.simple)(alive("html"))).withColumn("text", F.col("_x.text"))
        short = ~long_enough(F.col("text"), F.col("document_class"), article, discussion)
        why = F.when(F.col("_x.error").isNotNull(), F.concat(F.lit("extractor: "), F.col("_x.error"))).when(short, "extractor: text too short")
        return df.withColumn(REASON, F.coalesce(REASON, why)).drop("_x")

    return Step("extract", apply)


def language(lang: str = "sv", threshold: float = 0.75) -> Step:
    return rejecting("language", F.when(~in_language(lang, threshold), ""), lambda df: language_scores(df.withColumn("_alive", alive("text")), "_alive"), ["votes", "_alive"])


def quality(min_stop_words: float = 0.15, max_foreign: float = 0.05) -> Step:
    drop = ["n_lines", "n_tokens", "stop_words", "stop_ratio", "foreign_ratio", "special_ratio", "menu_ratio", "short_line_ratio"]
    return rejecting("quality", quality_reason(min_stop_words, max_foreign), lambda df: quality_measures(df.withColumn("_alive", alive("text")), "_alive"), [*drop, "_alive"])


def repetition() -> Step:
    lines = ["dup_line_share", "dup_line_chars", "dup_paragraph_share", "dup_paragraph_chars"]
    return rejecting("repetition", repetition_reason(), lambda df: ngram_repetition(line_repetition(df.withColumn("_alive", alive("text")), "_alive"), "_alive"), [*lines, *NGRAM_COLUMNS, "_alive"])


def relink() -> Step:
    return Step("tables", lambda df: df.withColumn("text", H.link_tables(F.col("text"), F.col("tables"), F.col("og_title"))).drop("tables", "og_title"))


def production() -> list[Step]:
    return [only_html(), classify(), extract(), language(), quality(), repetition()]


@dataclass(frozen=True)
class Experiment:
    name: str
    steps: list[Step] = field(default_factory=list)


def presets() -> list[Experiment]:
    """The four variants: standard, lenient, strict, and the density-based extractor without the quality rules."""
    return [
        Experiment("standard", [only_html(), classify(), extract(), language(), quality(), repetition()]),
        Experiment("lenient", [only_html(), classify(), extract(50, 50), language(), quality(), repetition()]),
        Experiment("strict", [only_html(), classify(), extract(300, 300), language(threshold=0.85), quality(), repetition()]),
        Experiment("dense", [only_html(), classify(), extract(dense=True), language(), repetition()]),
    ]


def evaluate(gold: DataFrame, experiments: list[Experiment], unescape: bool = True) -> DataFrame:
    """A row per document and experiment: reason, extracted and gold text. Rows get a number, as ids may repeat."""
    page = F.coalesce("html", F.lit(""))
    base = gold.select(F.monotonically_increasing_id().alias("row"), "id", "url", F.col("text").alias("gold_text"), (H.unescape(page) if unescape else page).alias("html"))
    base = materialize(run(base, [preprocess()]), "gold")  # the labelled pages are preprocessed once for all variants
    parts = [run(base, [*e.steps, relink()]).select(F.lit(e.name).alias("experiment"), "row", "id", "url", "gold_text", F.col("text").alias("extracted"), REASON) for e in experiments]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def experiment_table(results: DataFrame) -> DataFrame:
    """A row per experiment: saved, discarded, retention recall and precision as labels, mean ROUGE-1 of the saved."""
    saved = results.filter(F.col(REASON).isNull()).withColumn("key", F.concat_ws("/", "experiment", F.col("row").cast("string")))
    r = rouge1(saved, "key", "extracted", "gold_text").select(F.substring_index("key", "/", 1).alias("experiment"), "rouge1")
    mean = r.groupBy("experiment").agg(F.round(F.avg("rouge1"), 4).alias("rouge1"))
    kept = retention(results, REASON, "gold_text", "id", ["experiment"])
    return kept.join(mean, "experiment", "left").select("experiment", "saved", "discarded", percent_label(F.col("retention_recall")).alias("recall"), percent_label(F.col("retention_precision")).alias("precision"), F.coalesce("rouge1", F.lit(0.0)).alias("rouge1"))
