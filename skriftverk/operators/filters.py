"""Filters as columns: a rule gives the reason why a row is dropped, or null. Null text and address count as empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import FOREIGN, OTHER_FILES, SWEDISH_STOP_WORDS
from ..functions.text import SPACES, count_class, lines, ratio, tokens


def text_of(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def valid_utf8(raw: Column) -> Column:
    """Bytes or text as valid text; what is no UTF-8 becomes the replacement character. Never drops."""
    return F.make_valid_utf8(raw.cast("string"))


def is_html_page(url: Column, page: Column) -> Column:
    """No file ending of another kind, and a tag that only HTML has."""
    low = F.lower(text_of(page))
    return ~F.lower(text_of(url)).rlike(rf"\.({'|'.join(OTHER_FILES)})$") & (low.contains("<html") | low.contains("<body") | low.contains("<div"))


def quality_measures(df: DataFrame, text: str = "text", stop_words: list[str] = SWEDISH_STOP_WORDS) -> DataFrame:
    """Adds n_lines, n_tokens, stop_words, stop_ratio, foreign_ratio, special_ratio, menu_ratio and short_line_ratio."""
    t = text_of(text)
    toks = tokens(F.lower(t))
    ln = lines(t)
    n = F.length(t)
    words = F.array(*(F.lit(w) for w in stop_words))
    return (
        df.withColumn("_t", toks)
        .withColumn("_l", ln)
        .withColumn("n_lines", F.size("_l"))
        .withColumn("n_tokens", F.size("_t"))
        .withColumn("stop_words", F.size(F.filter("_t", lambda w: F.array_contains(words, w))))
        .withColumn("stop_ratio", ratio(F.col("stop_words"), F.col("n_tokens")))
        .withColumn("foreign_ratio", ratio(count_class(t, FOREIGN), n))
        .withColumn("special_ratio", ratio(count_class(t, f"[^a-zA-Z0-9åäöÅÄÖ{SPACES}]"), n))
        .withColumn("menu_ratio", ratio(count_class(t, r"[&()|+*;]"), n))
        .withColumn("short_line_ratio", ratio(F.size(F.filter("_l", lambda x: F.size(tokens(x)) < 3)), F.col("n_lines")))
        .drop("_t", "_l")
    )


def quality_reason(min_stop_words: float = 0.15, max_foreign: float = 0.05, cls: str = "document_class") -> Column:
    """The first quality rule that a measured row breaks; discussions break none."""
    c = F.col
    return (
        F.when(F.coalesce(c(cls), F.lit("unknown")) == "discussion", None)
        .when(c("n_lines") == 0, "no lines")
        .when(c("n_tokens") < 20, "fewer than 20 words")
        .when(c("stop_ratio") < min_stop_words, F.concat(F.lit("few stop words ("), c("stop_words").cast("string"), F.lit(")")))
        .when(c("foreign_ratio") > max_foreign, "foreign script")
        .when(c("special_ratio") > 0.10, "special characters")
        .when(c("menu_ratio") > 0.035, "menu symbols")
        .when(c("short_line_ratio") > 0.3, "short lines")
    )


def long_enough(text: Column, cls: Column, article: int = 150, discussion: int = 70) -> Column:
    return F.length(text_of(text)) > F.when(cls == "discussion", discussion).otherwise(article)


def not_empty(c: Column) -> Column:
    return F.length(text_of(c)) > 0


def normal_id(c: Column) -> Column:
    return F.replace(F.lower(text_of(c)), F.lit("urn:uuid:"), F.lit(""))


def id_contains(c: Column, part: str, normalize: bool = False) -> Column:
    """Case-sensitive, or with both sides in lower case and without the prefix urn:uuid:."""
    return normal_id(c).contains(part.lower().replace("urn:uuid:", "")) if normalize else text_of(c).contains(part)
