"""Native column functions on text; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import LINE_END, WS

#: As a character class, for negations.
SPACES = WS[1:-1]


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def tokens(c: Column) -> Column:
    """Tokens between white space; none for blank text."""
    return F.filter(F.split(c, f"{WS}+"), lambda w: w != "")


def lines(c: Column) -> Column:
    """Lines at all line ends; an end at the end of the text opens no line, and empty text has none."""
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(F.regexp_replace(c, f"{LINE_END}\\z", ""), LINE_END))


def count_class(c: Column, pattern: str) -> Column:
    return F.length(c) - F.length(F.regexp_replace(c, pattern, ""))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b)


def is_upper(c: Column) -> Column:
    """Whether there is a cased letter and none is lower case."""
    return (c == F.upper(c)) & (c != F.lower(c))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}]", "_")


def percent(c: Column) -> Column:
    return F.concat(F.format_number(F.round(c * 100, 1), "0.0"), F.lit("%"))
