"""Counting, masking and budgeting of contact data by patterns; one-pass native expressions.

Detection, masking and the budget filter are separate, so a masked text is never lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.lexicon import ADDRESS, BULLETS, EMAIL, PHONE, PHONE_PARITY, POSTCODE
from ..functions.text import strip
from .filters import text_of

PATTERNS = {"phones": PHONE, "emails": EMAIL, "postcodes": POSTCODE, "addresses": ADDRESS}
#: Kinds in the order in which they are masked, as later patterns would match inside earlier ones.
PLACEHOLDERS = {"addresses": "[ADRESS]", "phones": "[TELEFONNUMMER]", "emails": "[EPOST]", "postcodes": "[POSTNUMMER]"}


def patterns(parity: bool = False) -> dict[str, str]:
    """Pattern by kind; with ``parity`` numbers that begin with a plus sign count only inside words."""
    return PATTERNS | ({"phones": PHONE_PARITY} if parity else {})


def distinct_matches(text: Column, pattern: str) -> Column:
    return F.size(F.array_distinct(F.regexp_extract_all(text_of(text), F.lit(pattern), F.lit(0))))


def pii_count(text: Column, parity: bool = False) -> Column:
    """Distinct matches, summed over the kinds."""
    return reduce(lambda a, b: a + b, (distinct_matches(text, p) for p in patterns(parity).values()))


def within_budget(text: Column, cls: Column, article: int = 5, discussion: int = 10, parity: bool = False) -> Column:
    return pii_count(text, parity) <= F.when(cls == "discussion", discussion).otherwise(article)


def tidy(text: Column) -> Column:
    """An address and its post code side by side, bullets as blanks, no blank before punctuation, single blanks."""
    pair = [PLACEHOLDERS[k] for k in ("addresses", "postcodes")]
    joined = F.regexp_replace(text, r"\s*,\s*".join(p.replace("[", r"\[").replace("]", r"\]") for p in pair), " ".join(pair))
    plain = F.translate(joined, BULLETS, " " * len(BULLETS))
    return strip(F.regexp_replace(F.regexp_replace(plain, r"(?U)\s+(?=[.,:;!?])", ""), r"[ \t]+", " "))


def masked(text: Column, parity: bool = False) -> Column:
    """The text with a placeholder for each match, tidied."""
    by_kind = patterns(parity)
    return tidy(reduce(lambda t, kind: F.regexp_replace(t, by_kind[kind], PLACEHOLDERS[kind]), PLACEHOLDERS, text_of(text)))
