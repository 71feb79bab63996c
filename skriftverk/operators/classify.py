"""Article, discussion or unknown, from the address, then from an additive score over page and text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.lexicon import ARTICLE_WORDS, DISCUSSION_WORDS
from ..functions.text import tokens
from .filters import text_of


def discussion_score(text: Column, page: Column) -> Column:
    t, h = F.lower(text_of(text)), F.lower(text_of(page))
    has = lambda c, *ws: reduce(lambda a, b: a | b, (c.contains(w) for w in ws))
    short = (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) > 15) & (F.size(tokens(t)) < 300)
    rules = [
        (3, has(h, "postbody", "forum-post", "message-body")), (1, has(h, "reply", "besvarade")), (3, has(t, " skrev:")), (1, has(t, " citat:")),
        (1, has(t, "tillbaka till förstasidan")), (1, has(t, " online:", " offline:")), (1, has(t, "användarnamn:", "medlem:")), (1, has(t, "inlägg:", "registrerad:")), (1, short),
    ]
    return reduce(lambda a, b: a + b, (F.when(c, n).otherwise(0) for n, c in rules))


def document_class(url: Column, text: Column, page: Column) -> Column:
    u, t = F.lower(text_of(url)), text_of(text)
    dots = F.length(t) - F.length(F.replace(t, F.lit("."), F.lit("")))
    return (
        F.when(u.rlike("|".join(DISCUSSION_WORDS)), "discussion")
        .when(u.rlike("|".join(ARTICLE_WORDS)), "article")
        .when(discussion_score(text, page) >= 4, "discussion")
        .when((F.size(tokens(t)) > 150) & (dots > 5), "article")
        .otherwise("unknown")
    )
