"""Extraction against text by hand: ROUGE-1, word differences, retention, discard audit. Null text counts as empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip, tokens
from .filters import normal_id, text_of


def word_counts(df: DataFrame, id_col: str, text: str, n: str) -> DataFrame:
    return df.select(id_col, F.explode(tokens(F.lower(text_of(text)))).alias("word")).groupBy(id_col, "word").agg(F.count("*").alias(n))


def _counts(df: DataFrame, id_col: str, got: str, gold: str) -> DataFrame:
    a, b = word_counts(df, id_col, got, "got"), word_counts(df, id_col, gold, "gold")
    return a.join(b, [id_col, "word"], "full").na.fill(0, ["got", "gold"])


def rouge1(df: DataFrame, id_col: str, got: str, gold: str) -> DataFrame:
    """(id, precision, recall, rouge1) of every row; ids are taken to be unique."""
    s = _counts(df, id_col, got, gold).groupBy(id_col).agg(F.sum(F.least("got", "gold")).alias("both"), F.sum("got").alias("g"), F.sum("gold").alias("h"))
    r = df.select(id_col).join(s, id_col, "left").na.fill(0, ["both", "g", "h"])
    p, q = F.when(F.col("g") == 0, 0.0).otherwise(F.col("both") / F.col("g")), F.when(F.col("h") == 0, 0.0).otherwise(F.col("both") / F.col("h"))
    return r.select(id_col, p.alias("precision"), q.alias("recall")).withColumn("rouge1", F.expr("case when precision + recall = 0 then 0.0D else 2 * precision * recall / (precision + recall) end"))


def word_diff(df: DataFrame, id_col: str, got: str, gold: str, most: int = 50) -> DataFrame:
    """(id, missing, extra): sorted words with their surplus, the first ``most`` of each (a report)."""
    c = _counts(df, id_col, got, gold)
    side = lambda a, b: F.slice(F.array_sort(F.flatten(F.collect_list(F.array_repeat("word", F.greatest(F.col(a) - F.col(b), F.lit(0)).cast("int"))))), 1, most)
    d = c.groupBy(id_col).agg(side("gold", "got").alias("missing"), side("got", "gold").alias("extra"))
    empty = F.array().cast("array<string>")
    return df.select(id_col).join(d, id_col, "left").select(id_col, F.coalesce("missing", empty).alias("missing"), F.coalesce("extra", empty).alias("extra"))


def retention(df: DataFrame, reason: str = "filter_reason", gold: str = "gold_text", id_col: str = "id", by: list[str] | None = None) -> DataFrame:
    """Saved, discarded, retention recall and precision over rows with a reason where they were dropped."""
    good = strip(text_of(gold)) != ""
    saved = F.col(reason).isNull()
    agg = df.groupBy(*(by or [])).agg(
        F.count_if(saved).alias("saved"), F.count_if(~saved).alias("discarded"), F.count_if(good).alias("with_gold"), F.count_distinct(F.when(saved & good, F.col(id_col))).alias("both")
    )
    share = lambda n: F.when(F.col(n) == 0, 0.0).otherwise(F.col("both") / F.col(n))
    return agg.select(*(by or []), "saved", "discarded", share("with_gold").alias("retention_recall"), share("saved").alias("retention_precision"))


def discard_breakdown(df: DataFrame, reason: str = "reason", url: str = "url", id_col: str = "id", by: list[str] | None = None) -> DataFrame:
    """Rows and distinct addresses by reason, with the address of the least id as example."""
    return df.groupBy(*(by or []), reason).agg(F.count("*").alias("n"), F.count_distinct(url).alias("urls"), F.min(F.struct(id_col, url))[url].alias("example"))


def audit(df: DataFrame, id_col: str, url: str, reason: str, text: str) -> DataFrame:
    t = text_of(text)
    snippet = F.when(t == "", "[no text]").otherwise(F.substring(t, 1, 200))
    return df.filter(F.col(reason).isNotNull()).select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(reason).alias("reason"), snippet.alias("text_snippet"))


def gold_lookup(docs: DataFrame, gold: DataFrame, doc_id: str = "id", gold_id: str = "id", gold_text: str = "text", block_bytes: int = 4_000_000) -> DataFrame:
    """Each document with the text of the gold record whose normalised id contains its own or lies in it; the least such id wins.

    Equal ids are joined by hash. The other distinct ids go against the gold ids (without their texts) in blocks of about
    ``block_bytes``, each of which is broadcast; texts are joined last, by id. Empty ids match nothing.
    """
    g = gold.select(normal_id(F.col(gold_id)).alias("g"), F.col(gold_text).alias("gold_text")).filter("g <> ''").groupBy("g").agg(F.first("gold_text", ignorenulls=True).alias("gold_text"))
    d = docs.withColumn("_d", normal_id(F.col(doc_id)))
    size = gold.select(F.sum(F.octet_length(normal_id(F.col(gold_id))) + 32)).first()[0] or 0
    blocks = size // block_bytes + 1
    ids = d.select("_d").filter("_d <> ''").distinct()
    same = F.col("_d") == F.col("g")
    hit = ids.join(g.select("g"), same).select("_d", "g")
    rest = ids.join(g.select("g"), same, "left_anti")
    near = F.col("g").contains(F.col("_d")) | F.col("_d").contains(F.col("g"))
    for i in range(blocks):
        part = g.select("g").filter(F.pmod(F.xxhash64("g"), F.lit(blocks)) == i) if blocks > 1 else g.select("g")
        hit = hit.union(rest.join(F.broadcast(part), near).select("_d", "g"))
    best = hit.groupBy("_d").agg(F.min("g").alias("g")).join(g, "g").select("_d", "gold_text")
    return d.join(best, "_d", "left").drop("_d")


def percent_label(c: Column) -> Column:
    return F.format_string("%.1f%%", c * 100)
