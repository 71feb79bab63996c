"""Queries of the core over the test tables, and their SQL twins for DuckDB. Every query reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lexicon import ARTICLE_WORDS, BULLETS, DISCUSSION_WORDS, EMAIL, FOREIGN, LANGUAGE_WORDS, LINE_END, OTHER_FILES, PRICE_UNITS, REPETITION_LIMITS, SHORT_LINE_WORDS, STREET_SUFFIXES, SWEDISH_STOP_WORDS, WS
from ..functions.text import SPACES, count_class, is_upper, lines, safe_name, strip, tokens
from ..operators import dedup, evaluate, html, minhash, pii
from ..operators.classify import discussion_score, document_class
from ..operators.filters import id_contains, is_html_page, long_enough, normal_id, not_empty, quality_measures, quality_reason, text_of, valid_utf8
from ..operators.language import best_language, language_filter, language_score, language_scores
from ..operators.repetition import line_repetition, ngram_repetition, repetition_reason
from ..session import materialize, spread, table
from ..sources.files import path_list, preview, removal_log, unfinished
from . import pipeline

Query = Callable[[SparkSession, str], DataFrame]
Q: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(ws: list[str]) -> str:
    return "[" + ",".join(map(lit, ws)) + "]"


# --- pieces of SQL -----------------------------------------------------------------------------------------------------
def s_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{WS}+|{WS}+$')}, '', 'g')"


def s_tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {lit(WS + '+')}), lambda w: w <> '')"


def s_lines(x: str) -> str:
    return f"(case when {x} = '' then [] else regexp_split_to_array(regexp_replace({x}, {lit(LINE_END + '$')}, ''), {lit(LINE_END)}) end)"


def s_words(x: str) -> str:
    return f"regexp_extract_all(lower({x}), '[\\p{{L}}\\p{{N}}]+')"


def s_chars(x: str) -> str:
    return f"coalesce(list_sum(list_transform({x}, lambda x: length(x))), 0)"


def s_bag(words: str, rows: str) -> str:
    return f"select key, word, count(*) as n from (select key, unnest({words}) as word from {rows}) group by 1, 2"


def s_count(t: str, cls: str) -> str:
    return f"(length({t}) - length(regexp_replace({t}, {lit(cls)}, '', 'g')))"


DOCS = "(select *, coalesce(text, '') as t from documents)"
MEASURES = f"""(select *, (case when n_tokens = 0 then 0.0 else stop_words::double / n_tokens end) as stop_ratio,
  (case when n_lines = 0 then 0.0 else len(list_filter(ln, lambda x: len({s_tokens('x')}) < 3))::double / n_lines end) as short_line_ratio,
  (case when length(t) = 0 then 0.0 else {s_count('t', FOREIGN)}::double / length(t) end) as foreign_ratio,
  (case when length(t) = 0 then 0.0 else {s_count('t', f'[^a-zA-Z0-9åäöÅÄÖ{SPACES}]')}::double / length(t) end) as special_ratio,
  (case when length(t) = 0 then 0.0 else {s_count('t', '[&()|+*;]')}::double / length(t) end) as menu_ratio
  from (select *, len(list_filter(toks, lambda w: list_contains({sql_list(SWEDISH_STOP_WORDS)}, w))) as stop_words, len(toks) as n_tokens, len(ln) as n_lines
    from (select *, {s_tokens('lower(t)')} as toks, {s_lines('t')} as ln from {DOCS})))"""
S_REASON = """case when coalesce(document_class, 'unknown') = 'discussion' then null when n_lines = 0 then 'no lines' when n_tokens < 20 then 'fewer than 20 words'
  when stop_ratio < 0.15 then 'few stop words (' || stop_words || ')' when foreign_ratio > 0.05 then 'foreign script' when special_ratio > 0.10 then 'special characters'
  when menu_ratio > 0.035 then 'menu symbols' when short_line_ratio > 0.3 then 'short lines' end"""
S_KEY = f"sha256({s_strip(chr(39) + chr(39) + ' || coalesce(text, ' + chr(39) * 2 + ')')})"


# --- filters -----------------------------------------------------------------------------------------------------------
def _measured(spark: SparkSession, d: str) -> DataFrame:
    return quality_measures(spread(table(spark, d, "documents")))


@query(f"select doc_id, {S_REASON} as reason from {MEASURES}")
def quality_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _measured(spark, d).select("doc_id", quality_reason().alias("reason"))


@query(f"select coalesce(regexp_replace({S_REASON}, ' \\(\\d+\\)', ''), 'kept') as reason, count(*) as n from {MEASURES} group by 1")
def quality_counts(spark: SparkSession, d: str) -> DataFrame:
    reason = F.coalesce(F.regexp_replace(quality_reason(), r" \(\d+\)", ""), F.lit("kept"))
    return _measured(spark, d).groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query(f"select doc_id, n_lines, n_tokens, stop_words, round(stop_ratio, 6) as stop_ratio, round(foreign_ratio, 6) as foreign_ratio, round(special_ratio, 6) as special_ratio, round(menu_ratio, 6) as menu_ratio, round(short_line_ratio, 6) as short_line_ratio from {MEASURES}")
def quality_ratios(spark: SparkSession, d: str) -> DataFrame:
    ratios = [F.round(c, 6).alias(c) for c in ("stop_ratio", "foreign_ratio", "special_ratio", "menu_ratio", "short_line_ratio")]
    return _measured(spark, d).select("doc_id", "n_lines", "n_tokens", "stop_words", *ratios)


S_HTML = f"(not regexp_matches(lower(coalesce(url, '')), {lit(rf'\.({chr(124).join(OTHER_FILES)})$')}) and (contains(lower(coalesce(html, '')), '<html') or contains(lower(coalesce(html, '')), '<body') or contains(lower(coalesce(html, '')), '<div')))"


@query(f"select page_id from pages where {S_HTML}")
def only_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").filter(is_html_page(F.col("url"), F.col("html"))).select("page_id")


@query("select page_id, coalesce(text, '') as text from pages")
def decode_utf8(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", valid_utf8(text_of("text")).alias("text"))


@query("select id from gold where coalesce(text, '') <> ''")
def drop_empty(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gold").filter(not_empty(F.col("text"))).select("id")


@query("select doc_id from documents where length(coalesce(text, '')) > case when document_class = 'discussion' then 70 else 150 end")
def length_gate(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter(long_enough(F.col("text"), F.col("document_class"))).select("doc_id")


@query("select id, url from gold where contains(coalesce(id, ''), 'gold-00')")
def id_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gold").filter(id_contains(F.col("id"), "gold-00")).select("id", "url")


@query("select id, replace(lower(coalesce(id, '')), 'urn:uuid:', '') as normal from gold where contains(replace(lower(coalesce(id, '')), 'urn:uuid:', ''), 'gold-01')")
def normal_id_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "gold").filter(id_contains(F.col("id"), "Gold-01", normalize=True)).select("id", normal_id(F.col("id")).alias("normal"))


# --- classification, language ------------------------------------------------------------------------------------------
def s_has(c: str, *ws: str) -> str:
    return "(" + " or ".join(f"contains({c}, {lit(w)})" for w in ws) + ")"


S_SCORE = " + ".join(
    f"(case when {c} then {n} else 0 end)"
    for n, c in (
        (3, s_has("h", "postbody", "forum-post", "message-body")), (1, s_has("h", "reply", "besvarade")), (3, s_has("t", " skrev:")), (1, s_has("t", " citat:")),
        (1, s_has("t", "tillbaka till förstasidan")), (1, s_has("t", " online:", " offline:")), (1, s_has("t", "användarnamn:", "medlem:")), (1, s_has("t", "inlägg:", "registrerad:")),
        (1, f"length(t) - length(replace(t, chr(10), '')) > 15 and len({s_tokens('t')}) < 300"),
    )
)
S_PAGES = f"(select *, {S_SCORE} as score from (select page_id, lower(coalesce(url, '')) as u, lower(coalesce(text, '')) as t, lower(coalesce(html, '')) as h from pages))"
S_CLASS = f"""case when regexp_matches(u, {lit('|'.join(DISCUSSION_WORDS))}) then 'discussion' when regexp_matches(u, {lit('|'.join(ARTICLE_WORDS))}) then 'article'
  when score >= 4 then 'discussion' when len({s_tokens('t')}) > 150 and length(t) - length(replace(t, '.', '')) > 5 then 'article' else 'unknown' end"""


@query(f"select page_id, score, {S_CLASS} as document_class from {S_PAGES}")
def classify_pages(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return spread(table(spark, d, "pages")).select("page_id", discussion_score(c("text"), c("html")).alias("score"), document_class(c("url"), c("text"), c("html")).alias("document_class"))


@query(f"select {S_CLASS} as document_class, count(*) as n from {S_PAGES} group by 1")
def classify_counts(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return spread(table(spark, d, "pages")).groupBy(document_class(c("url"), c("text"), c("html")).alias("document_class")).agg(F.count("*").alias("n"))


S_VOTES = {k: f"len(list_filter(toks, lambda w: list_contains({sql_list(w.split())}, w)))" for k, w in LANGUAGE_WORDS.items()}
S_LANG = f"(select doc_id, {', '.join(f'{v} as v_{k}' for k, v in S_VOTES.items())} from (select doc_id, {s_tokens('lower(t)')} as toks from {DOCS}))"
S_TOP = "greatest(" + ", ".join(f"v_{k}" for k in LANGUAGE_WORDS) + ")"


@query(f"select doc_id, case when {S_TOP} = 0 then null {' '.join(f'when v_{k} = {S_TOP} then {lit(k)}' for k in sorted(LANGUAGE_WORDS))} end as language, round(case when {S_TOP} = 0 then 0.0 else v_sv::double / {S_TOP} end, 6) as sv from {S_LANG}")
def language_votes(spark: SparkSession, d: str) -> DataFrame:
    s = language_scores(spread(table(spark, d, "documents")))
    return s.select("doc_id", best_language().alias("language"), F.round(language_score("sv"), 6).alias("sv"))


@query(f"select doc_id from {S_LANG} where {S_TOP} > 0 and v_sv = {S_TOP} and {' and '.join(f'v_{k} < v_sv' for k in LANGUAGE_WORDS if k < 'sv')}")
def langid_filter(spark: SparkSession, d: str) -> DataFrame:
    return language_filter(spread(table(spark, d, "documents"))).select("doc_id")


# --- scalar helpers ----------------------------------------------------------------------------------------------------
@query(
    f"""select doc_id, length({s_strip('t')}) as stripped, len({s_tokens('t')}) as n_tokens, len({s_lines('t')}) as n_lines,
    (source = upper(source) and source <> lower(source)) as upper_source, regexp_replace(coalesce(source, ''), '[^\\p{{L}}\\p{{N}}]', '_', 'g') as safe, md5(t) as md5,
    {s_count('t', '[åäöÅÄÖ]')} as swedish_letters from {DOCS}"""
)
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    t = text_of("text")
    return table(spark, d, "documents").select(
        "doc_id", F.length(strip(t)).alias("stripped"), F.size(tokens(t)).alias("n_tokens"), F.size(lines(t)).alias("n_lines"), is_upper(F.col("source")).alias("upper_source"),
        safe_name(text_of("source")).alias("safe"), F.md5(t).alias("md5"), count_class(t, "[åäöÅÄÖ]").alias("swedish_letters"),
    )


# --- contact data ------------------------------------------------------------------------------------------------------
# The SQL engine's patterns have no look-around and know ASCII word boundaries only, so letters beyond ASCII are first written
# in ASCII, one for one, and units after a post code are matched and then left out.
_ASCII = {c: f"q{i}z" for i, c in enumerate("åäöéüøæèáíóñëêïôûçßàâìòùúýžšõœðþ\u030a\u0308\u0301\u0300\u0302\u0327\u0303")}


def s_ascii(t: str, back: bool = False) -> str:
    for c, x in [(f(c), f(x)) for c, x in _ASCII.items() for f in (str.lower, str.upper) if len(f(c)) == 1]:
        t = f"replace({t}, {lit(x if back else c)}, {lit(c if back else x)})"
    return t


def in_ascii(ws: list[str]) -> str:
    return "|".join("".join(_ASCII.get(c, c) for c in w) for w in ws)


S_BLANK = r"[\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
S_PHONE = rf"(?:\B\+46{S_BLANK}?|\b0)[1-9](?:(?:{S_BLANK}|-)?\d){{6,11}}\d\b"
S_CODE = rf"\b[1-9]\d{{2}}{S_BLANK}?\d{{2}}\b"
S_STREET = rf"(?i)\b(?:\w+{S_BLANK}+){{0,2}}\w+(?:{in_ascii(STREET_SUFFIXES)})(?:{S_BLANK}+\d+[a-zA-Z]?)?\b"


def s_found(pattern: str) -> str:
    return f"len(list_distinct(regexp_extract_all(a, {lit(pattern)})))"


S_PII = f"""(select *, {s_found(S_PHONE)} as phones, len(list_distinct(regexp_extract_all(t, {lit(EMAIL)}))) as emails, {s_found(S_STREET)} as addresses,
  len(list_distinct(list_transform(list_filter(list_zip(regexp_extract_all(a, {lit(f'({S_CODE})(?i:{S_BLANK}*({in_ascii(PRICE_UNITS)}))?')}, 1), regexp_extract_all(a, {lit(f'({S_CODE})(?i:{S_BLANK}*({in_ascii(PRICE_UNITS)}))?')}, 2)), lambda x: coalesce(x[2], '') = ''), lambda x: x[1]))) as postcodes
  from (select *, {s_ascii('t')} as a from {DOCS}))"""


@query(f"select doc_id, len(list_distinct(regexp_extract_all(t, {lit(EMAIL)}))) as emails from " + DOCS)
def pii_emails(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", pii.distinct_matches(F.col("text"), EMAIL).alias("emails"))


@query(f"select doc_id, phones, emails, postcodes, addresses, phones + emails + postcodes + addresses <= case when document_class = 'discussion' then 10 else 5 end as within_budget from {S_PII}")
def pii_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = [pii.distinct_matches(F.col("text"), p).alias(k) for k, p in pii.PATTERNS.items()]
    return spread(table(spark, d, "documents")).select("doc_id", *counts, pii.within_budget(F.col("text"), F.col("document_class")).alias("within_budget"))


def s_masked() -> str:
    """Addresses and phones in ASCII, e-mail in the text as it is, codes in ASCII after a mark inside those that a unit follows; then tidied."""
    swap = lambda x, p, by: f"regexp_replace({x}, {lit(p)}, {lit(by)}, 'g')"
    x = swap(swap(s_ascii("t"), S_STREET, pii.PLACEHOLDERS["addresses"]), S_PHONE, pii.PLACEHOLDERS["phones"])
    x = s_ascii(swap(s_ascii(x, True), EMAIL, pii.PLACEHOLDERS["emails"]))
    x = swap(x, rf"(?i)(\b[1-9]\d{{2}}{S_BLANK}?\d)(\d\b{S_BLANK}*(?:{in_ascii(PRICE_UNITS)}))", r"\1" + "\x01" + r"\2")
    x = s_ascii(f"replace({swap(x, S_CODE, pii.PLACEHOLDERS['postcodes'])}, {lit(chr(1))}, '')", True)
    x = swap(x, r"\[ADRESS\][ \t-\r]*,[ \t-\r]*\[POSTNUMMER\]", "[ADRESS] [POSTNUMMER]")
    x = f"translate({x}, {lit(BULLETS)}, {lit(' ' * len(BULLETS))})"
    return s_strip(swap(swap(x, f"{S_BLANK}+([.,:;!?])", r"\1"), r"[ \t]+", " "))


@query(f"select doc_id, {s_masked()} as masked from {DOCS}")
def pii_masked(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents")).select("doc_id", pii.masked(F.col("text")).alias("masked"))


# --- exact deduplication -----------------------------------------------------------------------------------------------
S_DEDUP = f"(select *, row_number() over (partition by {S_KEY} order by batch_no, rec_id) as k, count(*) over (partition by {S_KEY}) as copies from extracted)"


@query(f"select rec_id, copies from {S_DEDUP} where k = 1")
def exact_dedup_kept(spark: SparkSession, d: str) -> DataFrame:
    return dedup.first_ids(table(spark, d, "extracted"), dedup.content_key(F.col("text")), ["batch_no"], "rec_id").select(F.col("_first").alias("rec_id"), "copies")


@query(f"select coalesce(metadata.url, '') as url, replace(substr(coalesce(text, ''), 1, 100), chr(10), ' ') as preview from {S_DEDUP} where k > 1")
def exact_dedup_removed(spark: SparkSession, d: str) -> DataFrame:
    gone = dedup.exact_dedup(table(spark, d, "extracted"), "text", ["batch_no"], "rec_id")[1]
    return removal_log(gone.withColumn("url", F.col("metadata.url")))


@query(f"select count(*) as processed, count(*) filter (where k > 1) as duplicates, count(*) filter (where k = 1) as kept from {S_DEDUP}")
def dedup_totals(spark: SparkSession, d: str) -> DataFrame:
    m = dedup.first_ids(table(spark, d, "extracted"), dedup.content_key(F.col("text")), ["batch_no"], "rec_id")
    n = F.coalesce(F.sum("copies"), F.lit(0))
    return m.agg(n.alias("processed"), (n - F.count("*")).alias("duplicates"), F.count("*").alias("kept"))


@query(
    f"""with k as (select rec_id, batch_no, {S_KEY} as key from extracted), old as (select distinct key from k where batch_no = 0)
    select rec_id from (select *, row_number() over (partition by key order by batch_no, rec_id) as r from k where batch_no > 0 and key not in (select key from old)) where r = 1"""
)
def incremental_dedup(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "extracted")
    seen = e.filter("batch_no = 0").select(dedup.content_key(F.col("text")).alias("key"))
    return dedup.unseen(e.filter("batch_no > 0"), seen, "text", ["batch_no"], "rec_id").select("rec_id")


@query(f"with k as (select rec_id, batch_no, {S_KEY} as key from extracted) select rec_id, key from k where batch_no > 0 and key not in (select key from k where batch_no = 0)")
def bloom_dedup(spark: SparkSession, d: str) -> DataFrame:
    """New batches against a sketch of the history's keys, as large as their number asks for; what it takes for known is looked up."""
    e = table(spark, d, "extracted").withColumn("key", dedup.content_key(F.col("text")))
    keys = materialize(e.filter("batch_no = 0").select("key").distinct(), "keys")
    # of more keys than the sketch is made for, more are looked up, but none is lost
    sketch = dedup.BloomSketch(min(max(keys.count(), 1000), 15_000_000)).add_all(keys)
    return sketch.missing(e.filter("batch_no > 0").select("rec_id", "key"), "key", keys)


@query(f"select batch_no, n, sum(n) over (order by batch_no) as running from (select batch_no, count(*) as n from {S_DEDUP} where k > 1 group by 1)")
def running_duplicates(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    m = dedup.exact_dedup(table(spark, d, "extracted"), "text", ["batch_no"], "rec_id")[1]
    n = m.groupBy("batch_no").agg(F.count("*").alias("n"))  # a row per batch
    return n.withColumn("running", F.sum("n").over(Window.orderBy("batch_no").rowsBetween(Window.unboundedPreceding, 0)))


# --- repetition --------------------------------------------------------------------------------------------------------
def s_parts(expr: str) -> str:
    return f"list_filter(list_transform({expr}, lambda x: {s_strip('x')}), lambda x: x <> '')"


S_UNITS = f"(select doc_id, {s_parts(s_lines('t'))} as l, {s_parts(f'regexp_split_to_array(t, {lit(r"(?:\r?\n){2,}")})')} as p from {DOCS})"


def s_dups(u: str) -> str:
    n, d, c, e = f"len({u})", f"len(list_distinct({u}))", s_chars(u), s_chars(f"list_distinct({u})")
    return f"round(case when {n} = 0 then 0.0 else ({n} - {d})::double / {n} end, 6), round(case when {c} = 0 then 0.0 else ({c} - {e})::double / {c} end, 6)"


@query(f"select doc_id, a[1] as dup_line_share, a[2] as dup_line_chars, b[1] as dup_paragraph_share, b[2] as dup_paragraph_chars from (select doc_id, [{s_dups('l')}] as a, [{s_dups('p')}] as b from {S_UNITS})")
def dup_line_fraction(spark: SparkSession, d: str) -> DataFrame:
    m = line_repetition(spread(table(spark, d, "documents")).select("doc_id", "text"))
    return m.select("doc_id", *(F.round(c, 6).alias(c) for c in ("dup_line_share", "dup_line_chars", "dup_paragraph_share", "dup_paragraph_chars")))


def s_gram(n: int) -> str:
    return " || ' ' || ".join(f"w[i{f' + {j}' if j else ''}]" for j in range(n))


S_W = f"(select doc_id, {s_words('t')} as w from {DOCS})"
S_TOTAL = "coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)"


def s_top(n: int) -> str:
    return f"(select doc_id, max(k * c) as best from (select doc_id, s, count(*) as k, any_value(length(replace(s, ' ', ''))) as c from (select doc_id, {s_gram(n)} as s from (select doc_id, w, unnest(range(1, len(w) - {n} + 2)) as i from {S_W} where len(w) >= {n})) group by 1, 2 having count(*) > 1) group by 1)"


def s_dup(n: int) -> str:
    return f"""(select doc_id, sum(length(w[p])) as best from (select distinct doc_id, w, unnest(range(i, i + {n})) as p from
      (select doc_id, w, i, row_number() over (partition by doc_id, s order by i) as r from (select doc_id, w, i, {s_gram(n)} as s from (select doc_id, w, unnest(range(1, len(w) - {n} + 2)) as i from {S_W} where len(w) >= {n}))) where r > 1) group by 1)"""


def s_ngrams(parts: dict[str, str]) -> str:
    cols = ", ".join(f"round(coalesce({k}.best, 0)::double / greatest(total, 1), 6) as {k}" for k in parts)
    joins = " ".join(f"left join {v} {k} on {k}.doc_id = x.doc_id" for k, v in parts.items())
    return f"select x.doc_id, {cols} from (select doc_id, {S_TOTAL} as total from {S_W}) x {joins}"


@query(s_ngrams({f"top_{n}": s_top(n) for n in (2, 3, 4)}))
def top_ngrams(spark: SparkSession, d: str) -> DataFrame:
    m = ngram_repetition(spread(table(spark, d, "documents").select("doc_id", "text")))
    return m.select("doc_id", *(F.round(f"top_{n}", 6).alias(f"top_{n}") for n in (2, 3, 4)))


@query(s_ngrams({f"dup_{n}": s_dup(n) for n in range(5, 11)}))
def dup_ngrams(spark: SparkSession, d: str) -> DataFrame:
    m = ngram_repetition(spread(table(spark, d, "documents").select("doc_id", "text")))
    return m.select("doc_id", *(F.round(f"dup_{n}", 6).alias(f"dup_{n}") for n in range(5, 11)))


S_LIMITS = {k: v for k, v in REPETITION_LIMITS.items() if k[:3] == "top" or k[4:].isdigit()}
S_SHARES = {"dup_line_share": "l", "dup_line_chars": "l", "dup_paragraph_share": "p", "dup_paragraph_chars": "p"}


def s_share(name: str) -> str:
    u = S_SHARES[name]
    n, k = (s_chars(u), s_chars(f"list_distinct({u})")) if name.endswith("chars") else (f"len({u})", f"len(list_distinct({u}))")
    return f"(case when {n} = 0 then 0.0 else ({n} - {k})::double / {n} end)"


@query(
    f"""select u.doc_id, case {' '.join(f"when {k if k in S_LIMITS else s_share(k)} > {v} then {lit(k)}" for k, v in REPETITION_LIMITS.items())} end as reason
    from {S_UNITS} u join ({s_ngrams({k: (s_top if k[:3] == 'top' else s_dup)(int(k[4:])) for k in S_LIMITS}).replace(', 6)', ', 15)')}) g on g.doc_id = u.doc_id"""
)
def repetition_reasons(spark: SparkSession, d: str) -> DataFrame:
    m = ngram_repetition(line_repetition(spread(table(spark, d, "documents").select("doc_id", "text"))))
    return m.select("doc_id", repetition_reason(REPETITION_LIMITS).alias("reason"))


# --- MinHash -----------------------------------------------------------------------------------------------------------
S_AB = "[" + ",".join(f"[{a},{b}]" for a, b in minhash.coefficients(112)) + "]"
S_SIG = f"""g as (select distinct doc_id, ('0x' || substr(md5({s_gram(5)}), 1, 7))::bigint as h from (select doc_id, w, unnest(range(1, len(w) - 3)) as i from {S_W} where len(w) >= 5)),
  ab as (select unnest(range(1, 113)) as i, unnest({S_AB}) as c),
  m as (select doc_id, i, min((c[1] * h + c[2]) % {minhash.PRIME}) as v from g, ab group by 1, 2),
  sig as (select doc_id, list(v order by i) as signature from m group by 1)"""
S_BUCKETS = S_SIG + ", bk as (select doc_id, b as band, md5(array_to_string(signature[b * 8 + 1 : b * 8 + 8], ',')) as bucket from (select *, unnest(range(0, 14)) as b from sig))"
S_LINKS = S_BUCKETS + ", lk as (select distinct low as a, doc_id as b from (select *, min(doc_id) over (partition by band, bucket) as low from bk) where low <> doc_id)"
S_CLUSTERS = "with recursive " + S_LINKS + """, ed as (select a, b from lk union select b, a from lk),
  reach as (select a as id, a as root from ed union select ed.b, reach.root from reach join ed on ed.a = reach.id), cl as (select id, min(root) as cluster from reach group by 1)"""


@query(f"with {S_SIG} select doc_id, signature from sig")
def minhash_signatures(spark: SparkSession, d: str) -> DataFrame:
    return minhash.signatures(table(spark, d, "documents"))


@query(f"with {S_BUCKETS} select doc_id, band, bucket from bk")
def minhash_bands(spark: SparkSession, d: str) -> DataFrame:
    return minhash.band_buckets(minhash.signatures(table(spark, d, "documents"))).select("doc_id", F.col("band").cast("bigint").alias("band"), "bucket")


@query(f"{S_CLUSTERS} select id as doc_id, cluster from cl")
def minhash_clusters(spark: SparkSession, d: str) -> DataFrame:
    return minhash.clusters(table(spark, d, "documents"))


@query(f"{S_CLUSTERS} select doc_id from documents where doc_id not in (select id from cl where id <> cluster)")
def minhash_kept(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_dedup(table(spark, d, "documents").select("doc_id", "text"))[0].select("doc_id")


@query(f"{S_CLUSTERS} select doc_id, lang from documents where doc_id in (select id from cl where id <> cluster)")
def minhash_removed(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_dedup(table(spark, d, "documents").select("doc_id", "text", "lang"))[1].select("doc_id", "lang")


# --- evaluation --------------------------------------------------------------------------------------------------------
#: Gold rows with a number of their own, as one id is repeated; extraction here is plain tag removal, which SQL can repeat.
S_STRIPPED = "regexp_replace(regexp_replace(coalesce(html, ''), '<[^>]*>', ' ', 'g'), '&[a-zA-Z0-9#]+;', ' ', 'g')"
S_GOLD = f"(select coalesce(id, '') || '/' || md5(coalesce(html, '') || coalesce(url, '')) as key, any_value(coalesce(text, '')) as gold, any_value({S_STRIPPED}) as got from gold group by 1)"
S_WC = f"a as ({s_bag(s_tokens('lower(got)'), S_GOLD)}), b as ({s_bag(s_tokens('lower(gold)'), S_GOLD)}), c as (select coalesce(a.key, b.key) as key, coalesce(a.word, b.word) as word, coalesce(a.n, 0) as got, coalesce(b.n, 0) as gold from a full join b on a.key = b.key and a.word = b.word)"


def _gold(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gold")
    got = F.regexp_replace(F.regexp_replace(text_of("html"), "<[^>]*>", " "), "&[a-zA-Z0-9#]+;", " ")
    key = F.concat(text_of("id"), F.lit("/"), F.md5(F.concat(text_of("html"), text_of("url"))))
    return g.select(key.alias("key"), text_of("text").alias("gold"), got.alias("got")).groupBy("key").agg(F.first("gold").alias("gold"), F.first("got").alias("got"))


@query(
    f"""with {S_WC}, s as (select key, sum(least(got, gold)) as common, sum(got) as g, sum(gold) as h from c group by 1),
    r as (select k.key, case when coalesce(g, 0) = 0 then 0.0 else common::double / g end as precision, case when coalesce(h, 0) = 0 then 0.0 else common::double / h end as recall from {S_GOLD} k left join s using (key))
    select key, round(precision, 6) as precision, round(recall, 6) as recall, round(case when precision + recall = 0 then 0.0 else 2 * precision * recall / (precision + recall) end, 6) as rouge1 from r"""
)
def rouge1(spark: SparkSession, d: str) -> DataFrame:
    r = evaluate.rouge1(_gold(spark, d), "key", "got", "gold")
    return r.select("key", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "rouge1")))


@query(
    f"""with {S_WC}, r as (select key, list_sort(flatten(list(list_transform(range(greatest(gold - got, 0)), lambda i: word)))) as missing,
    list_sort(flatten(list(list_transform(range(greatest(got - gold, 0)), lambda i: word)))) as extra from c group by 1)
    select k.key, coalesce(missing[1:50], []) as missing, coalesce(extra[1:50], []) as extra from {S_GOLD} k left join r using (key)"""
)
def word_diff(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.word_diff(_gold(spark, d), "key", "got", "gold")


@query(
    """select experiment, count(*) as n, round(avg(rouge1), 6) as mean_rouge1, sum(len(coalesce(missing, []))) as missing_words, sum(len(coalesce(extra, []))) as extra_words
    from diffs group by 1"""
)
def diff_report(spark: SparkSession, d: str) -> DataFrame:
    size = lambda c: F.size(F.coalesce(c, F.array().cast("array<string>")))
    return table(spark, d, "diffs").groupBy("experiment").agg(
        F.count("*").alias("n"), F.round(F.avg("rouge1"), 6).alias("mean_rouge1"), F.sum(size("missing")).alias("missing_words"), F.sum(size("extra")).alias("extra_words")
    )


@query("select experiment, reason, count(*) as n, count(distinct url) as urls, arg_min_null(url, coalesce(id, '') || '/' || coalesce(url, '')) as example from discards group by 1, 2")
def discard_breakdown(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "discards").withColumn("key", F.concat(text_of("id"), F.lit("/"), text_of("url")))
    return evaluate.discard_breakdown(rows, "reason", "url", "key", ["experiment"])


S_RETENTION = f"""(select p.page_id as id, p.text as gold_text, case when {S_HTML.replace('url', 'p.url').replace('html,', 'p.html,')} then null else 'html' end as reason, coalesce(p.source, '') as source from pages p)"""


@query(
    f"""select count(*) filter (where reason is null) as saved, count(*) filter (where reason is not null) as discarded,
    round(count(*) filter (where reason is null and good)::double / nullif(count(*) filter (where good), 0), 6) as retention_recall,
    round(count(*) filter (where reason is null and good)::double / nullif(count(*) filter (where reason is null), 0), 6) as retention_precision
    from (select *, {s_strip("coalesce(gold_text, '')")} <> '' as good from {S_RETENTION})"""
)
def retention_pr(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select(F.col("page_id").alias("id"), F.col("text").alias("gold_text"), F.when(~is_html_page(F.col("url"), F.col("html")), "html").alias("filter_reason"))
    r = evaluate.retention(p)
    return r.select("saved", "discarded", F.round("retention_recall", 6).alias("retention_recall"), F.round("retention_precision", 6).alias("retention_precision"))


@query(
    f"""with g as (select replace(lower(coalesce(id, '')), 'urn:uuid:', '') as g from gold), x as (select distinct g from g where g <> ''),
    p as (select page_id, replace(lower(coalesce(id, '')), 'urn:uuid:', '') as k from pages)
    select page_id, arg_min(x.g, (case when x.g = k then '0' else '1' end) || x.g) as gold_id from p join x on k <> '' and (contains(k, x.g) or contains(x.g, k)) group by 1
    union all select page_id, null from p where not exists (select 1 from x where k <> '' and (contains(k, x.g) or contains(x.g, k)))"""
)
def gold_lookup(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "gold").select("id", normal_id(F.col("id")).alias("g"))
    return evaluate.gold_lookup(table(spark, d, "pages").select("page_id", "id"), g, "id", "id", "g").select("page_id", F.col("gold_text").alias("gold_id"))


@query("select page_id as id from pages where page_id not in (select p.page_id from pages p join discards d on p.id = d.id)")
def never_discarded(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").join(table(spark, d, "discards").select("id").distinct(), "id", "left_anti").select(F.col("page_id").alias("id"))


@query("select page_id as id, url from pages where id in (select id from discards)")
def ever_discarded(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").join(table(spark, d, "discards").select("id").distinct(), "id", "left_semi").select(F.col("page_id").alias("id"), "url")


@query("select experiment, count(*) as n, count(distinct id) as ids, printf('%.1f%%', 100.0 * count(distinct id) / (select count(*) from pages)) as share from discards group by 1")
def discard_rates(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").agg(F.greatest(F.count("*"), F.lit(1)).alias("pages"))  # one row
    r = table(spark, d, "discards").groupBy("experiment").agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"))
    return r.join(F.broadcast(pages)).select("experiment", "n", "ids", evaluate.percent_label(F.col("ids") / F.col("pages")).alias("share"))


@query("select id, url, reason, text_snippet from (select id, url, 'empty' as reason, '[no text]' as text_snippet from pages where coalesce(text, '') = '')")
def discard_audit(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").withColumn("reason", F.when(~not_empty(F.col("text")), "empty"))
    return evaluate.audit(p, "id", "url", "reason", "text")


@query("select doc_id, doc.quality, toxic from (select doc_id, quality, toxic from labels intersect all select doc_id, quality, toxic from labels where quality is not null) doc")
def marked_quality(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return m.intersectAll(m.filter("quality is not null"))


@query("select doc_id, quality, toxic from labels except all select distinct doc_id, quality, toxic from labels")
def repeated_marks(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    return m.exceptAll(m.distinct())


# --- sources and previews ----------------------------------------------------------------------------------------------
@query(f"select distinct p as path from (select {s_strip('value')} as p from shard_paths) where p <> ''")
def shard_list(spark: SparkSession, d: str) -> DataFrame:
    return path_list(table(spark, d, "shard_paths"))


@query(f"select distinct p as path from (select {s_strip('value')} as p from shard_paths) where p <> '' and md5(p) >= '8'")
def shards_to_do(spark: SparkSession, d: str) -> DataFrame:
    paths = path_list(table(spark, d, "shard_paths"))
    return unfinished(paths, paths.filter(F.md5("path") < "8"))


@query("select page_id, document_class, substr(text, 1, 500) as preview from pages")
def page_preview(spark: SparkSession, d: str) -> DataFrame:
    return preview(table(spark, d, "pages"), "page_id")


# --- extraction --------------------------------------------------------------------------------------------------------
@query()
def extract_text(spark: SparkSession, d: str) -> DataFrame:
    p = html.simple_text(spread(table(spark, d, "pages").select("page_id", "html", "document_class")))
    return p.filter(long_enough(F.col("extracted"), F.col("document_class"))).select("page_id", "extracted")


@query()
def extract_dense(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "pages").select("page_id", "html")).select("page_id", html.dense(F.col("html"))["text"].alias("extracted"))


@query()
def preprocess_tables(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "pages").select("page_id", "html")).withColumn("p", html.preprocess(F.col("html"))).select("page_id", "p.og_title", F.size("p.tables").alias("n_tables"), F.length("p.page").alias("chars"))


@query()
def table_link(spark: SparkSession, d: str) -> DataFrame:
    p = spread(table(spark, d, "pages").select("page_id", "html")).withColumn("p", html.preprocess(F.col("html"))).select("page_id", F.col("p.page").alias("html"), "p.og_title", "p.tables")
    return html.simple_text(p).select("page_id", html.link_tables(F.col("extracted"), F.col("tables"), F.col("og_title"), True).alias("text"))



S_SHORT = f"len({s_tokens('x')})"
S_FIRST = "(substr(x, 1, 1) = upper(substr(x, 1, 1)) and substr(x, 1, 1) <> lower(substr(x, 1, 1)))"
S_KEPT = f"""list_filter(list_filter({s_parts(s_lines('t'))}, lambda x: not ({S_SHORT} < 5 and list_has_any({s_tokens('x')}, {sql_list(SHORT_LINE_WORDS)}))),
  lambda x: not ({S_SHORT} < 4 and not regexp_matches(x, '[.,!?:]$') and not {S_FIRST}))"""
S_CALM = "list_filter(k, lambda x, i: not (suffix(x, ':') and coalesce(suffix(k[i + 1], ':'), false)))"


@query(
    f"""select page_id, coalesce(array_to_string(list_transform(c, lambda x, i: case when i = 1 then x
      when regexp_matches(c[i - 1], '[.!?:]$') or suffix(x, ':') or (x = upper(x) and x <> lower(x)) then chr(10) || x else ' ' || x end), ''), '') as joined
    from (select page_id, {S_CALM} as c from (select page_id, {S_KEPT} as k from (select page_id, coalesce(text, '') as t from pages)))"""
)
def line_join(spark: SparkSession, d: str) -> DataFrame:
    p = spread(table(spark, d, "pages").select("page_id", "text")).withColumn("k", html.clean_lines(lines(text_of("text"))))
    return p.select("page_id", html.joined_lines(F.col("k")).alias("joined"))


@query()
def unescaped_pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", html.unescape(text_of("html")).alias("html"))


@query()
def production_pipeline(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "pages").select("page_id", "url", "html")
    return pipeline.run(spread(p), pipeline.production()).select("page_id", "document_class", "text", pipeline.REASON)


@query()
def experiment_table(spark: SparkSession, d: str) -> DataFrame:
    return pipeline.experiment_table(pipeline.evaluate(table(spark, d, "gold"), pipeline.presets()))
