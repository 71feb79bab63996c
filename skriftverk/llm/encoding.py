"""Problem 1: text that was read with the wrong encoding.

1. Every distinct word of the corpus that has letters beyond ASCII is written in each encoding of its script and read in
   each wrong one (also twice). Scripts without spaces have windows of two characters instead of words, as written in
   their multi-byte encodings. This gives a table of garbled forms and originals.
2. The distinct suspicious tokens of the documents are hash-joined against the table. A match is verified if the token cannot be
   a word itself (signs inside, mixed scripts or case, runs of accented letters), however frequent it is, or else if the
   original stands in at least as many distinct texts as the token does, or a verified word of the same chain in the document.
   Of two originals the more frequent one counts, of equally frequent ones the last in order.
3. A document is affected if a verified form of a word of three letters or more is in it (two different ones for the seven-bit
   encoding, whose letters are brackets in code, and half of all words with brackets; three windows for scripts without spaces), or a garbled form of
   punctuation, a replacement character beside a letter, or control characters of the range 80-9F.
4. Verified tokens are replaced by their originals; runs of scripts without spaces are read back by the matched encodings.
   What has lost its bytes (replacement characters) stays and is counted.

A single garbled letter, such as a quoted ``Ã¥``, is no evidence. Null, empty and blank texts are never affected.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread
from .common import chunks

SEVEN_BIT = str.maketrans("åäöÅÄÖéÉüÜ", "}{|][\\`@~^")
WRONG = ("cp1252", "latin_1", "cp437", "cp850", "mac_roman", "cp1250", "cp1251", "cp1253", "cp1257", "koi8_r", "cp866", "iso8859_2", "iso8859_7", "iso8859_5")
#: Encodings in which words of a script are written, beside UTF-8.
WRITTEN = {
    "LATIN": ("cp1252", "cp850", "mac_roman", "cp1250"),
    "CYRILLIC": ("cp1251", "koi8_r", "cp866", "iso8859_5", "mac_cyrillic"),
    "GREEK": ("cp1253", "iso8859_7", "cp737"),
    "ARABIC": ("cp1256", "iso8859_6"),
    "HEBREW": ("cp1255", "iso8859_8"),
    "THAI": ("tis_620",),
    "WIDE": ("shift_jis", "euc_jp", "gb18030", "big5"),
}
PUNCTUATION = "–—‘’“”„…•«»·°§©®™½\xa0"
_WIDE = re.compile(r"[぀-ヿ㐀-䶿一-鿿＀-￯、-〿]{2,}|[฀-๿]{4,}")
_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ҃-֑҇-ׇؐ-ًؚ-ٰٟऀ-ःऺ-़ा-ॏ])*")
_PLAIN = re.compile(r"[\x00-\x7fåäöÅÄÖéÉüÜ’”“–…«»­]*\Z")
_EDGE = " .,:;!?()\"'<>*/=-–—…“”’»«„_"


def read_wrong(data: bytes, encoding: str) -> str | None:
    """Bytes as text; bytes that the encoding leaves undefined come out as control characters where programs do so."""
    try:
        return data.decode(encoding)
    except UnicodeDecodeError:
        if encoding == "cp1252":
            return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in data)
        return None


def unread(text: str, encoding: str) -> bytes | None:
    """The inverse of ``read_wrong``."""
    try:
        return text.encode(encoding)
    except UnicodeEncodeError:
        if encoding != "cp1252":
            return None
        out = bytearray()
        for c in text:
            try:
                out += c.encode("cp1252")
            except UnicodeEncodeError:
                if ord(c) > 255:
                    return None
                out.append(ord(c))
        return bytes(out)


@lru_cache(maxsize=50_000)
def script(c: str) -> str:
    name = unicodedata.name(c, "")
    first = name.split(" ")[0]
    if first in ("CJK", "HIRAGANA", "KATAKANA", "IDEOGRAPHIC", "FULLWIDTH", "KATAKANA-HIRAGANA"):
        return "WIDE"
    return first


def garbled_forms(w: str) -> Iterator[tuple[str, str]]:
    """(garbled form, chain) of a word or window under all chains; a chain is written>read."""
    kinds = {script(c) for c in w if ord(c) > 127 and c.isalpha()}
    if len(kinds) != 1:
        return
    kind = kinds.pop()
    wide = kind in ("WIDE", "THAI")
    utf = w.encode()
    seen = {w}
    for d in WRONG[:2] if wide else WRONG:
        g = read_wrong(utf, d)
        if g and g not in seen:
            seen.add(g)
            yield g, f"utf_8>{d}"
            if d in ("cp1252", "latin_1") and not wide:
                twice = read_wrong(g.encode(), "cp1252")
                if twice and twice not in seen:
                    seen.add(twice)
                    yield twice, f"utf_8>{d}>utf_8>cp1252"
    for e in WRITTEN.get(kind, ()):
        try:
            data = w.encode(e)
        except UnicodeEncodeError:
            continue
        for d in WRONG[:2] if wide else WRONG:
            g = read_wrong(data, d)
            if g and g not in seen and not g.isascii():
                seen.add(g)
                yield g, f"{e}>{d}"
    if kind == "LATIN":
        g = w.translate(SEVEN_BIT)
        if g not in seen and g.isascii():
            yield g, "seven_bit"


_SHAPE = re.compile(r"[a-zß-öø-ÿа-яёα-ωά-ώ][A-ZÀ-ÖØ-ÞА-ЯЁΑ-Ω]")
_ACCENTED = re.compile(r"[À-ÖØ-öø-ɏ]{3}")


def no_word(g: str) -> bool:
    """Whether a token cannot be a word: case or scripts change inside it, or accented letters stand side by side."""
    return bool(_SHAPE.search(g) or _ACCENTED.search(g)) or len({script(c) for c in g if c.isalpha()}) > 1


def certainty(g: str, original: str) -> int:
    """Whether ``g`` is a garbled form of ``original``: 2 for sure, 1 if the original is more frequent, 0 if it is rather the other way."""
    if g.isascii():  # of the seven-bit encoding
        return 1 + (len(g) > 3)
    signs = any(not c.isalpha() and not unicodedata.combining(c) for c in g)
    if script(original[0]) in ("WIDE", "THAI"):
        return 1 + signs
    odd = signs or no_word(g)
    return int(odd) if no_word(original) else 1 + odd


@lru_cache(maxsize=1)
def punctuation_forms() -> re.Pattern[str]:
    """Garbled punctuation of three characters or more, or two that no text has side by side."""
    out = set()
    for p in PUNCTUATION:
        for d in ("cp1252", "latin_1", "cp437", "cp850", "mac_roman", "cp1251"):
            g = read_wrong(p.encode(), d)
            if g and (len(g) >= 3 or d in ("cp1252", "latin_1")):
                out.add(g)
                if d in ("cp1252", "latin_1"):
                    out.add(read_wrong(g.encode(), "cp1252"))
    return re.compile("|".join(re.escape(g) for g in sorted(out - {None}, key=len, reverse=True)))


_CONTROL = re.compile(r"[\x80-\x84\x86-\x9f]")
_LOST = re.compile(r"[^\W\d_]�|�[^\W\d_]")
_RUN = re.compile(r"[0-9A-Za-z@\[\\\]^_`{|}~\x80-\xffŒœŠšŽžŸƒˆ˜–—‘’‚“”„†‡•…‰‹›€™]+")


def clean_words(t: str) -> set[str]:
    """Words with letters beyond ASCII, and windows of scripts without spaces."""
    if t.isascii():
        return set()
    out = {w for w in _WORD.findall(t) if not w.isascii()}
    for run in _WIDE.findall(t):
        thai = "฀" <= run[0] <= "๿"
        k = 4 if thai else 2
        out.update(run[i : i + k] for i in range(len(run) - k + 1))
    return out


def suspicious_tokens(t: str) -> set[str]:
    """Tokens that may be garbled: what white space delimits, without marks at its ends, and windows of dense runs."""
    out = set()
    for tok in set(re.split(r"[ \t\r\n]+", t)):
        if not tok:
            continue
        if _PLAIN.match(tok):
            if not re.search(r"[{}|\[\]\\~^`@]", tok) or not re.search(r"[a-zA-Z]", tok):
                continue
            core = tok.strip(_EDGE)
            if re.fullmatch(r"[a-zA-Z{}|\[\]\\~^`@]{2,}", core) and not core.isalpha():
                out.add(core)
            continue
        core = tok.strip(_EDGE)
        out.update(x for x in {tok, core, *re.split(r"[-/]", core), tok.rstrip(".,:;!?)\"'"), tok.lstrip("(\"'")} if x and not x.isascii())
    for run in _RUN.findall(t):
        high = sum(c > "\x7f" for c in run)
        if high >= 4 and high * 5 >= len(run) * 2:
            for k in (4, 6, 12):
                out.update(run[i : i + k] for i in range(len(run) - k + 1) if run[i] > "\x7f")
    return out


_BRACKETED = re.compile(r"(?<!\S)[\"'(]?[a-zA-Z{}|\[\]\\~^`@]*[a-zA-Z][{}|\[\]\\~^`@][a-zA-Z{}|\[\]\\~^`@]*")


def evidence(t: str) -> tuple[int, int, int, int]:
    """Counts of garbled punctuation, of control characters, of lost letters and of different words with brackets."""
    brackets = len(set(_BRACKETED.findall(t))) if "{" in t or "|" in t or "}" in t else 0
    return len(punctuation_forms().findall(t)), len(_CONTROL.findall(t)), len(_LOST.findall(t)), brackets


def garbled_documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, words, windows, seven, marks, controls, lost, fixes) of the documents with any evidence; fixes are (token, original, chain)."""
    kind = dict(df.dtypes)[id_col]
    src = spread(df.filter(F.col(text_col).isNotNull()).selectExpr(f"`{id_col}` as i", f"`{text_col}` as t"))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c: Counter[str] = Counter()
        for b in chunks(it, "t"):
            for t in b.column(1).to_pylist():
                c.update(clean_words(t))
            if len(c) > 200_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["w", "n"])
                c = Counter()
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], names=["w", "n"])

    once = src.groupBy(F.xxhash64("t").alias("h")).agg(F.first("t").alias("t")).selectExpr("h as i", "t")  # copies count once
    words_ = once.mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n"))

    def forms(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = [(g, w, n, c, k > 1) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for g, c in garbled_forms(w) if (k := certainty(g, w))]
            cols = list(zip(*rows)) or [(), (), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["token", "original", "n", "chain", "sure"])

    table = words_.mapInArrow(forms, "token string, original string, n long, chain string, sure boolean")

    def look(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t"):
            row, tok = [], []
            for i, t in enumerate(b.column(1).to_pylist()):
                s = suspicious_tokens(t)
                row += [i] * len(s)
                tok += s
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(2).take(at), pa.array(tok, pa.string())], names=["i", "h", "token"])

    tokens = materialize(src.withColumn("h", F.xxhash64("t")).mapInArrow(look, f"i {kind}, h long, token string"), "tokens")
    seen = tokens.select("token", "h").distinct().groupBy("token").agg(F.count("*").alias("seen"))
    best = table.join(seen, "token").withColumn("ok", F.expr("sure or n >= seen")).groupBy("token").agg(F.max_by(F.struct("original", "chain", "ok"), F.struct("ok", "n", "original", "chain")).alias("o"))
    best = materialize(best.select("token", "o.*"), "verified")
    hits = tokens.drop("h").join(best, "token").groupBy("i").agg(F.collect_list(F.struct("token", "original", "chain", "ok")).alias("fixes"))
    # a match that is not verified by itself holds beside a verified word of the same chain
    held = "filter(fixes, x -> x.ok or exists(fixes, y -> y.ok and y.chain = x.chain and length(y.original) > 2))"
    hits = hits.select("i", F.expr(f"transform({held}, x -> named_struct('token', x.token, 'original', x.original, 'chain', x.chain))").alias("fixes")).filter("size(fixes) > 0")

    def mark(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t"):
            got = [(i, *e) for i, t in enumerate(b.column(1).to_pylist()) if any(e := evidence(t))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array([g[0] for g in got], pa.int64())), *(pa.array([g[k] for g in got], pa.int32()) for k in (1, 2, 3, 4))], names=["i", "marks", "controls", "lost", "brackets"]
            )

    marks = src.mapInArrow(mark, f"i {kind}, marks int, controls int, lost int, brackets int")
    both = hits.join(marks, "i", "full")
    wide = "x.original rlike '^[\\\\u0e00-\\\\u0e7f\\\\u3000-\\\\u9fff\\\\uff00-\\\\uffef]'"
    n = lambda cond: F.expr(f"coalesce(size(filter(fixes, x -> {cond})), 0)")
    return both.select(
        F.col("i").alias(id_col),
        n(f"not ({wide}) and x.chain <> 'seven_bit' and length(x.original) > 2").alias("words"),
        n(wide).alias("windows"),
        n("x.chain = 'seven_bit'").alias("seven"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("marks", "controls", "lost", "brackets")),
        "fixes",
    )


AFFECTED = "words > 0 or windows > 2 or (seven > 1 and seven * 2 >= brackets) or marks > 0 or controls > 0 or lost > 0"


def garbled_ids(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return garbled_documents(df, id_col, text_col).filter(AFFECTED).select(id_col)


def restore(t: str, fixes: list[tuple[str, str, str]]) -> tuple[str, int]:
    """The text with verified tokens replaced, and the number of replacements."""
    n = 0
    wide = Counter(c for _, o, c in fixes if script(o[0]) in ("WIDE", "THAI"))
    if sum(wide.values()) > 2:
        e, d = wide.most_common(1)[0][0].split(">")[:2]

        def back(m: re.Match[str]) -> str:
            nonlocal n
            run = m.group()
            if sum(c > "\x7f" for c in run) < 2:
                return run
            data = unread(run, d)
            try:
                out = data.decode(e) if data else run
            except UnicodeDecodeError:
                return run
            n += out != run
            return out

        t = re.sub(r"[^\s]*[\x80-\xff‚ƒ„…†‡ˆ‰Š‹Œ‘’“”•–—˜™š›œžŸ€Ž][^\s]*", back, t)
    plain = {g: o for g, o, c in fixes if script(o[0]) not in ("WIDE", "THAI")}
    if plain:
        edge = rf"[^\s{re.escape(_EDGE)}]"
        rx = re.compile(rf"(?<!{edge})(?:{'|'.join(re.escape(g) for g in sorted(plain, key=len, reverse=True))})(?!{edge})")
        t, k = rx.subn(lambda m: plain[m.group()], t)
        n += k

    def mark(m: re.Match[str]) -> str:
        nonlocal n
        s = m.group()
        for _ in range(2):
            for d in ("cp1252", "latin_1", "mac_roman", "cp437", "cp850", "cp1251"):
                data = unread(s, d)
                try:
                    out = data.decode() if data else None
                except UnicodeDecodeError:
                    continue
                if out and len(out) < len(s):
                    s = out
                    break
        n += s != m.group()
        return s

    return punctuation_forms().sub(mark, t), n


def restored(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, restored text, replaced, lost) of each affected document."""
    kind = dict(df.dtypes)[id_col]
    hit = garbled_documents(df, id_col, text_col).filter(AFFECTED).select(F.col(id_col).alias("i"), "lost", "fixes")
    src = df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t").join(hit, "i")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t"):
            out = [restore(t, [(f["token"], f["original"], f["chain"]) for f in fx or []]) for t, fx in zip(b.column(1).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32()), b.column(2)], names=[id_col, "restored", "replaced", "lost"])

    return src.select("i", "t", "lost", "fixes").mapInArrow(run, f"`{id_col}` {kind}, restored string, replaced int, lost int")
