"""Problem 7: per-document text statistics, and text types from them.

Thresholds on the statistics are noisy labelling functions: each votes for prose, list, table or junk, against prose, or
not at all. Their accuracies are learned by expectation-maximisation on agreements: votes are counted over all documents
(a distributed count of vote patterns, of which there is a bounded number), the model is fitted on the counts, and each
document gets the posterior of its pattern. No labels are used.

Documents of fewer than five words, null and blank ones have statistics but no type.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, spread
from .common import chunks, words

TYPES = ("prose", "list", "table", "junk")
#: Function words by language (fixed values).
FUNCTION_WORDS = {
    "sv": "och i att det som en ett på är av för med till den har de inte om man vid så jag vi hon han eller men när enligt var ingen vet länge haft än trots vad vem varför under efter utan mellan från över innan medan eftersom därför fast strax utanför bakom så att alla några nästan sig sin där här detta denna dem deras hans hennes år mer",
    "en": "the of and was that to in is a an it for on with as at by this but not from or were are be had have which their they because despite we our my when where how why before after into than then there without during nobody somebody if",
    "no": "og i at det som en et på er av for med til den har de ikke om man ved så jeg vi hun han eller men når ingen hvorfor under etter uten mellom fra over før mens fordi ble var sier litt noen",
    "de": "der die das und nicht den dem des ein eine einen einer im in am an auf mit von zu war ist es so wir sie er aber weil vor nach bei während ohne hinter ins trotz zum zur nahe niemand mehr sich dass wie",
    "fi": "ja kun koska ne se on ei oli vaikka joka että jälkeen ennen aikana aikaisin lähellä varrella takana avulla huolimatta varoittamatta sanoo uusi vanha pieni klo jäivät",
    "fr": "le la les de du des un une et est qui que dans en au aux il elle nous notre sur avant après sans par pour mais ne pas c l d à près ce derrière malgré parce dit",
    "pt": "o a os as de do da dos das um uma e que não em no na mas foi à ao com por para sim nossa nosso amanhã",
    "sk": "a na v pri po bez ale nie ktorý že je do z o s naša napriek dlhej jar noci",
    "xx": "y el los las un una por con para che il di i lo non och",
}
_FUNCTION = frozenset(w for v in FUNCTION_WORDS.values() for w in v.split())
_END = re.compile(r"[.!?…。！？।۔።؟]+[\"'”»“’)\]」』]*(?=\s|$|[぀-鿿])|[。！？]|(?<=[Ͱ-Ͽ]);")
_VOWELS = frozenset("aeiouyåäöéèêëàáâãæøœüúùûíìîïóòôõýě")
_CODE = re.compile(r"https?://\S+|\b0x[0-9a-fA-F]+|[{}]|\b\w+\(\w*\)|=>|&&|\|\||;\s*$|\b(?:var|function|return|INFO|WARN|ERROR|DEBUG)\b|\d\d:\d\d:\d\d|</?\w+>|\b\w+=\S+", re.M)
_NAMES = ["words", "mean_word_length", "function_share", "symbol_ratio", "digit_tokens", "vowel_share", "line_end_share", "words_per_line", "words_per_segment", "delimited_lines", "ends_per_word", "code_share", "long_tokens", "inner_symbols", "other_script", "short_lines", "letter_score", "lines", "bare_symbols", "repeat_share", "capital_items", "broken_words", "foreign_bytes"]




def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code below 0x250: letters, vowels, and pairs of letters that stand side by side in function words and usual endings."""
    letter, vowel = np.zeros(0x251, bool), np.zeros(0x251, bool)
    pair = np.zeros((0x251, 0x251), bool)
    for i in range(0x250):
        letter[i] = chr(i).isalpha()
        vowel[i] = chr(i) in _VOWELS
    text = " ".join(FUNCTION_WORDS.values()) + " ningen heten are ande ade erna orna arna skap lig isk else tion"
    for w in text.split():
        for x, y in zip(w, w[1:]):
            pair[ord(x), ord(y)] = True
    return letter, vowel, pair


_IS_LETTER, _IS_VOWEL, _IS_PAIR = _tables()
_CLOSED = re.compile(r"[.!?…:。！？।۔።؟;][\"'”»“’)\]」』]*\s*$")
_INNER = re.compile(r"(?<!\S)\S*?(?:\w[^\w\s,'’.:;/-]\w|\w[;:.,][a-zåäö])\S*")
_BARE = re.compile(r"(?<!\S)[^\w\s]+(?!\S)")
_MARKS = frozenset("– - — & | ... … ▪ • » *".split())
_DIGITS = re.compile(r"(?<!\S)[^\s\d]*\d\S*")
_BROKEN = re.compile(r"(?<!\S)\S*?[a-zA-ZåäöÅÄÖ](?:[´`~;1:]|[.,'|-](?=\S*[´`~;1:|]))[a-zåäöI]\S*")
_ENTITY = re.compile(r"&#?\w{2,8};")
_FOREIGN = re.compile(r"[\x80-\x84\x86-\x9f¡-£¥-¦ª¬\xad¯±-´¶¸-º¼-ÃÆ-ÈÊ-ÕØ-Ûà-ãæ-èê-õø-ûý-ÿŒœŠšŽžŸƒˆ˜‚„†‡‰‹›€™]")
_LONG = re.compile(r"\S{26,}")
_LINE = re.compile(r"[\r\n\u2028\u2029\x85]+")
_BREAK = re.compile(r"[\r\n]+")  # of texts that were read wrongly, in which \x85 is a byte of a letter
_SEGMENT = re.compile(r"[\r\n,;|\t•▪»*]+|[.!?…:](?=\s)")
_DELIMITER = re.compile(r"[|;\t]|\s{3,}")
_TWO_NUMBERS = re.compile(r"\d\S*\s.*\d")


def _marks() -> re.Pattern[str]:
    """Combining marks, which many scripts have inside words."""
    at = [c for c in range(0x300, 0x10000) if unicodedata.category(chr(c))[0] == "M"]
    first = [c for c, before in zip(at, [0, *at]) if c != before + 1]
    last = [c for c, after in zip(at, [*at[1:], 0]) if c != after - 1]
    return re.compile("[" + "".join(f"{chr(a)}-{chr(z)}" for a, z in zip(first, last)) + "]+")


_MARK = _marks()
_IDEOGRAPHS, _LINKED = "\u3005-\u3007\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f", "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff"
_PAIR = re.compile(f"[{_IDEOGRAPHS}]{{2}}(?=[{_IDEOGRAPHS}])|[{_LINKED}]{{4}}(?=[{_LINKED}])|[{_IDEOGRAPHS}{_LINKED}](?=[0-9A-Za-z])|[0-9A-Za-z](?=[{_IDEOGRAPHS}{_LINKED}])")
_STOP = re.compile(r"([。！？।॥۔؟።])([\"'”»“’)\]」』】》]*)")
_STOPS = dict(zip("。！？।॥۔؟።", ".!?...?."))
_FULL = {i: i - 0xFEE0 for i in range(0xFF01, 0xFF5F)} | {ord(x): y for x, y in zip("、،؛፣፤「『【《〈（」』】》〉）", [", ", ", ", "; ", ", ", "; "] + [' "'] * 6 + ['" '] * 6)} | {ord(x): x2 for x, x2 in zip("，；：", (", ", "; ", ": "))} | {0x30FB: " "}


def like_latin(t: str) -> str:
    """The text for statistics of its structure: without combining marks, scripts without spaces in pieces of about a word
    (two characters, four in Thai and its relatives), punctuation as Latin script has it."""
    t = _STOP.sub(lambda m: _STOPS[m[1]] + m[2].translate(_FULL).rstrip() + " ", t).translate(_FULL)
    return _PAIR.sub(r"\g<0> ", _MARK.sub("", t))


def statistics(t: str | None) -> list[float]:
    if not t or t.isspace():
        return [0.0] * len(_NAMES)
    ws = words(t)
    length = sum(map(len, ws))
    code = np.minimum(np.frombuffer(t.lower().encode("utf-32-le", "replace"), np.uint32), 0x250)
    letter = _IS_LETTER[code]
    latin = int(letter.sum())
    letters = length - sum(not c.isalpha() for w in ws if not w.isalpha() for c in w)
    other = 1 - min(1.0, latin / letters) if letters else 0.0
    count, own = len(ws), ws
    if other >= 0.5:
        t = like_latin(t)
        own = words(t)
        length = sum(map(len, own))
    n = max(len(own), 1)
    k = max(len(t.split()), 1)
    chars = sum(map(len, t.split())) or 1
    both = letter[:-1] & letter[1:]
    pairs = int(both.sum()) if latin > 20 else 0
    good = float(_IS_PAIR[code[:-1][both], code[1:][both]].mean()) if pairs else 1.0
    foreign = len(_FOREIGN.findall(t)) / chars
    lines = [x for x in (_LINE if foreign < 0.25 else _BREAK).split(t) if x.strip()] or [""]
    per_line = sorted(len(x.split()) for x in lines)
    segs = [s for s in _SEGMENT.split(t) if s.strip()] or [""]
    delim = sum(len(_DELIMITER.findall(x.strip())) >= 2 or (len(x) < 120 and len(x.split()) <= 8 and bool(_TWO_NUMBERS.search(x))) for x in lines)
    return [
        float(count), sum(map(len, ws)) / max(count, 1), sum(map(_FUNCTION.__contains__, ws)) / max(count, 1), 1 - length / chars, len(_DIGITS.findall(t)) / k,
        int(_IS_VOWEL[code].sum()) / max(latin, 1), sum(bool(_CLOSED.search(x[-12:])) for x in lines) / len(lines), float(per_line[len(lines) // 2]),
        sum(len(s.split()) for s in segs) / len(segs), delim / len(lines), len(_END.findall(t)) / n, sum(map(len, _CODE.findall(t))) / chars, len(_LONG.findall(t)) / k,
        len(_INNER.findall(t)) / k, other, sum(p <= 5 for p in per_line) / len(lines), good, float(len(lines)),
        sum(x not in _MARKS for x in _BARE.findall(t)) / k, 1 - len(set(lines)) / len(lines), sum(s.strip()[:1].isupper() and len(s) < 40 and len(s.split()) <= 3 for s in segs) / len(segs),
        len(_BROKEN.findall(_ENTITY.sub("a", t))) / k, foreign,
    ]


P, L, T, J, N, OFF = 1, 2, 3, 4, 5, 6  # votes; N: not prose; 0: none; OFF: the function cannot judge such a text, which is no evidence
_OF_LATIN, _OF_WORDS = [0, 1, 8, 9, 12, 13, 14], [0, 1, 2, 3, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16]  # functions by what they need


def votes(s: np.ndarray, known: np.ndarray) -> np.ndarray:
    """(documents, functions) votes from statistics (documents, names); ``known``: -1 other page, 0 none, 1 article or post."""
    c = {name: s[:, i] for i, name in enumerate(_NAMES)}
    right = c["foreign_bytes"] < 0.25  # else read wrongly: lines and delimiters are as they were, words and marks are not
    roman = right & (c["other_script"] < 0.5)  # else another script: no function words, vowels and letter pairs
    other = right & ~roman
    w = np.where
    short = (c["lines"] >= 5) & (c["short_lines"] > 0.8)
    delimited = (c["delimited_lines"] > 0.6) & (c["lines"] >= 3) & (~roman | (c["function_share"] < 0.12))
    flowing = ~right & ~short & ~delimited
    out = [
        w(flowing | roman & (c["function_share"] >= 0.2), P, w(roman & (c["function_share"] < 0.07), N, 0)),
        w(flowing & (c["digit_tokens"] < 0.7) | roman & (c["function_share"] >= 0.12), P, w(roman & (c["inner_symbols"] < 0.15), N, 0)),
        w(flowing | right & (c["ends_per_word"] > 1 / 45) & (c["ends_per_word"] < 1 / 3), P, w(right & (c["ends_per_word"] == 0) & (c["words"] > 12), N, 0)),
        w(flowing | right & (c["words_per_segment"] >= 5.5), P, w(right & (c["words_per_segment"] < 3.2), L, 0)),
        w(short, w((c["digit_tokens"] > 0.4) | ~roman & delimited, T, L), w(flowing | (c["words_per_line"] >= 9), P, 0)),
        w(delimited, T, 0),
        w(right & (c["digit_tokens"] > 0.42), T, 0),
        w(right & (c["symbol_ratio"] > 0.3), J, w(flowing | right & (c["symbol_ratio"] < 0.07) & (c["digit_tokens"] < 0.1), P, 0)),
        w(roman & ((c["vowel_share"] < 0.27) | (c["vowel_share"] > 0.62)) & (c["letter_score"] < 0.65), J, 0),
        w(roman & (c["letter_score"] < 0.5), J, 0),
        w(right & (c["code_share"] > 0.15), J, 0),
        w(right & (c["long_tokens"] > 0.3), J, 0),
        w(roman & (c["broken_words"] > 0.12) & (c["code_share"] < 0.1), J, 0),
        w(roman & (c["broken_words"] > 0.14) & (c["code_share"] < 0.1) & (c["function_share"] < 0.3), J, 0),
        w(roman & (c["inner_symbols"] > 0.2) & (c["broken_words"] < 0.08) & (c["code_share"] < 0.1) & (c["long_tokens"] < 0.1) & (c["words_per_line"] >= 4) & (c["letter_score"] > 0.55) & (c["bare_symbols"] < 0.3) & (c["digit_tokens"] < 0.35), P, 0),
        w(right & (c["bare_symbols"] > 0.3), J, w(other & (c["repeat_share"] > 0.6) & (c["lines"] >= 5), J, 0)),
        w((roman & (c["function_share"] < 0.1) | other & (c["ends_per_word"] < 1 / 45)) & (c["words_per_segment"] < 4.5) & (c["inner_symbols"] < 0.15), L, 0),
        w(known < 0, N, w(known > 0, P, 0)),
    ]
    v = np.stack(out, axis=1).astype(np.int8)
    v[np.ix_(other, _OF_LATIN)] = OFF
    v[np.ix_(~right & ~flowing, _OF_WORDS)] = OFF
    return v


def likelihood(acc: np.ndarray) -> np.ndarray:
    return np.c_[np.log(np.clip(acc, 1e-6, 1)), np.zeros(len(acc))]  # by vote; OFF says nothing


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """(prior by type, probability of each vote by function and type), by expectation-maximisation from a mild start."""
    m, f = patterns.shape
    acc = np.full((f, len(TYPES), 6), 0.08)
    for y in range(len(TYPES)):
        acc[:, y, y + 1] = 0.5
        acc[:, y, N] = 0.02 if y == 0 else 0.3
        acc[:, y, 0] = 0.3
    acc /= acc.sum(axis=2, keepdims=True)
    start = acc.copy()
    prior = np.array([0.85, 0.05, 0.05, 0.05])
    for _ in range(rounds):
        logp = np.log(prior) + sum(likelihood(acc[j])[:, patterns[:, j]].T for j in range(f))
        logp -= logp.max(axis=1, keepdims=True)
        q = np.exp(logp)
        q *= (counts / q.sum(axis=1))[:, None]
        prior = (q.sum(axis=0) + 1) / (counts.sum() + len(TYPES))
        weight = 0.02 * counts.sum() / len(TYPES) + 2  # pseudo-counts keep the meaning of the types
        for j in range(f):
            c = np.stack([q[patterns[:, j] == v].sum(axis=0) for v in range(6)], axis=1)
            acc[j] = (c + weight * start[j]) / (c.sum(axis=1, keepdims=True) + weight)
    return prior, acc


def posterior(patterns: np.ndarray, prior: np.ndarray, acc: np.ndarray) -> np.ndarray:
    logp = np.log(prior) + sum(likelihood(acc[j])[:, patterns[:, j]].T for j in range(patterns.shape[1]))
    q = np.exp(logp - logp.max(axis=1, keepdims=True))
    return q / q.sum(axis=1, keepdims=True)


def _known(classes: list[str | None]) -> np.ndarray:
    return np.array([0 if c is None else -1 if c.strip().lower() in ("unknown", "") else 1 for c in classes])


def text_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str = "document_class") -> DataFrame:
    """(id, the statistics, votes) of every row; a narrow stage."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t", 2_000_000):
            s = np.array([statistics(t) for t in b.column(1).to_pylist()])
            v = votes(s, _known(b.column(2).to_pylist()))
            text = pa.array(["".join(map(str, x)) for x in v], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(s[:, i]) for i in range(len(_NAMES))), text], names=[id_col, *_NAMES, "votes"])

    src = spread(df.select(F.col(id_col), F.col(text_col).alias("t"), F.col(class_col).alias("c")))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, {', '.join(f'{n} double' for n in _NAMES)}, votes string")


def text_types(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str = "document_class", least_words: int = 5) -> DataFrame:
    """(id, type, prose probability) of the documents of ``least_words`` words or more."""
    stats = text_statistics(df, id_col, text_col, class_col).filter(F.col("words") >= least_words)
    stats = materialize(stats.select(id_col, "votes"), "votes")  # the texts are read once
    counted = stats.groupBy("votes").count().collect()  # vote patterns: bounded by the labelling functions, not by the data
    if not counted:
        return stats.select(id_col, F.lit("prose").alias("type"), F.lit(1.0).alias("prose"))
    pats = np.array([[int(x) for x in r[0]] for r in counted])
    prior, acc = fit(pats, np.array([r[1] for r in counted], float))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            if b.num_rows:
                p = posterior(np.array([[int(x) for x in v] for v in b.column(1).to_pylist()]), prior, acc)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([TYPES[i] for i in p.argmax(axis=1)]), pa.array(p[:, 0])], names=[id_col, "type", "prose"])

    return stats.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, type string, prose double")


def not_prose(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", class_col: str = "document_class", least_words: int = 5) -> DataFrame:
    return text_types(df, id_col, text_col, class_col, least_words).filter("prose < 0.5").select(id_col)
