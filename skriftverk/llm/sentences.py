"""Problem 10: sentence units in many languages and scripts, by a compiled finite transducer.

Lexical rules cut a text into tokens of about thirty classes (words by case, abbreviations, ordinals, numbers, web names,
terminals by script, quotes, brackets, breaks). The boundary rules are written as one step function over (phase, quote,
bracket) and token class; ``compile_rules`` walks all reachable states and gives two tables, the next state and whether a
unit starts. Long token streams are cut into chunks; each chunk is first run from every state at once, which makes it a
function from states to states; a parallel prefix scan composes these functions, so each chunk's entry state is known,
and all chunks are then run at the same time. The result does not depend on the chunk length.

Null, empty and blank texts have no unit. Positions are code points of the stored text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..session import spread
from .common import chunks

#: Abbreviations (without the last dot) that do not end a sentence.
ABBREVIATIONS = """
enl fr.o.m t.o.m fr.o.m. f.d s.k t.ex d.v.s dvs bl.a m.a.o p.g.a i.s.f e.d f.n f.ö o.d resp ang avd bif bil ca cirka exkl
f.kr e.kr fig forts från hr fr frk dr prof doc ing inkl jfr kap kl kv milj mdr mkt motsv nr obs omkr sid red ref s t.v u.a
uppl ung vol årg äv tel st ev ex exv förf gm gn h.k.h i.e e.g mr mrs ms jr sr vs approx sec ch no pp p eds vgl bzw z.b
d.h u.a ggf evtl etw sog str frau herr abs art st bsp max min nr n esim mm ts ks eli so noin huom f.eks bl.a dvs osv.a
m.fl.a ca pga mme mlle m ex p.ex c.-à-d cf env éd sra sr dra exmo pág п т.е т.к т.н г ул им см проф акад руб тыс млн
κ π.χ δηλ κ.λπ.α αρ σελ napr t.j č s.r.o tzv atď.a د डॉ श्री प्रो jan feb mar apr jun jul aug sept sep okt nov dec
""".split()
#: The same for such as do end a sentence when a capital follows.
AT_END = "m.m m.fl p.m a.m st u.s.a d.c bc ad kr".split()
#: The same for such as end a list, and with it the sentence.
LIST_END = "osv etc usw jne o.s.v".split()
#: What follows an ordinal that is written with a dot.
AFTER_ORDINAL = """kerta kerran vuosi päivä luokka kerros Jahrhundert Jahrhunderts Mal Tag Klasse Stock Geburtstag Januar Februar März April Mai Juni
Juli August September Oktober November Dezember januar februar mars april mai juni juli august september oktober november desember gang plass
etasje klasse århundre klassen gangen dag tammikuuta helmikuuta maaliskuuta huhtikuuta toukokuuta kesäkuuta heinäkuuta elokuuta syyskuuta
lokakuuta marraskuuta joulukuuta januára februára marca apríla mája júna júla augusta septembra októbra novembra decembra""".split()

CLASSES = "WORD LOWER NUM ABBR ABBR_U LISTEND DOT ASK ELL ELLIN WIDE OPENQ CLOSEQ OPENB CLOSEB DASH SPACE HARD QUOTATIVE OTHER THSPACE".split()
C = {c: i for i, c in enumerate(CLASSES)}


def _alternatives(words: list[str]) -> str:
    return "|".join(re.escape(w).replace(r"\.", r"\.[  ]?") for w in sorted(set(words), key=len, reverse=True))


@lru_cache(maxsize=1)
def _lexer() -> re.Pattern[str]:
    return re.compile(
        rf"""
    (?P<THSPACE>(?<=[฀-๿])[  ]+(?=[฀-๿]))
    |(?P<HARD>\x00+)
    |(?P<SPACE>[\s​﻿]+)
    |(?P<LISTEND>(?<![\w.])(?i:{_alternatives(LIST_END)})\.(?!\w))
    |(?P<ABBR_U>(?<![\w.])(?i:{_alternatives(AT_END)})\.(?!\w))
    |(?P<ABBR>(?<![\w.])(?i:{_alternatives(ABBREVIATIONS)})\.(?!\w)|(?<![\w.])[A-ZÅÄÖÉØÆ]\.(?=[\s ]*[A-ZÅÄÖÉØÆ]))
    |(?P<WEB>(?<!\w)(?:https?://[^\s<>"”»]*[\w/]|[\w.+-]+@[\w-]+(?:\.[\w-]+)+|(?:[a-z0-9-]+\.)+[a-z]{{2,}}(?:/[\w./-]*[\w/])?(?!\w)))
    |(?P<ORD>(?<![\w.,])\d{{1,3}}\.(?=\s(?:{'|'.join(AFTER_ORDINAL)})\b))
    |(?P<NUM>\d+(?:[.,:/-]\d+)*)
    |(?P<ELLIN>(?<=[\s ])(?:…|\.\.\.+)(?=[\s ]))
    |(?P<ELL>…|\.\.+)
    |(?P<WIDE>[。！？｡]+)
    |(?P<ASK>[?!؟‽⁈⁉]+|(?<=[Ͱ-Ͽἀ-῿]);(?!\w))
    |(?P<DOT>[.।॥۔።፧॰]+)
    |(?P<OPENQ>[“„«「『‘‹](?=\w|\W)(?<![\w.?!…]“)|[”"»'’](?<![^\s\x00(\[–—-].)(?=[^\s\x00]))
    |(?P<CLOSEQ>[”"»“»」』’›«'])
    |(?P<OPENB>[(\[（](?=\S))
    |(?P<CLOSEB>[)\]）])
    |(?P<DASH>[–—―]|-(?=\s))
    |(?P<QUOTATIVE>(?<=[」』])[とっなに])
    |(?P<WORD>[^\W\d_](?:[\ẁ-ͯ­'’-]*\w)?)
    |(?P<OTHER>.)
    """,
        re.X | re.S,
    )


_FOLD = {"WEB": C["WORD"], "ORD": C["NUM"]}
_CLASS_OF = {k: C.get(k, _FOLD.get(k)) for k in [*CLASSES, *_FOLD]}
_BREAK = re.compile(r"[ \t ​]*(?:\r\n|[\n\r\x0b\x0c\x85  ])[\s​]*")
_EOL = re.compile(r"\r\n|[\n\r\x0b\x0c\x85  ]")
_ENDS = re.compile(r"[.!?…。！？।۔።؟:;]['\"”»“’)\]」』]*$")


_FIRST = re.compile(r"\S*")


def wrap_width(lines: list[tuple[int, int]]) -> int:
    """The width to which a text is wrapped, 0 if it isn't. ``lines``: length of each line, and of its first word.

    A line is full for a width if the next line's first word would not have fitted, give or take two characters. Of all the lengths
    that occur, the width is the greatest for which nearly as many lines are full as for any; lines beyond it (a table row, an
    address) do not change it. A text counts as wrapped if its full lines are a quarter of all or more, and lines of that width or
    less hold half of it.
    """
    if len(lines) < 2:
        return 0
    size = np.array([n for n, _ in lines])
    need = size[:-1] + 3 + np.array([w for _, w in lines[1:]])  # a line is full for widths from its length to below this
    widths = np.unique(size)
    starts, ends = np.searchsorted(widths, size[:-1]), np.searchsorted(widths, need)
    full = np.cumsum(np.bincount(starts, minlength=len(widths) + 1) - np.bincount(ends, minlength=len(widths) + 1))[:-1]
    most = int(full.max())
    best = int(np.flatnonzero(full >= 0.6 * most)[-1])
    within = size[size <= widths[best]].sum() * 2 >= size.sum()
    return int(widths[best]) if most >= max(1, len(lines) / 4) and within else 0


def marked_breaks(text: str) -> str:
    """The text with each paragraph end replaced by NULs; line breaks inside sentences stay white space."""
    text = text.replace("\x00", " ")
    breaks = list(_BREAK.finditer(text))
    if not breaks:
        return text
    lines = [x for x in _EOL.split(text) if x.strip()]
    width = wrap_width([(len(x.rstrip()), len(_FIRST.match(x.lstrip()).group())) for x in lines])
    cased = any(x[0] != x[0].lower() for x in lines)
    out, at, begun = [], 0, 0
    for m in breaks:
        out.append(text[at : m.start()])
        line = text[begun : m.start()].strip()
        at = begun = m.end()
        first = _FIRST.match(text, at).group()
        soft = len(_EOL.findall(m.group())) < 2 and line and first
        if soft:
            if _ENDS.search(line) and not line.endswith(":"):
                soft = True  # ended or an abbreviation: the transducer decides
            elif width and width >= len(line) > width - 3 - len(first):
                soft = True
            else:
                soft = first[0].islower() and cased and not width
        out.append((" " if soft else "\x00") * (m.end() - m.start()))
    out.append(text[at:])
    return "".join(out)


def tokenize(text: str) -> tuple[list[int], list[int]]:
    """Token classes and positions."""
    kinds, at = [], []
    for m in _lexer().finditer(marked_breaks(text)):
        c = _CLASS_OF[m.lastgroup]
        if c == C["WORD"] and m.group()[0].islower():
            c = C["LOWER"]
        kinds.append(c)
        at.append(m.start())
    return kinds, at


def step(state: tuple[str, str, str], c: str) -> tuple[tuple[str, str, str], bool]:
    """One boundary rule per line: (phase, quote, bracket) and a token class give the next state and whether a unit starts."""
    phase, q, b = state
    if c == "HARD":
        return ("start", "-", "-"), False
    if c == "SPACE":
        return (phase if phase in ("start", "in") or phase.endswith("_") else phase + "_", q, b), False
    if c == "THSPACE":
        return ("dot_", q, b), False
    closing = phase in ("dot", "ask", "wide", "dotq", "askq", "wideq", "wideq0", "up")
    if c == "CLOSEQ" and closing:
        kind = {"dotq": "dot", "askq": "ask", "wideq": "wide", "wideq0": "wide"}.get(phase, phase)
        return ((kind + "q" + ("0" if kind == "wide" and q == "first" else "")) if kind in ("dot", "ask", "wide") else kind, "-", b), False
    if c == "CLOSEB" and closing:
        return (phase if b == "first" else "in", q, "-"), False
    starts = False
    if phase in ("start", "dot_", "ask_", "dotq_", "wide_", "wideq_"):
        starts = True
    elif phase == "askq_":
        starts = c not in ("LOWER", "DASH", "OTHER")
    elif phase == "up_":
        starts = c in ("WORD", "OPENQ", "OPENB", "DASH")
    elif phase == "wideq":
        starts = c != "QUOTATIVE"
    elif phase == "wide":
        starts = c not in ("WIDE", "ASK", "ELL")
    if starts and c in ("CLOSEQ", "CLOSEB", "DOT", "ASK", "ELL") and phase != "start":
        starts = False  # stray marks stay with the unit before them
        return ((phase.rstrip("_")), q, b), False
    fresh = starts
    if c == "OPENQ":
        q = "first" if fresh else "mid"
    elif c == "CLOSEQ":
        q = "-"
    elif c == "OPENB":
        b = "first" if fresh else "mid"
    elif c == "CLOSEB":
        b = "-"
    if b == "mid" and c in ("DOT", "ASK", "ELL", "WIDE", "LISTEND"):
        return ("in", q, b), starts
    after = {"DOT": "dot", "LISTEND": "dot", "ELL": "dot", "ASK": "ask", "WIDE": "wide", "ABBR_U": "up"}.get(c, "in")
    return (after, q, b), starts


@lru_cache(maxsize=1)
def compile_rules() -> tuple[np.ndarray, np.ndarray]:
    """(next state, unit starts) by state and class; state 0 is the start."""
    number = {("start", "-", "-"): 0}
    todo, rows = [("start", "-", "-")], []
    while todo:
        s = todo.pop(0)
        row = []
        for c in CLASSES:
            t, starts = step(s, c)
            if t not in number:
                number[t] = len(number)
                todo.append(t)
            row.append((number[t], starts))
        rows.append(row)
    a = np.array(rows)
    return a[:, :, 0].astype(np.int16), a[:, :, 1].astype(bool)


def transduce(kinds: np.ndarray, first: np.ndarray, chunk: int = 256) -> np.ndarray:
    """Whether a unit starts at each token; ``first`` marks tokens at which a document starts.

    Chunks as functions of the state, composed by a prefix scan, then all chunks in lockstep from their entry states.
    """
    nxt, out = compile_rules()
    reset = len(CLASSES)  # a document start: back to state 0, then as usual
    nxt = np.hstack([nxt, nxt[:1].repeat(len(nxt), 0)])
    out = np.hstack([out, out[:1].repeat(len(out), 0)])
    n = len(kinds)
    sym = np.where(first, kinds + reset, kinds).astype(np.int64)
    rows = -(-n // chunk)
    pad = np.full(rows * chunk - n, C["SPACE"])
    sym = np.r_[sym, pad].reshape(rows, chunk)
    s = len(nxt)
    maps = np.tile(np.arange(s, dtype=np.int16), (rows, 1))
    for j in range(chunk):
        maps = nxt[maps, sym[:, j, None]]
    scan, gap = maps.copy(), 1  # inclusive scan: scan[i] = maps[i] o ... o maps[0]
    while gap < rows:
        later = np.take_along_axis(scan[gap:], scan[:-gap].astype(np.int64), axis=1)
        scan[gap:] = later
        gap *= 2
    state = np.r_[np.int16(0), scan[:-1, 0]]
    got = np.empty((rows, chunk), bool)
    for j in range(chunk):
        got[:, j] = out[state, sym[:, j]]
        state = nxt[state, sym[:, j]]
    return got.reshape(-1)[:n]


def unit_starts(texts: list[str | None], chunk: int = 256) -> list[list[int]]:
    kinds, at, doc, first = [], [], [], []
    for d, t in enumerate(texts):
        if t and not t.isspace():
            k, a = tokenize(t)
            first += [len(kinds)]
            kinds += k
            at += a
            doc += [d] * len(k)
    res: list[list[int]] = [[] for _ in texts]
    if kinds:
        mark = np.zeros(len(kinds), bool)
        mark[first] = True
        for i in np.flatnonzero(transduce(np.array(kinds), mark, chunk)):
            res[doc[i]].append(at[i])
    return res


def sentence_units(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start_pos, sentence) of every unit of every row; a narrow stage."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t", 1_000_000):
            texts = b.column(1).to_pylist()
            found = unit_starts(texts)
            row = [i for i, f in enumerate(found) for _ in f]
            pos = [p for f in found for p in f]
            unit = [texts[i][p:q].rstrip() for i, f in enumerate(found) for p, q in zip(f, [*f[1:], None])]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(pos, pa.int32()), pa.array(unit, pa.string())], names=[id_col, "start_pos", "sentence"])

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, start_pos int, sentence string")
