"""Problem 2: the main body of web pages, by a linear-chain conditional random field over leaf blocks.

A page's visible text has one block a line. Lines are aligned, in order, with the leaf blocks of its HTML, which give
ancestor tags, class words and link coverage; a page without HTML, or with HTML cut off, has the text features of its
lines alone. The states of the chain are ``before``, ``body``, ``inside`` (boilerplate between parts of the body) and
``after``. The weights are trained on labelled pages (HTML and the main text by hand), each also without its HTML, by
gradient steps on the exact log-likelihood; pages are decoded by Viterbi, many pages at a time.

The training set is the labelled table, of which ``max_labelled`` rows are used at most; everything else covers all pages. Null, empty and
blank texts have no line. Blank lines are never returned.
"""

from __future__ import annotations

import difflib
import html as html_lib
import re
import zlib
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .common import chunks

STATES = ("before", "body", "inside", "after")
BODY = 1
HASHED = 1 << 14
_TAG = re.compile(r"<(?:!--.*?-->|(script|style|noscript|title|template|svg)\b[^>]*>.*?</\1\s*>|(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|[!?/][^>]*>)", re.S | re.I)
_ATTR = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
INLINE = frozenset("a b i em strong span font u s small big sub sup abbr acronym cite code q time mark tt label kbd var samp ins del".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
_SPACE = re.compile(r"[\s\xa0​]+")


def leaf_blocks(page: str | None) -> list[tuple[str, str, str, float]]:
    """(text, tags of the two nearest blocks, words of class and id around it, share of it in links)."""
    if not page:
        return []
    out: list[tuple[str, str, str, float]] = []
    stack: list[tuple[str, str]] = []
    opened: Counter[str] = Counter()
    buf: list[str] = []
    linked = total = 0
    link = 0
    at = 0

    def flush() -> None:
        nonlocal linked, total
        if buf:
            text = _SPACE.sub(" ", html_lib.unescape("".join(buf))).strip()
            if text:
                tags = [t for t, _ in stack if t not in INLINE][-2:]
                out.append((text, ">".join(tags), " ".join(c for _, c in stack[-4:] if c), linked / max(total, 1)))
            buf.clear()
        linked = total = 0

    for m in _TAG.finditer(page):
        if m.start() > at:
            s = page[at : m.start()]
            buf.append(s)
            k = len(s.strip())
            total += k
            linked += k if link else 0
        at = m.end()
        tag = (m.group(3) or "").lower()
        if not tag:
            continue
        if tag not in INLINE:
            flush()
        if tag in VOID:
            continue
        if m.group(2):
            if opened[tag]:
                while stack:
                    t, _ = stack.pop()
                    opened[t] -= 1
                    link -= t == "a"
                    if t == tag:
                        break
        else:
            if tag in ("p", "li", "dt", "dd", "tr", "td") and stack and stack[-1][0] == tag:
                opened[stack.pop()[0]] -= 1  # an end tag left out
            a = _ATTR.findall(m.group(4) or "")
            stack.append((tag, " ".join(x or y or z for x, y, z in a).lower() if a else ""))
            opened[tag] += 1
            link += tag == "a"
    if at < len(page):
        rest = page[at:]
        buf.append(rest.partition("<")[0] if "<" in rest else rest)
    flush()
    return out


def aligned(lines: list[str], blocks: list[tuple[str, str, str, float]]) -> list[int]:
    """For each line the number of its block, or -1; in order.

    Texts that stand once among the lines and once among the blocks are anchors, as many as keep their order (a longest
    increasing sequence). Between two anchors each line takes the next block with its text, or, if it is long, the next that begins
    as it does or holds it, however many hidden blocks lie before that; a short text that is found far ahead must be followed by the
    block of the next line.
    """
    texts = [b[0] for b in blocks]
    places: dict[str, list[int]] = defaultdict(list)
    starts: dict[str, list[int]] = defaultdict(list)
    for k, x in enumerate(texts):
        places[x].append(k)
        starts[x[:30]].append(k)
    once = Counter(lines)
    pairs = [(i, places[x][0]) for i, x in enumerate(lines) if x and once[x] == 1 and len(places.get(x, ())) == 1]
    ends: list[int] = []  # least last block of an increasing sequence of each length
    at: list[int] = []
    before: list[int] = []
    for n, (_, k) in enumerate(pairs):
        p = bisect_left(ends, k)
        if p == len(ends):
            ends.append(k)
            at.append(n)
        else:
            ends[p], at[p] = k, n
        before.append(at[p - 1] if p else -1)
    out = [-1] * len(lines)
    n = at[-1] if at else -1
    while n >= 0:
        out[pairs[n][0]] = pairs[n][1]
        n = before[n]
    stops = [len(texts)] * (len(lines) + 1)
    for i in range(len(lines) - 1, -1, -1):
        stops[i] = out[i] if out[i] >= 0 else stops[i + 1]
    j = 0
    for i, ln in enumerate(lines):
        if out[i] >= 0:
            j = out[i] + 1
            continue
        stop = stops[i]
        if not ln or j >= stop:
            continue
        hit = -1
        for among in (places.get(ln), starts.get(ln[:30]) if len(ln) > 30 else None):
            if among and (p := bisect_left(among, j)) < len(among) and among[p] < stop and (hit < 0 or among[p] < hit):
                hit = among[p]
        if hit < 0 and len(ln) > 30:
            hit = next((k for k in range(j, stop) if ln in texts[k]), -1)
        if hit >= j + 12 and len(ln) <= 30 and lines[i + 1 : i + 2] != texts[hit + 1 : hit + 2]:
            hit = -1  # a short text far ahead that does not go on: rather another place
        if hit >= 0:
            out[i], j = hit, hit + 1
    return out


_DIGIT = re.compile(r"\d")
_W = re.compile(r"[^\W\d_]+")
_ENDS = re.compile(r"[.!?…:][\"'”»)]*$")
_DATE = re.compile(r"\d{4}-\d\d-\d\d|\d{1,2}[:.]\d\d\b|\b\d{1,2}/\d{1,2}\b|\b(?:jan|feb|mar|apr|maj|jun|jul|aug|sep|okt|nov|dec)\w*\.?\s+\d{2,4}|\d{1,2}\s+(?:januari|februari|mars|april|maj|juni|juli|augusti|september|oktober|november|december)\b|(?:mån|tis|ons|tors|fre|lör|sön)dag\b", re.I)
_NICK = re.compile(r"^[\wåäöÅÄÖ]+[-_]?\d+\W*$")
#: Words by the flag that they raise (fixed values).
FLAG_WORDS = {
    w: flag
    for flag, ws in {
        "copy": "copyright rättigheter rights",
        "cookie": "cookie cookies kakor privacy integritet integritetspolicy samtycke consent godkänner samarbetspartner storage lagrar",
        "share": "dela gilla spara tweet tweeta facebook e-post tipsa share annons nyhetsbrev skriv sociala",
        "reply": "svara citera anmäl reply quote logga registrera inloggad login",
        "poster": "inlägg registrerad medlem ort postat skrivet status posts joined offline online användare rank",
        "byline": "redaktionen publicerad uppdaterad skriven lästid redaktör ansvarig foto bild text utgivare",
        "also": "också även relaterat relaterade läst senaste fler följ kategorier kategori arkiv taggar kommentarer populärt related nästa föregående mer",
        "wrote": "skrev citat quote wrote svar",
        "site": "webb webbplats webbplatsen webbläsare sidan besökare drivs telefon kontakta tryck trycks förening kopieras upphov tillstånd",
        "ad": "annons prenumerant prenumerera rabatt erbjudande reklam sponsrad sponsrat halva",
    }.items()
    for w in ws.split()
}
_CRUMB = re.compile(r".\s[>»›/|]\s.|\s\|\s|  +\S")
_COUNT = re.compile(r"\(\d+\)$|^\d+ (?:kommentarer|besökare|svar|visningar)")
_AMOUNT = re.compile(r"\b\d+ (?:kr|dl|msk|tsk|st|g|kg)\b")


class _Hashes(dict):
    def __missing__(self, s: str) -> int:
        if len(self) > 500_000:
            self.clear()
        h = self[s] = 64 + zlib.crc32(s.encode()) % HASHED
        return h


_hash = _Hashes().__getitem__
#: What is known of some features beforehand: their mean weight for the body.
PRIOR = {"ad": -3.0, "copy": -2.0, "cookie": -2.0, "cookieL": -2.0, "line": -3.0, "adL": -2.0, "count": -1.0, "title": 3.0}
_TITLE = re.compile(r"<title[^>]*>(.*?)(?:</title|<)", re.S | re.I)
_FOLD = str.maketrans("åäöéüø", "aaoeuo")


def _slug(s: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", s.lower().translate(_FOLD)).strip("-")


def headline_marks(lines: list[str], page: str | None, url: str | None) -> set[int]:
    """The lines that begin as the page's title or the last part of its address do."""
    out = set()
    m = _TITLE.search(page) if page else None
    title = _slug(html_lib.unescape(m.group(1))) if m else ""
    slug = _slug(re.sub(r"\.\w+$", "", (url or "").rstrip("/").rpartition("/")[2].partition("?")[0]))
    slug = re.sub(r"-?\d+$", "", slug)
    for i, ln in enumerate(lines):
        if 12 <= len(ln) <= 120:
            x = _slug(ln)
            if len(x) >= 12 and (title.startswith(x) or (len(slug) >= 20 and x.startswith(slug[:36]) and len(x) < 90)):
                out.add(i)
    return out


def page_features(text: str, page: str | None, url: str | None = None) -> tuple[list[int], list[list[int]]]:
    """(numbers of the lines that are not blank, the active features of each)."""
    raw = text.split("\n")
    kept = [i for i, x in enumerate(raw) if x.strip()]
    lines = [_SPACE.sub(" ", raw[i]).strip() for i in kept]
    blocks = leaf_blocks(page)
    where = aligned(lines, blocks) if blocks else [-1] * len(lines)
    n = len(lines)
    heads = headline_marks(lines, page, url)
    base: list[list[str]] = []
    size = []
    for i, ln in enumerate(lines):
        ws = _W.findall(ln)
        k = len(ws)
        end = bool(_ENDS.search(ln))
        kind = ("long" if k >= 12 else "mid" if k >= 6 else "short") + ("." if end else "")
        size.append(kind)
        f = [kind, f"k{min(k, 15)}", f"k{min(k, 15)}{end:d}"]
        if ln[:1].isupper():
            f.append("upper")
        elif ln[:1].islower():
            f.append("lower" + kind)
        low = ln.lower()
        if _DIGIT.search(ln):
            f.append("digit")
            if _DATE.search(low):
                f.append("date" + kind[:3])
            if k <= 2 and _NICK.match(ln):
                f.append("nick")
            if _COUNT.search(low):
                f.append("count")
            if k <= 8 and _AMOUNT.search(low):
                f.append("amount")
        elif "dag " in low and _DATE.search(low):
            f.append("date" + kind[:3])
        lows = [w.lower() for w in ws]
        big = "L" if k >= 9 else ""
        if k <= 30:
            f += {FLAG_WORDS[w] + big for w in lows if w in FLAG_WORDS}
        if "©" in ln:
            f.append("copy")
        if k <= 16 and _CRUMB.search(raw[kept[i]]):
            f.append("crumb" + big)
        if ln[:3] in ("___", "---", "===", "***"):
            f.append("line")
        if i in heads:
            f.append("title")
        elif heads:
            f.append("past title" if any(h < i for h in heads) else "before title")
        if k <= 6:
            f.append("=" + _DIGIT.sub("0", low))
            f += ["w=" + w for w in lows]
        else:
            f.append("b=" + " ".join(lows[:2]))
        base.append(f)
    feats: list[list[int]] = []
    have = bool(blocks)
    for i in range(n):
        f = list(base[i])
        p, q = (base[i - 1][0] if i else "^"), (base[i + 1][0] if i + 1 < n else "$")
        f += ["p:" + p, "q:" + q, f"pq:{p}/{size[i]}/{q}"]
        f += ["P:" + x for x in base[i - 1][3:] if x[0] not in "b=kw" or x[1:2] == "="] if i else []
        f += ["Q:" + x for x in base[i + 1][3:] if x[0] not in "b=kw" or x[1:2] == "="] if i + 1 < n else []
        q2 = size[i + 2] if i + 2 < n else "$"
        p2 = size[i - 2] if i > 1 else "^"
        f += [f"q2:{size[i]}{q}{q2}", f"p2:{p2}{p}{size[i]}"]
        f.append(f"start{min(i, 8)}")
        f.append(f"end{min(n - 1 - i, 6)}")
        seen = sum(s.startswith("long") or s == "mid." for s in size[max(0, i - 6) : i])
        ahead = sum(s.startswith("long") or s == "mid." for s in size[i + 1 : i + 7])
        f += [f"seen{min(seen, 3)}", f"ahead{min(ahead, 3)}", f"sa{min(seen, 2)}{min(ahead, 2)}{size[i]}"]
        if where[i] >= 0:
            _, tags, cls, link = blocks[where[i]]
            leaf = tags.rpartition(">")[2]
            f += ["t:" + tags, "l:" + leaf + size[i], "t+" + leaf + ("a" if link > 0.5 else "")]
            if link > 0.5:
                f += ["link", "link" + size[i]]
            f += ["c:" + c for c in re.split(r"[\s_-]+", cls)[-6:] if c]
            nearby = blocks[where[i] + 1][1].rpartition(">")[2] if where[i] + 1 < len(blocks) else "$"
            f.append("n:" + leaf + ">" + nearby)
        else:
            f.append("nohtml" if not have else "unaligned")
        feats.append([_hash(x) for x in f])
    return kept, feats


class Chain:
    """A linear-chain conditional random field with binary features."""

    def __init__(self):
        s = len(STATES)
        self.w = np.zeros((64 + HASHED, s), np.float64)
        for name, weight in PRIOR.items():
            self.w[_hash(name), BODY] = weight
        self.mean = self.w.copy()
        self.trans = np.zeros((s, s))
        self.first = np.zeros(s)
        self.last = np.zeros(s)
        for a, b in ((0, 3), (1, 0), (2, 0), (2, 3), (3, 0), (3, 1), (3, 2)):
            self.trans[a, b] = -1e3  # the parts of a page come in order; before may pass to inside by no way but body
        self.trans[0, 2] = -1e3
        self.trans[0, 3] = 0.0
        self.fixed = self.trans <= -1e3

    def scores(self, pages: list[list[list[int]]]) -> tuple[np.ndarray, np.ndarray]:
        """(pages, lines, states) emission scores, padded, and the lengths."""
        lens = np.array([len(p) for p in pages])
        flat = [f for p in pages for f in p]
        counts = np.fromiter(map(len, flat), np.int64, len(flat))
        idx = np.fromiter((x for f in flat for x in f), np.int64, int(counts.sum()))
        e = np.add.reduceat(self.w[idx], np.r_[0, np.cumsum(counts)[:-1]], axis=0)
        out = np.zeros((len(pages), int(lens.max(initial=1)), len(STATES)))
        out[np.arange(out.shape[1]) < lens[:, None]] = e
        return out, lens

    def viterbi(self, pages: list[list[list[int]]]) -> list[np.ndarray]:
        e, lens = self.scores(pages)
        n, m, s = e.shape
        best = self.first + e[:, 0]
        back = np.zeros((n, m, s), np.int8)
        final = np.where((lens == 1)[:, None], best + self.last, -np.inf)
        for t in range(1, m):
            x = best[:, :, None] + self.trans
            back[:, t] = x.argmax(axis=1)
            best = x.max(axis=1) + e[:, t]
            done = lens == t + 1
            final[done] = best[done] + self.last
        y = np.zeros((n, m), np.int8)
        cur = final.argmax(axis=1)
        for t in range(m - 1, -1, -1):
            inside = t < lens
            y[inside, t] = cur[inside]
            nxt = back[np.arange(n), t, cur]
            cur = np.where(inside & (t > 0), nxt, cur)
        return [y[i, :k] for i, k in enumerate(lens)]

    def fit(self, pages: list[list[list[int]]], labels: list[np.ndarray], rounds: int = 150, rate: float = 0.1, l2: float = 0.02) -> Chain:
        """Adam on the exact negative log-likelihood over the whole training set."""
        flat = [f for p in pages for f in p]
        counts = np.fromiter(map(len, flat), np.int64, len(flat))
        idx = np.fromiter((x for f in flat for x in f), np.int64, int(counts.sum()))
        rowof = np.repeat(np.arange(len(flat)), counts)
        by_feature = np.argsort(idx, kind="stable")
        used, groups = np.unique(idx[by_feature], return_index=True)
        rows_sorted = rowof[by_feature]
        s = len(STATES)
        y = np.concatenate(labels)
        hot = np.eye(s)[y]
        lens = np.array([len(p) for p in pages])
        m = int(lens.max())
        mask = np.arange(m) < lens[:, None]
        params = [self.w, self.trans, self.first, self.last]
        mom = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
        ends = np.cumsum(lens) - 1
        starts = np.r_[0, ends[:-1] + 1]
        pair = np.zeros((s, s))
        keep = np.ones(len(y) - 1, bool)
        keep[ends[:-1]] = False
        np.add.at(pair, (y[:-1][keep], y[1:][keep]), 1)
        for step in range(1, rounds + 1):
            e, _ = self.scores(pages)
            alpha = np.zeros_like(e)
            beta = np.zeros_like(e)
            alpha[:, 0] = self.first + e[:, 0]
            for t in range(1, m):
                x = alpha[:, t - 1, :, None] + self.trans
                top = x.max(axis=1)
                alpha[:, t] = np.where(mask[:, t, None], np.log(np.exp(x - top[:, None]).sum(axis=1)) + top + e[:, t], alpha[:, t - 1])
            rows = np.arange(len(pages))
            beta[rows, lens - 1] = self.last
            for t in range(m - 2, -1, -1):
                x = self.trans + (e[:, t + 1] + beta[:, t + 1])[:, None]
                top = x.max(axis=2)
                b = np.log(np.exp(x - top[:, :, None]).sum(axis=2)) + top
                beta[:, t] = np.where(mask[:, t + 1, None], b, beta[:, t])
            z = alpha[:, -1] + self.last
            logz = np.log(np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)) + z.max(axis=1)
            marg = np.exp(alpha + beta - logz[:, None, None])[mask]
            both = np.zeros((s, s))
            for t in range(1, m):
                q = np.exp(alpha[:, t - 1, :, None] + self.trans + (e[:, t] + beta[:, t])[:, None] - logz[:, None, None])
                both += q[mask[:, t]].sum(axis=0)
            err = marg - hot
            gw = np.zeros_like(self.w)
            gw[used] = np.add.reduceat(err[rows_sorted], groups, axis=0) + l2 * (self.w[used] - self.mean[used])
            grads = [gw, np.where(self.fixed, 0, both - pair), err[starts].sum(axis=0), err[ends].sum(axis=0)]
            for p, gr, (m1, m2) in zip(params, grads, mom):
                m1 *= 0.9
                m1 += 0.1 * gr
                m2 *= 0.99
                m2 += 0.01 * gr * gr
                p -= rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
        return self


def labelled_page(page: str, main: str) -> tuple[str, np.ndarray] | None:
    """(visible text, states) of a labelled page: its leaf blocks, matched in order with the lines of the main text."""
    blocks = [b[0] for b in leaf_blocks(page)]
    gold = [x for x in (_SPACE.sub(" ", ln).strip() for ln in re.split(r"[\r\n]+", main)) if x]
    if not blocks or not gold:
        return None
    body = np.zeros(len(blocks), bool)
    for a, _, k in difflib.SequenceMatcher(None, blocks, gold, autojunk=False).get_matching_blocks():
        body[a : a + k] = True
    text = " ".join(gold)
    for i, b in enumerate(blocks):  # blocks that the hand-made text joins or splits otherwise
        if not body[i] and len(b) > 40 and b in text:
            body[i] = True
    if not body.any():
        return None
    on = np.flatnonzero(body)
    y = np.where(body, 1, 2)
    y[: on[0]] = 0
    y[on[-1] + 1 :] = 3
    return "\n".join(blocks), y


def train(rows: list[tuple[str | None, str | None, str | None]], rounds: int = 150) -> Chain:
    """From (HTML, main text, address); each page also without its HTML, and both also without the address."""
    pages, labels = [], []
    for page, main, url in rows:
        got = labelled_page(page, main) if page and main else None
        if got:
            text, y = got
            for h in (page, None):
                for u in {url, None}:
                    pages.append(page_features(text, h, u)[1])
                    labels.append(y)
    if not pages:
        raise ValueError("no labelled page can be used")
    return Chain().fit(pages, labels, rounds)


def fitted(labelled: DataFrame, html_col: str = "html", text_col: str = "text", url_col: str = "url", id_col: str = "id", max_labelled: int = 2000) -> Chain:
    """The model of a labelled table; of more than ``max_labelled`` rows, those with the least hashes of their ids are used."""
    rows = labelled.orderBy(F.xxhash64(id_col), id_col).select(html_col, text_col, url_col).limit(max_labelled).collect()
    return train([tuple(r) for r in rows])


def _decoded(texts: list[str | None], pages: list[str | None], urls: list[str | None], model: Chain) -> list[tuple[list[int], np.ndarray]]:
    got: list[tuple[list[int], np.ndarray]] = [([], np.empty(0, np.int8))] * len(texts)
    feats = {i: page_features(t, p, u) for i, (t, p, u) in enumerate(zip(texts, pages, urls)) if t and t.strip()}
    order = sorted(feats, key=lambda i: len(feats[i][0]))
    for s in range(0, len(order), 128):
        part = order[s : s + 128]
        for i, y in zip(part, model.viterbi([feats[i][1] for i in part])):
            got[i] = (feats[i][0], y)
    return got


def boilerplate_lines(df: DataFrame, model: Chain, id_col: str = "page_id", text_col: str = "text", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(id, line_no) of the lines outside the main body; a narrow stage."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(it, "t", 2_000_000):
            row, no = [], []
            for i, (kept, y) in enumerate(_decoded(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(), model)):
                out = [k for k, s in zip(kept, y) if s != BODY]
                row += [i] * len(out)
                no += out
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row, pa.int64())), pa.array(no, pa.int32())], names=[id_col, "line_no"])

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t", f"`{html_col}` as h", f"`{url_col}` as u"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, line_no int")


def main_bodies(df: DataFrame, model: Chain, id_col: str = "page_id", text_col: str = "text", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(id, body) of every page. Where the text is null or blank, the lines are the leaf blocks of the HTML; if that has no body either,
    the body is null for a null text and empty for a blank one.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(chunks(it, "t", 2_000_000), "h", 8_000_000):
            given = b.column(1).to_pylist()
            texts = [t if t and t.strip() else "\n".join(x[0] for x in leaf_blocks(p)) for t, p in zip(given, b.column(2).to_pylist())]
            out = []
            for g, t, (kept, y) in zip(given, texts, _decoded(texts, b.column(2).to_pylist(), b.column(3).to_pylist(), model)):
                raw = t.split("\n")
                body = "\n".join(raw[k].strip() for k, s in zip(kept, y) if s == BODY)
                out.append(body or (None if g is None else ""))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], names=[id_col, "body"])

    src = spread(df.selectExpr(f"`{id_col}` as i", f"`{text_col}` as t", f"`{html_col}` as h", f"`{url_col}` as u"))
    return src.mapInArrow(run, f"`{id_col}` {dict(df.dtypes)[id_col]}, body string")
