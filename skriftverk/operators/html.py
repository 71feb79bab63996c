"""HTML to text: page clean-up, tables as placeholders, text lines, and a density-based alternative.

One small tree builder on the standard parser; rules for broken markup: an end tag closes the nearest open element of
its name, unknown end tags are ignored, p, li, tr, td, th, option, dt and dd close an open one of their kind, void elements
never open, and what is left open at the end is closed.
"""

from __future__ import annotations

import html
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lexicon import COMMENT_CLASSES, COMMENT_IDS, LAYOUT_WORDS, NOISE_CLASS_PARTS, NOISE_PARTS, NOISE_TAGS, SHORT_LINE_WORDS, WIDGET_CLASSES
from ..functions.text import is_upper, strip, tokens
from .filters import text_of

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
RAW = ("script", "style")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            n = todo.pop()
            yield n
            todo += [c for c in reversed(n.children) if isinstance(c, Node)]

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None

    def texts(self) -> Iterator[str]:
        todo: list[Node | str] = [self]
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                yield n
            elif n.tag not in RAW:
                todo += reversed(n.children)

    def markup(self) -> str:
        out: list[str] = []
        todo: list[tuple[Node | str, bool, bool]] = [(self, False, False)]
        while todo:
            n, end, raw = todo.pop()
            if end:
                out.append(f"</{n.tag}>")
            elif isinstance(n, str):
                out.append(n if raw else html.escape(n, quote=False))
            else:
                if n.tag != "#root":
                    out.append("<" + n.tag + "".join(f' {k}="{html.escape(v)}"' for k, v in n.attrs.items()) + ">")
                    if n.tag not in VOID:
                        todo.append((n, True, False))
                todo += [(c, False, n.tag in RAW) for c in reversed(n.children)]
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        n = self.at
        if tag in SELF_CLOSING:
            while n.parent is not None and n.tag in SELF_CLOSING[tag]:
                n = self.at = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag: str) -> None:
        n: Node | None = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(page: str) -> Node:
    b = _Builder()
    b.feed(page)
    b.close()
    return b.root


def _has(n: Node, attr: str, part: str) -> bool:
    return part in n.attrs.get(attr, "")


def _classes(n: Node) -> list[str]:
    return n.attrs.get("class", "").split()


def _drop(root: Node, rule: Callable[[Node], bool]) -> None:
    for n in [n for n in root.walk() if n.tag != "#root" and rule(n)]:
        n.remove()


def is_widget(n: Node) -> bool:
    return (n.tag == "form" and _has(n, "action", "search")) or n.attrs.get("id") == "Stats1" or not set(WIDGET_CLASSES).isdisjoint(_classes(n))


def is_comment(n: Node) -> bool:
    box = n.tag in ("div", "section") and (_has(n, "id", "comment") or _has(n, "class", "comment"))
    listing = n.tag in ("ol", "ul", "article") and _has(n, "class", "comment")
    reply = n.tag == "div" and (_has(n, "class", "reply") or _has(n, "id", "reply"))
    named = n.attrs.get("id") in COMMENT_IDS or not set(COMMENT_CLASSES).isdisjoint(_classes(n))
    return box or listing or reply or named


def is_noise(n: Node) -> bool:
    part = any(_has(n, a, x) for a in ("class", "id") for x in NOISE_PARTS)
    part = part or any(_has(n, "class", x) for x in NOISE_CLASS_PARTS)
    return part or n.tag in NOISE_TAGS


def table_markdown(table: Node) -> str:
    """Rows as a pipe table, the first as its head; empty where fewer than four characters are left beside the frame."""
    rows = []
    for tr in (n for n in table.walk() if n.tag == "tr"):
        cells = [" ".join(" ".join(c.texts()).split()).replace("|", "\\|") for c in tr.children if isinstance(c, Node) and c.tag in ("td", "th")]
        if cells:
            rows.append(cells)
    if not rows:
        return ""
    width = max(map(len, rows))
    rows = [r + [""] * (width - len(r)) for r in rows]
    out = "\n".join(["| " + " | ".join(rows[0]) + " |", "|" + "---|" * width, *("| " + " | ".join(r) + " |" for r in rows[1:])])
    return out if len(out.replace("|", "").replace("-", "").strip()) >= 4 else ""


def preprocessed(page: str) -> tuple[str, str | None, list[dict[str, object]]]:
    """(page, og:title, tables): widgets out, outermost data tables as placeholders, comments out."""
    root = parse(page)
    title = next((n.attrs.get("content", "").strip() for n in root.walk() if n.tag == "meta" and n.attrs.get("property") == "og:title" and n.attrs.get("content")), None)
    _drop(root, is_widget)
    tables: list[dict[str, object]] = []
    found = [n for n in root.walk() if n.tag == "table"]
    inner = {id(x) for n in found for x in n.walk() if x is not n}
    for t in found:
        if id(t) in inner or any(x in t.markup().lower() for x in LAYOUT_WORDS):
            continue
        md = table_markdown(t)
        if not md:
            continue
        target = t
        p = t.parent
        if p is not None and (p.tag == "figure" or (p.tag == "div" and "table" in p.attrs.get("class", "").lower())):
            target = p
        k = len(tables) + 1
        mark = f"XYZ_TABLE_BLOCK_{k}_XYZ"
        node = Node("p", {}, target.parent)
        node.children = [mark]
        up = target.parent
        up.children = [node if c is target else c for c in up.children]
        tables.append({"id": k, "markdown": md, "placeholder": mark})
    _drop(root, is_comment)
    return root.markup(), title, tables


def text_lines(page: str) -> list[str]:
    """The stripped text nodes that are left once noise is out, a line each."""
    root = parse(page)
    _drop(root, is_noise)
    return [x for t in root.texts() for x in (s.strip() for s in t.splitlines()) if x]


BLOCKS = frozenset("p div li td h1 h2 h3 h4 h5 h6 section article blockquote pre dd dt main body figcaption #root".split())


def dense_text(page: str, min_words: int = 8, max_links: float = 0.3) -> str:
    """Blocks that are long or follow a long one, with little of them in links; headings before such blocks stay."""
    root = parse(page)
    _drop(root, lambda n: n.tag in ("script", "style", "nav", "footer", "header", "aside", "form", "noscript", "iframe", "table", "button"))
    blocks: list[tuple[str, str, float]] = []
    for n in root.walk():
        if n.tag not in BLOCKS:
            continue
        own, linked = [], 0
        todo: list[tuple[Node | str, bool]] = [(c, False) for c in reversed(n.children)]
        while todo:
            c, link = todo.pop()
            if isinstance(c, str):
                own.append(c)
                linked += len(c.strip()) if link else 0
            elif c.tag not in BLOCKS:
                todo += [(x, link or c.tag == "a") for x in reversed(c.children)]
        text = " ".join("".join(own).split())
        if text:
            blocks.append((n.tag, text, linked / len(text)))
    good = [len(t.split()) >= min_words and k <= max_links for _, t, k in blocks]
    keep = [g or (tag[0] == "h" and tag[1:].isdigit() and any(good[i + 1 : i + 3])) for i, (g, (tag, _, _)) in enumerate(zip(good, blocks))]
    return "\n".join(t for k, (_, t, _) in zip(keep, blocks) if k)


def unescape(page: Column) -> Column:
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else html.unescape(x))

    run.__annotations__ = {"s": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(page)


_PAGE = "struct<page string, og_title string, tables array<struct<id int, markdown string, placeholder string>>, error string>"


def _preprocess(s: pd.Series) -> pd.DataFrame:
    rows = []
    for x in s:
        try:
            rows.append((*preprocessed(x), None) if x else (x or "", None, [], None))
        except Exception as e:  # noqa: BLE001 - a page that cannot be parsed is reported, not lost
            rows.append((None, None, [], f"broken HTML: {type(e).__name__}"))
    return pd.DataFrame(rows, columns=["page", "og_title", "tables", "error"])


def preprocess(page: Column) -> Column:
    """struct(page, og_title, tables, error); evaluated once however often its fields are used."""
    _preprocess.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(_preprocess, _PAGE).asNondeterministic()(page)


def is_upper_text(x: str) -> bool:
    return x == x.upper() and x != x.lower()


_SHORT_LINE_WORDS = frozenset(SHORT_LINE_WORDS)


def running_text(found: list[str]) -> str:
    """``clean_lines`` and ``joined_lines`` of lines that Python already holds."""
    kept = []
    for x in filter(None, (s.strip() for s in found)):
        ws = x.split()
        if (len(ws) < 5 and not _SHORT_LINE_WORDS.isdisjoint(ws)) or (len(ws) < 4 and x[-1] not in ".,!?:" and not is_upper_text(x[0])):
            continue
        kept.append(x)
    calm = [x for x, y in zip(kept, [*kept[1:], ""]) if not (x[-1] == ":" and y[-1:] == ":")]
    return "".join(x if not i else ("\n" if before[-1] in ".!?:" or x[-1] == ":" or is_upper_text(x) else " ") + x for i, (before, x) in enumerate(zip(["", *calm], calm)))


def _text_of_pages(page: Column, extractor: Callable[[str], str]) -> Column:
    """struct(text, error) by one Arrow stage, evaluated once; a page that the parser does not survive has an error and no text."""

    def run(s: pd.Series) -> pd.DataFrame:
        rows = []
        for x in s:
            try:
                rows.append((extractor(x) if x else "", None))
            except Exception as e:  # noqa: BLE001 - one page must not end the job
                rows.append((None, f"broken HTML: {type(e).__name__}"))
        return pd.DataFrame(rows, columns=["text", "error"])

    run.__annotations__ = {"s": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(run, "struct<text string, error string>").asNondeterministic()(page)


def simple(page: Column) -> Column:
    """struct(text, error): text lines, cleaned and joined."""
    return _text_of_pages(page, lambda x: running_text(text_lines(x)))


def dense(page: Column) -> Column:
    """struct(text, error) by text density."""
    return _text_of_pages(page, dense_text)


def clean_lines(found: Column, case_sensitive: bool = True) -> Column:
    """Without navigation lines, fragments, and lines with a colon before another such line; native."""
    words = F.array(*(F.lit(w) for w in SHORT_LINE_WORDS))
    low = (lambda c: c) if case_sensitive else F.lower
    kept = F.filter(F.transform(found, strip), lambda x: x != "")
    kept = F.filter(kept, lambda x: ~((F.size(tokens(x)) < 5) & F.arrays_overlap(tokens(low(x)), words)))
    first = lambda x: F.substring(x, 1, 1)
    kept = F.filter(kept, lambda x: ~((F.size(tokens(x)) < 4) & ~x.rlike("[.,!?:]$") & ~is_upper(first(x))))
    return kept


def joined_lines(kept: Column) -> Column:
    """Lines as running text: a new line after a sentence end or colon, before a line with a colon at its end or in capitals."""
    calm = F.filter(kept, lambda x, i: ~(x.endswith(":") & F.coalesce(F.try_element_at(kept, i + 2).endswith(":"), F.lit(False))))
    return F.array_join(
        F.transform(calm, lambda x, i: F.when(i == 0, x).when(calm[F.greatest(i - 1, F.lit(0))].rlike("[.!?:]$") | x.endswith(":") | is_upper(x), F.concat(F.lit("\n"), x)).otherwise(F.concat(F.lit(" "), x))),
        "",
    )


def simple_text(df: DataFrame, page: str = "html", out: str = "extracted") -> DataFrame:
    """Adds the extracted text, null for a page that cannot be parsed."""
    return df.withColumn("_x", simple(F.col(page))).withColumn(out, F.col("_x.text")).drop("_x")


def link_tables(text: Column, tables: Column, og_title: Column, title_always: bool = False) -> Column:
    """Placeholders back to tables, missing tables under a heading, and the title in front unless the text has it."""
    t = text_of(text)
    filled = F.aggregate(tables, t, lambda a, x: F.replace(a, x["placeholder"], F.concat(F.lit("\n\n"), x["markdown"], F.lit("\n\n"))))
    missing = F.filter(tables, lambda x: ~t.contains(x["placeholder"]))
    tail = F.array_join(F.transform(missing, lambda x: F.concat(F.lit("\n"), x["markdown"], F.lit("\n"))), "")
    filled = F.when(F.size(missing) > 0, F.concat(filled, F.lit("\n\n### Bilagor (Tabeller)\n"), tail)).otherwise(filled)
    title = F.coalesce(og_title, F.lit(""))
    titled = F.when((title != "") & ~F.lower(filled).contains(F.lower(title)), F.concat(title, F.lit("\n\n"), filled)).otherwise(filled)
    some = (t != "") & (F.lit(title_always) | (F.coalesce(F.size(tables), F.lit(0)) > 0))
    return F.when(some, strip(titled)).otherwise(t)
