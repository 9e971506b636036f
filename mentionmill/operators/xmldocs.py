"""Paragraphs of article XML in two schemes, in one pass over the parser's events.

A tolerant event parser takes undefined entities and unclosed tags as they come. All text goes into one buffer; an element that is
wanted only notes where in it it begins and ends. What an element means follows from counts and places kept for the open elements
(abstracts, the outermost section, what stands apart from running text), so there is no tree, no walk to ancestors and no bound on
depth. Records it cannot make sense of give no paragraphs, never a failed task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionmill.session import ship

_BLANK = re.compile(r"\s+")
_PARTS = re.compile(r"\s*(?:\band\b|&|/|\+|\||,)\s*")
_SECTION_TAG = {"jats": re.compile(r"<(?:[\w.-]+:)?sec[\s/>]", re.I), "tei": re.compile(r"<(?:[\w.-]+:)?div[\s/>]", re.I)}


@dataclass(frozen=True)
class Scheme:
    """The element names of a scheme, and what is no running text of its section."""

    name: str
    section: str
    title: str
    kind: str
    apart: frozenset[str]
    floats: frozenset[str]


JATS = Scheme("jats", "sec", "title", "sec-type", frozenset({"fig", "table-wrap", "table", "table-wrap-foot", "fn", "caption"}), frozenset({"fig", "table-wrap"}))
TEI = Scheme("tei", "div", "head", "type", frozenset({"figure"}), frozenset({"figure"}))


def canonical_type(value: str | None) -> str:
    """A section's type in one form: lower case, parts sorted and joined by a bar."""
    v = (value or "").strip().lower().replace("-", " ").replace("_", " ")
    parts = [_BLANK.sub(" ", p).strip() for p in _PARTS.sub("|", v).split("|")]
    return "|".join(sorted(p for p in parts if p))


@dataclass(slots=True)
class _Span:
    """A stretch of the text buffer."""

    start: int
    end: int = -1


@dataclass(slots=True)
class _Open:
    """An open element: its name, what it waits for among its children, and what it holds so far."""

    name: str
    attributes: dict[str, str]
    span: _Span
    children: dict[str, _Span] = field(default_factory=dict)
    waits: tuple[str, ...] = ()
    inner: list[_Span] = field(default_factory=list)  # paragraphs of a block, heads or first row of a table


class _Events(HTMLParser):
    """Names lose prefix and case; a closing tag closes up to its opener, and is passed over where there is none."""

    CDATA_CONTENT_ELEMENTS = ()

    def __init__(self, xml: str):
        super().__init__(convert_charrefs=True)
        self.xml = xml
        self.scheme: Scheme | None = None
        self.started = False
        self.text: list[str] = []
        self.stack: list[_Open] = []
        self.named: Counter[str] = Counter()
        self.apart: list[int] = []  # depths of open elements that stand apart
        self.blocks: list[tuple[int, _Open]] = []  # open abstracts and the outermost open section, with their depths
        self.in_section = False
        self.in_float: list[_Open] = []
        self.found: dict[str, list] = {"abstract": [], "section": [], "loose": [], "float": []}
        self.feed(xml)
        self.close()
        while self.stack:
            self._end()

    def _choose(self, root: str) -> Scheme | None:
        if root == "tei":
            return TEI
        if root in ("pmc-articleset", "article") or _SECTION_TAG["jats"].search(self.xml):
            return JATS
        return TEI if _SECTION_TAG["tei"].search(self.xml) else None

    def handle_starttag(self, tag, attrs):
        name = tag.rpartition(":")[2]
        if not self.started:
            self.started, self.scheme = True, self._choose(name)
        s = self.scheme
        if s is None:
            return
        me = _Open(name, {k.rpartition(":")[2]: v or "" for k, v in attrs}, _Span(len(self.text)))
        up = self.stack[-1] if self.stack else None
        depth = len(self.stack)
        if up is not None and name in up.waits and name not in up.children:
            up.children[name] = me.span
        if name in s.apart:
            self.apart.append(depth)
        if name == "abstract":
            me.waits = (s.title,)
            self.blocks.append((depth, me))
            self.found["abstract"].append(me)
        elif name == s.section and not self.in_section and not self.named["abstract"]:
            me.waits = (s.title,)
            self.in_section = True
            self.blocks.append((depth, me))
            self.found["section"].append(me)
        elif name in s.floats:
            me.waits = ("label", "caption") if s is JATS else ("head", "figdesc", "table")
            self.in_float.append(me)
            self.found["float"].append(me)
        elif name == "p":
            if up is not None and up.name == "body":
                self.found["loose"].append(me.span)
            last = self.apart[-1] if self.apart else -1
            for at, block in self.blocks:
                if last < at:
                    block.inner.append(me.span)
        elif name == "thead" and s is JATS:
            for f in self.in_float:
                if f.name == "table-wrap":
                    f.inner.append(me.span)
        elif name == "row" and s is TEI:
            for f in self.in_float:
                grid = f.children.get("table")
                if grid is not None and grid.end < 0 and not f.inner:
                    f.inner.append(me.span)
        self.stack.append(me)
        self.named[name] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        name = tag.rpartition(":")[2]
        if self.named[name]:
            while self._end() != name:
                pass

    def _end(self) -> str:
        me = self.stack.pop()
        me.span.end = len(self.text)
        self.named[me.name] -= 1
        depth = len(self.stack)
        if self.apart and self.apart[-1] == depth:
            self.apart.pop()
        if self.blocks and self.blocks[-1][0] == depth:
            _, block = self.blocks.pop()
            self.in_section = self.in_section and block.name == "abstract"
        if self.in_float and self.in_float[-1] is me:
            self.in_float.pop()
        return me.name

    def handle_data(self, data):
        if self.stack:
            self.text.append(data)

    def read(self, s: _Span | None) -> str:
        return "" if s is None else _BLANK.sub(" ", "".join(self.text[s.start : s.end])).strip()


def _float(x: _Events, f: _Open) -> Iterator[tuple[str, str, str]]:
    """Rows of a figure or table: its heading with its legend, then the heads of its columns."""
    of = lambda c: x.read(f.children.get(c))
    jats = x.scheme is JATS
    table = f.name == "table-wrap" if jats else f.attributes.get("type", "").strip().lower() == "table"
    kind, name = ("table-heading", "Table") if table else ("figure-legend", "Figure")
    label, legend = (of("label"), of("caption")) if jats else (of("head"), of("figdesc"))
    whole = " ".join(filter(None, (label, legend))) or ("" if jats or table else x.read(f.span))
    if whole:
        yield kind, label or name, whole
    if table:
        yield from ((kind, label or name, t) for t in map(x.read, f.inner) if t)


def paragraphs(xml: str) -> tuple[str, list[tuple[str, str, str]]]:
    """(scheme, [(section type, section title, text)]): abstract, outermost sections, loose body text, then figures and tables."""
    x = _Events(xml)
    s = x.scheme
    if s is None:
        return "unknown", []
    out: list[tuple[str, str, str]] = []
    for a in x.found["abstract"]:
        kind = a.attributes.get("abstract-type", "").strip() if s is JATS else ""
        title = x.read(a.children.get(s.title)) or (f"Abstract ({kind})" if kind else "Abstract")
        out += [("abstract", title, t) for t in map(x.read, a.inner) if t]
    for b in x.found["section"]:
        title = x.read(b.children.get(s.title))
        kind = canonical_type(b.attributes.get(s.kind)) or canonical_type(title) or "(untitled)"
        out += [(kind, title or kind, t) for t in map(x.read, b.inner) if t]
    out += [("(body)", "Body", t) for t in map(x.read, x.found["loose"]) if t]
    for f in x.found["float"]:
        out += _float(x, f)
    return s.name, out


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc, xml in zip(b["doc"], b["xml"], strict=True):
            try:
                scheme, found = paragraphs(xml)
                rows += [(doc, scheme, i, *p, None) for i, p in enumerate(found)]
            except Exception as e:  # a record that cannot be read is a row that says so
                rows.append((doc, "unknown", None, None, None, None, str(e)))
        yield pd.DataFrame(rows, columns=["doc", "scheme", "para_ord", "section_type", "section_title", "text", "parse_error"])


def article_paragraphs(docs: DataFrame, doc: str, xml: str) -> DataFrame:
    """(doc, scheme, para_ord, section_type, section_title, text, parse_error). Null and blank records give nothing."""
    ship(docs.sparkSession)
    x = docs.select(F.col(doc).cast("string").alias("doc"), F.col(xml).alias("xml")).where(F.length(F.trim("xml")) > 0)
    schema = "doc string, scheme string, para_ord int, section_type string, section_title string, text string, parse_error string"
    return x.mapInPandas(_run, schema).withColumnRenamed("doc", doc)
