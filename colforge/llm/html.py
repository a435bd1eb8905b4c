"""Layout-aware rendering of HTML to text.

A tree builder closes the tags that HTML implies (a paragraph before a block, a list item
before the next, cells and rows of a table) and drops what a browser does not show.  The
renderer walks the tree and emits all visible text: blocks on lines of their own,
paragraphs and headings apart, list items marked and indented, preformatted text as it
stands, and table cells in aligned columns.

Every page is rendered in its own task by one small function; nothing is shuffled.

Defined results: a null page gives an empty text, as does one without visible text.
Unclosed, stray and wrongly nested tags are mended and never fail.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head title script style noscript template iframe object embed canvas audio video datalist desc metadata defs".split())
#: All that a head holds; anything else ends it.
HEAD_CONTENT = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Inputs that show no text, or not their value.
TEXTLESS_INPUTS = frozenset("hidden password checkbox radio file image color range".split())
BLOCK = frozenset(("html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li main menu nav ol optgroup option p pre search section "
                   "summary table tbody td tfoot th thead tr ul caption").split())
#: Blocks with an empty line before and after.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir pre blockquote table figure hr fieldset".split())
#: An opening tag closes open elements of these names, up to one of the fences.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
_ENDS_P = BLOCK - frozenset("html body dd dt li td th tr tbody thead tfoot caption option optgroup legend summary".split())
#: An end tag does not reach over these.
_FENCES = frozenset("table td th caption button".split())
_SPACE = re.compile(r"[ \t\n\r\f]+")
_NOT_DISPLAYED = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!important\s*)?(?:;|$)", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|hidden|collapse)\s*(?:!important\s*)?(?=;|$)", re.I)


class Node:
    __slots__ = ("tag", "children", "attrs")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


class TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.count: dict[str, int] = {}  # open elements by name

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)  # HTML has no marked sections

    def _cut(self, at: int) -> None:
        for n in self.open[at:]:
            self.count[n.tag] -= 1
        del self.open[at:]

    def _close(self, names, fences) -> None:
        """Close the open elements from the outermost of ``names`` above the last fence."""
        if not any(self.count.get(n) for n in names):
            return
        cut = None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag in fences:
                break
            if self.open[i].tag in names:
                cut = i
        if cut is not None:
            self._cut(cut)

    def handle_starttag(self, tag, attrs):
        if tag == "html":
            return
        if tag in CLOSES:
            self._close(*CLOSES[tag])
        if tag in _ENDS_P:
            self._close({"p"}, _FENCES)
        if self.open[-1].tag == "head" and tag not in HEAD_CONTENT:
            self._cut(len(self.open) - 1)
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_endtag(self, tag):
        if tag in ("html", "body"):
            return  # what follows still belongs to the body
        if tag == "br":
            return self.handle_starttag("br", [])
        if tag == "p" and not self.count.get("p"):
            self.handle_starttag("p", [])
        if not self.count.get(tag):
            return
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                return self._cut(i)
            if self.open[i].tag in _FENCES and tag not in ("table", "tr", "tbody", "thead", "tfoot"):
                return

    def handle_data(self, data):
        if self.open[-1].tag == "head" and not _SPACE.fullmatch(data):
            self._cut(len(self.open) - 1)
        self.open[-1].children.append(data)


def _hidden(node: Node) -> bool:
    a = node.attrs
    return (node.tag in HIDDEN or "hidden" in a or bool(a.get("style") and _NOT_DISPLAYED.search(a["style"]))
            or (node.tag == "dialog" and "open" not in a))


def _visible(node: Node, inherited: bool) -> bool:
    """Whether an element's own text is seen.  Children of an invisible element may be."""
    style = node.attrs.get("style")
    said = _VISIBILITY.findall(style) if style else None
    return said[-1].lower() == "visible" if said else inherited


class _Lines:
    """Collects lines; white space collapses and empty lines do not add up."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.pre = False  # the line's spaces stand as they are
        self.gap = False  # an empty line is due before the next text
        self.prefix = ""  # what comes before the next line of text, like a list mark
        self.indent = ""

    def text(self, data: str, pre: bool) -> None:
        if pre:
            self.pre = True
            first, *rest = data.replace("\r\n", "\n").split("\n")
            self.now.append(first)
            for line in rest:
                self.end(keep=True)
                self.pre = True
                self.now.append(line)
            return
        data = _SPACE.sub(" ", data)
        if data.startswith(" ") and (not self.now or self.now[-1].endswith(" ")):
            data = data[1:]
        if data:
            self.now.append(data)

    def end(self, keep: bool = False) -> None:
        line = "".join(self.now)
        line = line if keep or self.pre else line.strip(" ")
        self.now, self.pre = [], False
        if line.strip() or (keep and self.lines):
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append(self.indent + self.prefix + line if line else "")
            if self.prefix:
                self.indent += " " * len(self.prefix)
                self.prefix = ""

    def block(self, gap: bool) -> None:
        self.end()
        self.gap = self.gap or (gap and not self.prefix)


def render(html: str | None) -> str:
    """All visible text of a page."""
    builder = TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return "\n".join(_render(builder.root)).strip("\n")


def _render(root: Node) -> list[str]:
    """Walks the tree with a stack of its own, so that depth is no limit.  Tables nest:
    each cell is rendered into lines of its own, and a finished table is laid out."""
    out = _Lines()
    todo: list[tuple] = [("open", root, False, True)]
    frames: list[tuple[_Lines, list]] = []  # the lines outside a cell
    tables: list[list[list[list[str]]]] = []  # rows of cells of lines
    lists: list[int | None] = []
    while todo:
        step, node, pre, item = todo.pop()
        if step == "open":
            if isinstance(node, str):
                if item:  # the text is visible
                    out.text(node, pre)
                continue
            if _hidden(node):
                continue
            tag, seen = node.tag, _visible(node, item)
            if tag == "br":
                out.end(keep=bool(out.now) or pre)
                continue
            if tag == "img":
                if node.attrs.get("alt") and seen:
                    out.text(node.attrs["alt"], False)
                continue
            if tag == "input":
                if node.attrs.get("type", "").strip().lower() not in TEXTLESS_INPUTS and node.attrs.get("value") and seen:
                    out.text(node.attrs["value"], False)
                continue
            saved = (out.indent, out.prefix)
            if tag in BLOCK and tag not in ("td", "th"):
                out.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and lists))
            if tag in ("ul", "ol", "menu", "dir"):
                start = node.attrs.get("start", "")
                lists.append((int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1) if tag == "ol" else None)
            elif tag == "li":
                number = lists[-1] if lists else None
                out.prefix = "- " if number is None else f"{number}. "
                if number is not None:
                    lists[-1] = number + 1
            elif tag in ("dd", "blockquote"):
                out.indent += "  "
            elif tag == "hr":
                continue
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                frames.append((out, saved))
                out = _Lines()
            pre = pre or tag in ("pre", "textarea", "listing")
            todo.append(("close", node, pre, saved))
            todo.extend(("open", c, pre, seen) for c in reversed(node.children))
            continue
        tag = node.tag
        if tag in ("td", "th") and tables:
            out.end()
            cell = out.lines
            out, _ = frames.pop()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append(cell)
            span = node.attrs.get("colspan", "")
            tables[-1][-1].extend([] for _ in range(min(int(span), 1000) - 1 if re.fullmatch(r"\d{1,4}", span) else 0))
            continue
        if tag in BLOCK:
            out.block(tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and len(lists) > 1))
        if tag in ("ul", "ol", "menu", "dir"):
            lists.pop()
        elif tag == "table":
            for line in _aligned(tables.pop()):
                out.now.append(line)
                out.end(keep=True)
            out.gap = True
        out.indent, out.prefix = item[0], "" if tag == "li" else out.prefix and item[1]
    out.end()
    return out.lines


def _aligned(rows: list[list[list[str]]]) -> list[str]:
    """Cells side by side, each column as wide as its widest line; cells of several lines
    take several lines."""
    widths: list[int] = []
    for row in rows:
        for i, cell in enumerate(row):
            if i == len(widths):
                widths.append(0)
            widths[i] = max([widths[i], *map(len, cell)])
    lines = []
    for row in rows:
        for k in range(max(map(len, row), default=0)):
            parts = [(cell[k] if k < len(cell) else "").ljust(widths[i]) for i, cell in enumerate(row) if widths[i]]
            lines.append("  ".join(parts).rstrip())
    return lines


def render_column(html: str = "html") -> Column:
    @F.pandas_udf("string")
    def text(pages: pd.Series) -> pd.Series:
        return pd.Series([render(p) for p in pages], dtype="object")
    return text(F.col(html))


def extract_text(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Add ``out``, the visible text of ``html``; an input column of that name is replaced."""
    prepare(pages.sparkSession)
    return pages.withColumn(out, render_column(html))
