"""Visible text of web pages, laid out: block spacing, lists, aligned table cells.

A tokenizer feeds a stack of open elements. Opening a tag first closes the elements whose
end it implies, and a visibility rule decides whether text below it shows. Text goes to a
flow that collapses white space, keeps breaks between blocks and indents list items; each
table cell has a flow of its own, and a closed table is set in columns. There is no
recursion, so pages may nest to any depth, and every step is linear in the page.

Defined results: a null or empty page gives an empty text; text without tags is rendered
as one flow; what an unclosed comment, script or style swallows does not show. Columns
wider than ``WIDEST`` are not padded. Other columns pass through.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Roles of elements in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    "head title script style template noscript iframe noembed noframes object audio video canvas svg datalist".split()
)
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure".split())
BLOCKS = PARAGRAPHS | frozenset(
    "address article aside body caption center dd details dialog dir div dt fieldset figcaption footer form header hgroup "
    "hr html legend li main menu nav option optgroup search section summary".split()
)
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset(("td", "th"))
# Opening the key closes these, unless one of the walls lies in between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select", "datalist")),
    "tr": (("tr", "td", "th", "caption"), ("table",)),
    "td": (("td", "th", "caption"), ("table", "tr")),
    "th": (("td", "th", "caption"), ("table", "tr")),
    "thead": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "tr", "td", "th", "caption"), ("table",)),
}
WALLS = frozenset("table td th caption button object template html".split())
WIDEST = 80

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)


class Flow:
    """Text in lines: collapsed spaces, pending breaks, margins and list markers."""

    def __init__(self) -> None:
        self.parts: list[str] = []
        self.breaks, self.space = 0, False
        self.margins, self.marker = [""], ""

    def wait(self, breaks: int) -> None:
        self.breaks, self.space = max(self.breaks, breaks), False

    def _start(self) -> None:
        if self.parts and not self.breaks:
            if self.space:
                self.parts.append(" ")
        else:
            if self.parts:
                self.parts.append("\n" * self.breaks)
            self.parts.append(self.marker or self.margins[-1])
            self.marker = ""
        self.breaks, self.space = 0, False

    def text(self, value: str) -> None:
        words = _SPACE.split(value)
        inner = " ".join(word for word in words if word)
        self.space = self.space or words[0] == ""
        if inner:
            self._start()
            self.parts.append(inner)
            self.space = words[-1] == ""

    def lines(self, value: str) -> None:
        """Text whose spaces and line breaks are kept."""
        for i, line in enumerate(value.split("\n")):
            if i:
                self.breaks += 1
            if line:
                self._start()
                self.parts.append(line)

    def enter(self, marker: str) -> None:
        self.wait(1)
        self.marker = self.margins[-1] + marker
        self.margins.append(self.margins[-1] + " " * len(marker))

    def leave(self) -> None:
        if len(self.margins) > 1:
            self.margins.pop()
        self.marker = ""
        self.wait(1)

    def result(self) -> str:
        return "".join(self.parts).replace("\xa0", " ").rstrip()


class Grid:
    """Rows of a table while it is open."""

    def __init__(self) -> None:
        self.rows: list[dict[int, str]] = []
        self.held: dict[int, int] = {}

    def row(self) -> None:
        self.held = {column: left - 1 for column, left in self.held.items() if left > 1}
        self.rows.append({})

    def place(self, attributes: dict[str, str]) -> int:
        """The column of the next cell; the columns and rows it spans are kept free."""
        if not self.rows:
            self.row()
        row, column = self.rows[-1], 0
        if row:
            column = max(row) + 1
        while column in self.held:
            column += 1
        wide, high = (_number(attributes.get(name), 1, limit) for name, limit in (("colspan", 100), ("rowspan", 1000)))
        for other in range(column, column + wide):
            row[other] = ""
            if high > 1:
                self.held[other] = high
        return column

    def render(self) -> str:
        widths: Counter[int] = Counter()
        cut = [{column: text.split("\n") for column, text in row.items()} for row in self.rows]
        for row in cut:
            for column, lines in row.items():
                widths[column] = max(widths[column], *map(len, lines))
        used = [column for column in sorted(widths) if widths[column]]
        out = []
        for row in cut:
            for i in range(max((len(lines) for lines in row.values()), default=0)):
                cells = [row[c][i] if c in row and i < len(row[c]) else "" for c in used]
                line = "  ".join(cell.ljust(min(widths[c], WIDEST)) for cell, c in zip(cells, used, strict=True))
                out.append(line.rstrip())
        return "\n".join(line for line in out if line)


def _number(text: str | None, default: int, limit: int) -> int:
    return min(max(int(text), 1), limit) if text and text.isascii() and text.isdigit() and len(text) < 9 else default


def attributes_of(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), html.unescape(next(filter(None, values), "")))
    return found


class Page:
    """Open elements, flows and tables of one page."""

    def __init__(self) -> None:
        # Of each open element: its tag, whether it is displayed, and whether it shows text.
        self.open: list[tuple[str, bool, bool]] = []
        self.count: Counter[str] = Counter()
        self.flows, self.grids, self.cells = [Flow()], [], []
        self.numbers: list[int | None] = []
        self.pre = 0

    def shown(self) -> bool:
        if not self.open:
            return True
        name, displayed, seen = self.open[-1]
        return displayed and seen and name != "details-closed"

    def text(self, value: str) -> None:
        if not self.shown():
            return
        if self.grids and not self.cells[-1] and not value.strip():
            return
        value = html.unescape(value) if "&" in value else value
        self.flows[-1].lines(value) if self.pre else self.flows[-1].text(value)

    def _imply(self, tag: str) -> None:
        if tag in CLOSES:
            closing, walls = CLOSES[tag]
            if any(self.count[name] for name in closing):
                depth = len(self.open)
                for i in range(len(self.open) - 1, -1, -1):
                    name = self.open[i][0]
                    if name in walls:
                        break
                    if name in closing:
                        depth = i
                self._close_to(depth)
        elif tag in BLOCKS and self.count["p"]:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    self._close_to(i)
                    break
                if self.open[i][0] in WALLS:
                    break

    def start(self, tag: str, attributes: dict[str, str], closed: bool) -> None:
        self._imply(tag)
        parent = self.open[-1] if self.open else ("", True, True)
        displayed, seen = parent[1] and tag not in UNSEEN and "hidden" not in attributes, parent[2]
        for rule, value in _STYLE.findall(attributes.get("style", "")):
            if rule.lower() == "display" and value.lower() == "none":
                displayed = False
            elif rule.lower() == "visibility":
                seen = value.lower() not in ("hidden", "collapse")
        if tag == "dialog" and "open" not in attributes:
            displayed = False
        if parent[0] == "details-closed" and tag != "summary":
            displayed = False
        flow = self.flows[-1]
        if displayed:
            if tag == "br":
                flow.breaks, flow.space = flow.breaks + 1 if flow.parts else 0, False
            elif tag in BLOCKS:
                flow.wait(2 if tag in PARAGRAPHS and not (tag in LISTS and self.numbers) else 1)
        if tag in VOID or closed:
            return
        name = "details-closed" if tag == "details" and "open" not in attributes else tag
        self.open.append((name, displayed, seen))
        self.count[tag] += 1
        if tag in LISTS:
            self.numbers.append(_number(attributes.get("start"), 1, 10**8) if tag == "ol" else None)
        elif tag == "pre":
            self.pre += 1
        elif tag == "table":
            self.grids.append(Grid())
            self.cells.append([])
        elif tag == "tr" and self.grids and displayed:
            self.grids[-1].row()
        elif tag in CELLS and self.grids and displayed:
            self.cells[-1].append((self.grids[-1].place(attributes), len(self.flows), len(self.open)))
            self.flows.append(Flow())
        elif tag == "li" and displayed:
            number = self.numbers[-1] if self.numbers else None
            flow.enter("- " if number is None else f"{number}. ")
            if number is not None:
                self.numbers[-1] += 1

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {}, True)
        elif not self.count[tag]:
            if tag == "p" and self.shown():
                self.flows[-1].wait(2)
        else:
            for i in range(len(self.open) - 1, -1, -1):
                name = self.open[i][0]
                if name == tag or (name == "details-closed" and tag == "details"):
                    self._close_to(i)
                    break
                if name in ("td", "th", "caption", "table") and tag not in ("table", "tr", "thead", "tbody", "tfoot"):
                    break

    def _close_to(self, depth: int) -> None:
        while len(self.open) > depth:
            height = len(self.open)
            name, displayed, _ = self.open.pop()
            tag = "details" if name == "details-closed" else name
            self.count[tag] -= 1
            if tag in LISTS and self.numbers:
                self.numbers.pop()
            elif tag == "pre":
                self.pre -= 1
            elif tag in CELLS and self.cells and self.cells[-1] and self.cells[-1][-1][2] == height:
                column, flows, _ = self.cells[-1].pop()
                self.grids[-1].rows[-1][column] = self.flows[flows].result()
                del self.flows[flows:]
            elif tag == "table" and self.grids:
                self.cells.pop()
                text = self.grids.pop().render()
                if text and displayed:
                    self.flows[-1].wait(2)
                    self.flows[-1].lines(text)
            elif tag == "li" and displayed:
                self.flows[-1].leave()
            if displayed and tag in BLOCKS:
                self.flows[-1].wait(2 if tag in PARAGRAPHS and not (tag in LISTS and self.numbers) else 1)

    def result(self) -> str:
        self._close_to(0)
        return self.flows[0].result()


def _tag_end(source: str, at: int, missing: set[str]) -> int:
    """The place of the ``>`` that ends a tag; quotes may hold others."""
    plain = source.find(">", at)
    while True:
        stop = _STOP.search(source, at)
        if not stop:
            return plain if plain >= 0 else len(source)
        if stop[0] == ">":
            return stop.start()
        close = -1 if stop[0] in missing else source.find(stop[0], stop.end())
        if close < 0:
            missing.add(stop[0])
            return plain if plain >= 0 else len(source)
        at = close + 1


def render(source: str | None) -> str:
    """The visible text of one page."""
    page, at, missing = Page(), 0, set()
    source = source or ""
    while at < len(source):
        mark = source.find("<", at)
        if mark < 0:
            page.text(source[at:])
            break
        if mark > at:
            page.text(source[at:mark])
        if source.startswith("<!--", mark):
            end = source.find("-->", mark + 4)
            at = len(source) if end < 0 else end + 3
            continue
        closing = source.startswith("</", mark)
        name = _NAME.match(source, mark + 1 + closing)
        if not name:
            if source[mark + 1 : mark + 2] in ("!", "?", "/"):
                end = source.find(">", mark)
                at = len(source) if end < 0 else end + 1
            else:
                page.text("&lt;")
                at = mark + 1
            continue
        tag, end = name[0].lower(), _tag_end(source, name.end(), missing)
        at = end + 1
        if closing:
            page.end(tag)
            continue
        inside = source[name.end() : end]
        page.start(tag, attributes_of(inside) if inside.strip(" \t\r\n\f/") else {}, tag == "svg" and inside.endswith("/"))
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(source, at)
            stop = close.start() if close else len(source)
            page.text(source[at:stop])
            at = stop
    return page.result()


def visible_text(column: Column) -> Column:
    """Rendered text of a column of pages."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(render)

    run.__annotations__ = {"pages": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(column)


def extract_text(pages: DataFrame, column: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``column`` in ``into``."""
    return pages.withColumn(into, visible_text(F.col(column).cast("string")))
