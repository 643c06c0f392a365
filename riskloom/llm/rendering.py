"""Visible text of web pages as a reader would see it laid out.

A tree builder closes elements that HTML lets authors leave open, visibility
rules drop what no reader sees, and the tree is set as text: blocks on lines of
their own, lists with marks and indents, tables with aligned columns.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import map_batches

# Fixed values of HTML: elements by what they mean for structure and layout.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
RAW = set("script style textarea title xmp".split())
HIDDEN = set("head script style template noscript title meta link iframe object svg datalist".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure".split())
BLOCK = SPACED | set("html body address article aside details div dd dt fieldset figcaption footer form header "
                     "hr li main nav section summary tr caption thead tbody tfoot option".split())
CLOSES = {  # a start tag closes these if they are open, but not beyond the barrier
    **dict.fromkeys(BLOCK - {"html", "body", "tr", "thead", "tbody", "tfoot", "caption", "option"}, ({"p"}, {"button", "table"})),
    "li": ({"li", "p"}, {"ul", "ol"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "tr": ({"tr", "td", "th", "caption", "p"}, {"table"}), "td": ({"td", "th", "p"}, {"tr", "table"}),
    "th": ({"td", "th", "p"}, {"tr", "table"}),
    **dict.fromkeys(["thead", "tbody", "tfoot"], ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "p"}, {"table"})),
    "body": ({"head"}, set()),
}
IN_HEAD = set("base basefont bgsound head link meta noframes noscript script style template title".split())
BARRIERS = {"table", "td", "th", "html", "body"}  # an end tag of something else does not reach beyond
MOST_SPANNED = {"colspan": 1000, "rowspan": 65534}  # fixed values of HTML
GAP = 2  # between columns
CALLS = 4  # of Python functions for a level of the tree, at most

# A quote counts only right after "="; elsewhere it is part of a name or value.
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]++)"""
NAMED = rf"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+{VALUE}?+)?+"""
TOKEN = re.compile(rf"""<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{NAMED})*+)>""", re.S)
UNCLOSED = re.compile(r"<!--.*\Z", re.S)
ATTRIBUTE = re.compile(rf"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({VALUE}))?""")
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)
    holds_cells: bool = False  # cells of the row that it is in are inside of it


def attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(source)}


class Builder:
    """Builds the tree of a page, whatever is missing or unbalanced in it."""

    def __init__(self) -> None:
        self.open = [Node("html")]
        self.tags = Counter()  # of what is open
        self.deepest = 1

    def enter(self, node: Node) -> None:
        self.open.append(node)
        self.tags[node.tag] += 1
        self.deepest = max(self.deepest, len(self.open))

    def leave(self, depth: int) -> None:
        """Close what is open from ``depth`` on."""
        self.tags.subtract(n.tag for n in self.open[depth:])
        del self.open[depth:]

    def text(self, data: str) -> None:
        if data:
            if data.strip(" \t\r\n\f"):
                self.leave_head()
            self.open[-1].children.append(html.unescape(data))

    def leave_head(self) -> None:
        """What cannot stand in a head ends it, and the body begins."""
        if self.open[-1].tag == "head":
            self.leave(len(self.open) - 1)
            body = Node("body")
            self.open[-1].children.append(body)
            self.enter(body)

    def start(self, tag: str, source: str) -> None:
        if tag == "html":
            self.open[0].attributes |= attributes(source)
            return
        if tag not in IN_HEAD and tag != "body":
            self.leave_head()
        if tag in CLOSES:
            closed, barrier = CLOSES[tag]
            some = any(self.tags[t] for t in closed)
            for depth in range(len(self.open) - 1, 0, -1) if some else ():
                if self.open[depth].tag in barrier:
                    break
                if self.open[depth].tag in closed:
                    least = depth
                    while least > 1 and self.open[least - 1].tag in closed:
                        least -= 1
                    self.leave(least)
                    break
        node = Node(tag, attributes(source))
        self.open[-1].children.append(node)
        if tag in ("td", "th"):
            for outer in reversed(self.open):
                if outer.tag == "table" or outer.holds_cells:
                    break
                outer.holds_cells = True
        if tag not in VOID and not source.rstrip().endswith("/"):
            self.enter(node)

    def end(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, 0, -1) if self.tags[tag] else ():
            if self.open[depth].tag == tag:
                self.leave(depth)
                return
            if self.open[depth].tag in BARRIERS and tag not in BARRIERS | {"tr", "thead", "tbody", "tfoot"}:
                return


def built(page: str) -> Builder:
    builder, at = Builder(), 0
    last = page.rfind(">")  # beyond it no tag is closed, so none is looked for
    while token := TOKEN.search(page, at) if at <= last else UNCLOSED.search(page, at):
        builder.text(page[at:token.start()])
        at = token.end()
        if token.re is UNCLOSED or token[2] is None:  # comment or declaration
            continue
        tag = token[2].lower()
        if token[1]:
            builder.end(tag)
            continue
        builder.start(tag, token[3])
        if tag in RAW:
            closing = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at) if at <= last else None
            inner, at = (page[at:closing.start()], closing.end()) if closing else (page[at:], len(page))
            if tag not in HIDDEN:
                builder.text(inner)
            builder.end(tag)
    builder.text(page[at:])
    return builder


def visible(node: Node) -> bool:
    a = node.attributes
    return not (node.tag in HIDDEN or "hidden" in a or (node.tag == "dialog" and "open" not in a) or a.get("aria-hidden") == "true"
                or node.tag == "input" or UNSEEN.search(a.get("style", "")))


class Page:
    """Lines of a page; ``gap`` remembers that a blank line is due."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False

    def write(self, data: str, keep: bool) -> None:
        if keep:
            first, *rest = data.split("\n")
            self.line.append(first)
            for more in rest:
                self.flush(keep=True)
                self.line.append(more)
        else:
            self.line.append(re.sub(r"[ \t\r\n\f]+", " ", data))

    def flush(self, spaced: bool = False, keep: bool = False) -> None:
        """End the line; empty ones are dropped unless kept."""
        whole = "".join(self.line)
        whole = whole if keep else re.sub(" +", " ", whole).strip(" ")
        self.line = []
        if whole or keep:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.lines.append(whole)
        self.gap |= spaced

    def place(self, lines: list[str], spaced: bool) -> None:
        self.flush(spaced)
        if lines:
            if self.gap and self.lines:
                self.lines.append("")
            self.lines += lines
            self.gap = spaced


def _span(cell: Node, name: str) -> int:
    """How many columns or rows a cell takes, within HTML's bounds; rowspan 0 is all that follow."""
    given, most = cell.attributes.get(name, "1").strip(), MOST_SPANNED[name]
    if not given.isdecimal():
        return 1
    return min(int(given[:6]), most) or (1 if name == "colspan" else most)


def _placed(rows: list[list[tuple[list[str], int, int]]]) -> list[list[tuple[int, int, list[str]]]]:
    """(column, end, lines) of each cell of each row, past the cells that reach down from rows above."""
    taken: list[tuple[int, int, int]] = []  # columns from, to, and the first row below
    grid = []
    for number, row in enumerate(rows):
        found, at, above = [], 0, [t for t in taken if t[2] > number] if row else []
        waiting = iter(above)
        block = next(waiting, None)
        for lines, columns, down in row:
            while block and block[0] <= at:
                at, block = max(at, block[1]), next(waiting, None)
            found.append((at, at + columns, lines))
            if down > 1:
                above.append((at, at + columns, number + down))
            at += columns
        grid.append(found)
        if row:
            taken = []
            for start, end, until in sorted(above):
                if taken and taken[-1][1] == start and taken[-1][2] == until:
                    start = taken.pop()[0]
                taken.append((start, end, until))
    return grid


def _aligned(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """The lines of a table: every column as wide as its widest cell, a cell's lines below one another."""
    grid = _placed(rows)
    edges = sorted({edge for row in grid for start, end, _ in row for edge in (start, end)})
    index = {edge: i for i, edge in enumerate(edges)}
    starts = [0] * max(1, len(edges))  # where each column begins
    reach: dict[int, list[tuple[int, int]]] = {}  # by end: begin and width of the cells that end there
    for row in grid:
        for start, end, lines in row:
            reach.setdefault(index[end], []).append((index[start], max(map(len, lines), default=0)))
    for i in range(1, len(edges)):
        starts[i] = max([starts[i - 1], *[starts[begin] + width + GAP for begin, width in reach.get(i, [])]])
    made = []
    for row in grid:
        if not any(lines for _, _, lines in row):
            continue
        for k in range(max(len(lines) for _, _, lines in row)):
            line = ""
            for start, _, lines in row:
                if k < len(lines) and lines[k]:
                    line = line.ljust(starts[index[start]]) + lines[k]
            made.append(line.rstrip())
    return made


def table_lines(node: Node) -> list[str]:
    """Captions first, then rows of aligned cells, which keep their blocks, lists and spans.

    What is neither a row nor a cell comes first too; cells inside of it are cells.
    """
    rows, above = [], []

    def cells(row: Node) -> list[tuple[list[str], int, int]]:
        found, waiting = [], row.children[::-1]
        while waiting:
            child = waiting.pop()
            if isinstance(child, str):
                above.extend([child.strip()] if child.strip() else [])
            elif visible(child) and child.tag in ("td", "th"):
                found.append((render(child), _span(child, "colspan"), _span(child, "rowspan")))
            elif visible(child) and child.holds_cells:
                waiting += child.children[::-1]
            elif visible(child):
                above.extend(x for x in render(Node("div", children=[child])) if x)
        return found

    def collect(part: Node) -> None:
        for child in part.children:
            if isinstance(child, str):
                above.extend([child.strip()] if child.strip() else [])
            elif visible(child) and child.tag == "tr":
                rows.append(cells(child))
            elif visible(child) and child.tag in ("thead", "tbody", "tfoot"):
                collect(child)
            elif visible(child):
                above.extend(x for x in render(Node("div", children=[child])) if x)

    collect(node)
    return above + _aligned(rows)


def list_lines(node: Node) -> list[str]:
    lines, number = [], int(s) if (s := node.attributes.get("start", "1")).isdecimal() else 1
    for child in node.children:
        if isinstance(child, Node) and not visible(child):
            continue
        body = render(child) if isinstance(child, Node) else [child.strip()] if child.strip() else []
        if not body:
            continue
        mark = ""
        if isinstance(child, Node) and child.tag == "li":
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
        indent = " " * (len(mark) or 2)
        lines += [(mark if i == 0 else indent) + x if x else "" for i, x in enumerate(body)]
    return lines


def render(node: Node, keep: bool = False) -> list[str]:
    """The lines of ``node``."""
    page = Page()

    def visit(part: Node, keep: bool) -> None:
        for child in part.children:
            if isinstance(child, str):
                page.write(child, keep)
            elif not visible(child):
                continue
            elif child.tag == "br":
                page.flush(keep=True) if "".join(page.line).strip() else page.flush()
            elif child.tag == "hr":
                page.flush(spaced=True)
            elif child.tag == "img":
                page.write(child.attributes.get("alt", ""), False)
            elif child.tag in ("ul", "ol", "menu", "table"):
                page.place(table_lines(child) if child.tag == "table" else list_lines(child), True)
            elif child.tag == "blockquote":
                page.place(["  " + x if x else "" for x in render(child)], True)
            elif child.tag in BLOCK:
                inner = keep or child.tag == "pre"
                page.flush(child.tag in SPACED)
                visit(child, inner)
                page.flush(child.tag in SPACED, inner and bool("".join(page.line).strip()))
            else:
                if child.tag in ("td", "th"):
                    page.write(" ", False)
                visit(child, keep)

    visit(node, keep or node.tag == "pre")
    page.flush()
    return [x.rstrip(" \t") for x in page.lines]


def page_text(source: str) -> str:
    """The visible text; Python may call as deep as the page nests, which takes no C stack."""
    builder, limit = built(source), sys.getrecursionlimit()
    try:
        sys.setrecursionlimit(limit + CALLS * builder.deepest)
        return "\n".join(render(builder.open[0]))
    finally:
        sys.setrecursionlimit(limit)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_lines), one row per row of ``pages``, repeated ones too.

    A null page gives an empty text.  Columns other than these are ignored.
    """
    def run(batch):
        texts = [page_text(x) for x in batch["html"]]
        yield {"page_id": batch["page_id"], "url": batch["url"], "text": texts,
               "n_lines": [t.count("\n") + 1 if t else 0 for t in texts]}

    given = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                         F.coalesce("html", F.lit("")).alias("html"))
    return map_batches(given, run, "page_id bigint, url string, text string, n_lines bigint")
