"""Visible text of web pages, by layout-aware rendering.

A page is tokenised and built into a tree with the implied ends of HTML (a list item ends the one before, a block
ends a paragraph, ...). The tree is then laid out: hidden elements are left out, blocks are set apart by line breaks or
blank lines, list items get bullets or numbers and indents, table cells are aligned in columns, and
preformatted text keeps its spaces. Everything visible is emitted, boilerplate too: of a form also the values, the text of
text areas, and the options that a list shows. Nothing recurses, so depth has no limit.

Visibility: ``display: none`` (or ``hidden``, where no style gives another display) and closed dialogs take whole elements away;
``visibility: hidden`` takes text away except below ``visibility: visible``; of closed details the summary stays.

Edge cases: null and empty pages give an empty text; unclosed, misnested and unknown tags are taken as
browsers mostly take them; ids may repeat or be null; other columns are ignored.
"""

from __future__ import annotations

import html
import re
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import slices, text_or_empty

COMMENT = re.compile(r"<!--.*?(?:-->|\Z)", re.S)
NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
REST = re.compile(r"((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
# Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
HIDDEN = frozenset("head script style template noscript iframe object audio video canvas svg math datalist title meta link".split())
IN_HEAD = frozenset("base basefont bgsound link meta title style script noscript template noframes head html".split())
SILENT = frozenset("hidden password checkbox radio file range color".split())  # inputs that show no text
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset form hr article section".split())
BLOCK = SPACED | frozenset("html body div main header footer nav aside address li dt dd tr caption thead tbody tfoot figcaption details summary center legend".split())
ENDS_P = BLOCK - frozenset("html body li dt dd tr caption thead tbody tfoot summary legend".split())
#: An element's start ends an open one of these, unless one of the second group stands between.
CELL_GROUP, ROW_GROUP = frozenset("td th".split()), frozenset("thead tbody tfoot".split())
IMPLIED: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(["li"]), frozenset("ul ol menu".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "td": (CELL_GROUP, frozenset("tr table".split())),
    "th": (CELL_GROUP, frozenset("tr table".split())),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "thead": (ROW_GROUP, frozenset(["table"])),
    "tbody": (ROW_GROUP, frozenset(["table"])),
    "tfoot": (ROW_GROUP, frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "optgroup": (frozenset("option optgroup".split()), frozenset(["select"])),
}
SCOPE = frozenset("table td th html".split())
WIDEST = 80  # characters of a table column; longer cells are wrapped at spaces
MOST_COLUMNS, MOST_ROWS = 1000, 65534  # fixed values: bounds of colspan and rowspan in HTML


class Node:
    __slots__ = ("attributes", "children", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children = tag, attributes, []

    def get(self, name: str) -> str | None:
        for m in ATTRIBUTE.finditer(self.attributes):
            if m[1].lower() == name:
                return next((html.unescape(v) for v in m.groups()[1:] if v is not None), "")
        return None

    def style(self) -> dict[str, str]:
        """Declarations of the style attribute; the last of a property counts."""
        pairs = (d.split(":", 1) for d in (self.get("style") or "").lower().split(";") if ":" in d)
        return {k.strip(): v.replace("!important", "").strip() for k, v in pairs}

    def hidden(self) -> bool:
        if self.tag in HIDDEN:
            return True
        if self.tag == "dialog" and self.get("open") is None:
            return True
        if not self.attributes:
            return False
        low = self.attributes.lower()
        display = self.style().get("display") if "style" in low else None
        if display is not None:
            return display == "none"
        return "hidden" in low and (self.get("hidden") is not None or self.get("aria-hidden") == "true")

    def visible(self, inherited: bool) -> bool:
        if not self.attributes or "visibility" not in self.attributes.lower():
            return inherited
        own = self.style().get("visibility")
        return inherited if own in (None, "inherit") else own == "visible"


class Open:
    """The elements that are open, with places of the blocks among them and a count of each tag."""

    def __init__(self, root: Node):
        self.nodes, self.marks, self.count = [root], [], Counter()

    def push(self, node: Node) -> None:
        if node.tag in BLOCK or node.tag in CELL_GROUP:
            self.marks.append(len(self.nodes))
        self.nodes.append(node)
        self.count[node.tag] += 1

    def cut(self, i: int) -> None:
        """Close element i and all in it."""
        for node in self.nodes[i:]:
            self.count[node.tag] -= 1
        del self.nodes[i:]
        while self.marks and self.marks[-1] >= i:
            self.marks.pop()

    def text(self, s: str) -> None:
        if self.nodes[-1].tag == "head" and s.strip():
            self.cut(len(self.nodes) - 1)
        self.nodes[-1].children.append(s)

    def close(self, tag: str) -> None:
        if not self.count[tag]:
            if tag == "p":
                self.nodes[-1].children.append(Node("p"))
            return
        for i in range(len(self.nodes) - 1, 0, -1):
            if self.nodes[i].tag == tag:
                return self.cut(i)
            if self.nodes[i].tag in SCOPE and tag not in ("table", "tr", "td", "th", "thead", "tbody", "tfoot", "html", "body"):
                return None
        return None

    def imply(self, tag: str) -> None:
        """Close what the start of ``tag`` ends."""
        if self.nodes[-1].tag == "head" and tag not in IN_HEAD:
            self.cut(len(self.nodes) - 1)
        if tag in ENDS_P and self.count["p"] and self.marks and self.nodes[self.marks[-1]].tag == "p":
            self.cut(self.marks[-1])
        if tag in IMPLIED:
            ends, stop = IMPLIED[tag]
            if any(self.count[t] for t in ends):
                for i in range(len(self.nodes) - 1, 0, -1):
                    if self.nodes[i].tag in ends:
                        return self.cut(i)
                    if self.nodes[i].tag in stop:
                        return None
        return None


class Tokens:
    """The tags of a page, in time that grows with its length, well formed or not.

    A ``<`` whose tag never ends is text. Only a failed tag needs to look further than its end, so at the first one a table is made:
    for each ``>`` and quote, where a tag that comes to it outside quotes ends.
    """

    def __init__(self, page: str):
        self.page, self.last, self.marks = page, page.rfind(">"), None

    def table(self) -> None:
        codes = np.frombuffer(self.page.encode("utf-32-le", "surrogatepass"), "<u4")
        self.marks = np.flatnonzero((codes == 62) | (codes == 34) | (codes == 39))
        self.stops = np.flatnonzero((codes == 62) | (codes == 47) | np.isin(codes, [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
        self.ends = array("q", bytes(8 * (len(self.marks) + 1)))
        self.ends[len(self.marks)] = -1
        following = {34: len(self.marks), 39: len(self.marks)}
        kinds = codes[self.marks].tolist()
        for k in range(len(kinds) - 1, -1, -1):
            kind = kinds[k]
            if kind == 62:
                self.ends[k] = int(self.marks[k])
            else:
                self.ends[k] = self.ends[min(following[kind] + 1, len(kinds))]
                following[kind] = k

    def tag(self, at: int) -> tuple[int, bool, str, str] | None:
        """(end, whether it closes, name, attributes) of the tag at a place."""
        page = self.page
        if self.marks is None:
            m = NAME.match(page, at)
            if m is None:
                return None
            rest = REST.match(page, m.end())
            if rest is not None:
                return rest.end(), bool(m[1]), m[2].lower(), rest[1]
            self.table()
        closes = page.startswith("/", at + 1)
        first = at + 1 + closes
        if not (page[first : first + 1].isascii() and page[first : first + 1].isalpha()):
            return None
        k = int(np.searchsorted(self.stops, first))
        if k == len(self.stops):
            return None
        stop = int(self.stops[k])
        end = self.ends[int(np.searchsorted(self.marks, stop))]
        return None if end < 0 else (end + 1, closes, page[first:stop].lower(), page[stop:end])

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, whether it closes, name, attributes) of the next token from a place on; comments and declarations have no name."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            if page.startswith("<!--", i):
                return i, COMMENT.match(page, i).end(), False, None, ""
            if i < self.last:
                if page.startswith(("!", "?"), i + 1):
                    return i, page.find(">", i) + 1, False, None, ""
                found = self.tag(i)
                if found is not None:
                    return i, *found
            at = i + 1
        return None


def build(page: str) -> Node:
    """The tree of a page; text children are strings."""
    root = Node("#root")
    opened, at, n, tokens = Open(root), 0, len(page), Tokens(page)
    while at < n:
        m = tokens.next(at)
        if m is None:
            opened.text(page[at:])
            break
        start, end, closes, tag, attributes = m
        if start > at:
            opened.text(page[at:start])
        at = end
        if tag is None:
            continue
        if closes:
            opened.close(tag)
            continue
        opened.imply(tag)
        node = Node(tag, attributes)
        opened.nodes[-1].children.append(node)
        if tag in VOID or attributes.endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            node.children.append(page[at : end.start() if end else n])
            at = end.end() if end else n
            continue
        opened.push(node)
    return root


def shown_options(select: Node) -> list[str]:
    """Texts of the options that a closed list shows: the selected one, or the first; an open list shows all."""
    texts, chosen, work = [], [], list(reversed(select.children))
    while work:
        node = work.pop()
        if isinstance(node, str) or node.hidden():
            continue
        if node.tag == "option":
            words, inner = [], list(reversed(node.children))
            while inner:
                x = inner.pop()
                if isinstance(x, str):
                    words.append(html.unescape(x))
                else:
                    inner.extend(reversed(x.children))
            texts.append(" ".join("".join(words).split()))
            if node.get("selected") is not None:
                chosen.append(texts[-1])
        else:
            work.extend(reversed(node.children))
    size = select.get("size") or ""
    if select.get("multiple") is not None or size.isdigit() and int(size) > 1:
        return texts
    return chosen[-1:] or texts[:1]


class Flow:
    """Lines under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = 0
        self.indent = ""
        self.mark = ""  # of a list item whose text is still to come

    def text(self, s: str, keep: bool) -> None:
        if keep:
            parts = s.split("\n")
            for i, part in enumerate(parts):
                if i:
                    self.line(True)
                self.inline.append(part)
        elif s:
            self.inline.append(s)

    def line(self, keep: bool = False) -> None:
        """End the line, if it has anything."""
        joined = "".join(self.inline)
        self.inline.clear()
        body = joined.rstrip() if keep else " ".join(joined.split())
        if not body and not keep:
            return
        if self.gap and self.lines:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        self.lines.append((self.indent + self.mark + body).rstrip())
        if self.mark:
            self.indent += " " * len(self.mark)
            self.mark = ""

    def block(self, spaced: bool) -> None:
        self.line()
        if spaced:
            self.gap = 1

    def done(self) -> str:
        self.line()
        return "\n".join(self.lines)


def _wrapped(cell: str) -> list[str]:
    """Lines of a cell, none longer than ``WIDEST`` unless a word is."""
    out = []
    for line in cell.split("\n"):
        while len(line) > WIDEST:
            cut = line.rfind(" ", 1, WIDEST + 1)
            cut = line.find(" ", WIDEST) if cut < 0 else cut
            if cut < 0:
                break
            out.append(line[:cut].rstrip())
            line = line[cut + 1 :]
        out.append(line)
    return out


def grid(rows: list[list[tuple[str, int, int]]]) -> list[dict[int, str]]:
    """Cells (text, columns, rows) by the columns where they begin; cells that reach down push later ones aside.

    Taken columns are kept as ranges, so a span costs no more than a cell.
    """
    out, taken = [], []  # ranges (first, after the last, row from which it is free), in order and apart
    for number, row in enumerate(rows):
        taken = [t for t in taken if t[2] > number]
        line, i, k = {}, 0, 0  # k: ranges before it end at or before column i
        for text, columns, down in row:
            while k < len(taken) and taken[k][0] <= i:
                i = max(i, taken[k][1])
                k += 1
            line[i] = text
            after, until, new = i + columns, min(number + down, len(rows)), []
            j, at = k, i
            while j < len(taken) and taken[j][0] < after:
                if at < taken[j][0]:
                    new.append((at, taken[j][0], until))
                new.append(taken[j])
                at = max(at, taken[j][1])
                j += 1
            if at < after:
                new.append((at, after, until))
            if k and new and taken[k - 1][1] == new[0][0] and taken[k - 1][2] == new[0][2]:
                new[0] = (taken[k - 1][0], new[0][1], new[0][2])
                k -= 1
                taken[k:j] = new
            else:
                taken[k:j] = new
            k += len(new) - (1 if new and new[-1][1] > after else 0)
            i = after
        out.append(line)
    return out


#: A table is aligned where that takes at most so many characters, or so many times its text.
ROOM, TIMES = 1 << 20, 50


def aligned(rows: list[dict[int, str]]) -> list[str]:
    """Table rows as lines, cells padded to their column; columns where no cell begins are left out. Tables that would be mostly padding have their cells side by side."""
    place = {c: n for n, c in enumerate(sorted({c for row in rows for c in row}))}
    split = [{place[i]: _wrapped(c) for i, c in row.items()} for row in rows]
    width: dict[int, int] = {}
    for row in split:
        for i, cell in row.items():
            width[i] = min(WIDEST, max(width.get(i, 0), max(map(len, cell))))
    columns = len(width)
    size, padded = sum(len(x) for row in split for cell in row.values() for x in cell), len(split) * (sum(width.values()) + 3 * columns)
    apart = padded > max(ROOM, TIMES * size)
    out = []
    for cells in split:
        last = max(cells, default=-1) + 1 if apart else columns
        for k in range(max((len(c) for c in cells.values()), default=0)):
            if apart:
                parts = [cells[i][k] if k < len(cells[i]) else "" for i in sorted(cells)]
            else:
                parts = [(cells[i][k] if i in cells and k < len(cells[i]) else "").ljust(width[i]) for i in range(last)]
            out.append(" | ".join(parts).rstrip())
    return out


def render(root: Node) -> str:
    """Visible text of a tree."""
    flow, pre = Flow(), 0
    lists: list[list] = []  # [ordered, number]
    tables: list[tuple[Flow, list[list[tuple[str, int, int]]], list]] = []
    work: list[tuple[object, bool, bool]] = [(root, False, True)]  # node, leaving it, and whether its text shows
    saved: list[tuple[str, str]] = []
    while work:
        node, leaving, shown = work.pop()
        if isinstance(node, str):
            if not shown:
                continue
            text = html.unescape(node) if "&" in node else node
            if not tables or flow is not tables[-1][0] or text.strip():
                flow.text(text, pre > 0)
            continue
        tag = node.tag
        if not leaving:
            if node.hidden():
                continue
            shown = node.visible(shown)
            if tag == "br":
                flow.line(True)
                continue
            if tag == "hr":
                flow.block(True)
                flow.text("---", False)
                flow.block(True)
                continue
            if tag == "img":
                alt = node.get("alt")
                if alt and shown:
                    flow.text(f" {alt} ", False)
                continue
            if tag == "input":
                kind = (node.get("type") or "text").lower()
                value = node.get("alt") if kind == "image" else None if kind in SILENT else node.get("value") or node.get("placeholder")
                if value and shown:
                    flow.text(f" {value} ", False)
                continue
            if tag == "textarea":
                text = html.unescape("".join(node.children)) or node.get("placeholder") or ""
                if text.strip() and shown:
                    flow.line()
                    flow.text(text.strip("\n"), True)
                    flow.line(True)
                continue
            if tag == "select":
                if shown:
                    flow.text(" " + " ".join(shown_options(node)) + " ", False)
                continue
            if tag in BLOCK:
                flow.block(tag in SPACED and not (tag in ("ul", "ol") and lists))
            if tag in ("ul", "ol", "menu"):
                start = node.get("start") or "1"
                lists.append([tag == "ol", int(start) if start.isdigit() and len(start) < 10 else 1])
            elif tag == "li":
                saved.append((flow.indent, flow.mark))
                if lists and lists[-1][0]:
                    flow.mark = f"{lists[-1][1]}. "
                    lists[-1][1] += 1
                else:
                    flow.mark = "* "
            elif tag in ("dd", "blockquote"):
                saved.append((flow.indent, flow.mark))
                flow.indent += "  "
            elif tag == "pre":
                pre += 1
            elif tag == "table":
                tables.append((flow, [], lists))
                lists = []
            elif tag == "tr" and tables:
                tables[-1][1].append([])
            elif tag in CELL_GROUP and tables:
                flow = Flow()
            work.append((node, True, shown))
            inner = node.children
            if tag == "details" and node.get("open") is None:
                inner = [c for c in inner if isinstance(c, Node) and c.tag == "summary"][:1]
            work.extend((c, False, shown) for c in reversed(inner))
            continue
        if tag in CELL_GROUP and tables:
            cell = flow.done()
            flow = tables[-1][0]
            if not tables[-1][1]:
                tables[-1][1].append([])
            columns, down = (_span(node, name, most) for name, most in (("colspan", MOST_COLUMNS), ("rowspan", MOST_ROWS)))
            tables[-1][1][-1].append((cell, max(1, columns), down or MOST_ROWS))
            continue
        if tag == "table":
            flow, rows, lists = tables.pop()
            flow.line()
            for line in aligned([r for r in grid(rows) if any(r.values())]):
                flow.text(line, True)
                flow.line(True)
            flow.block(True)
            continue
        if tag == "pre":
            flow.line(True)
            pre -= 1
        if tag in BLOCK:
            flow.block(tag in SPACED and not (tag in ("ul", "ol") and len(lists) > 1))
        if tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag in ("li", "dd", "blockquote"):
            flow.indent, flow.mark = saved.pop()
    while tables:
        flow, rows, _ = tables.pop()
    return flow.done()


def _span(node: Node, name: str, most: int) -> int:
    value = (node.get(name) or "1").strip() if node.attributes else "1"
    return min(int(value[:9]), most) if value.isascii() and value.isdigit() else 1


def visible_text(page: str | None) -> str:
    return render(build(page)) if page else ""


def extract(pages: DataFrame, *, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """Rows (page_id, text, n_chars, n_lines), one for each input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            texts = [visible_text(p) for p in b.column(1).to_pylist()]
            cols = [b.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["page_id", "text", "n_chars", "n_lines"])

    source = pages.select(F.col(id_column).cast("long").alias("page_id"), text_or_empty(html_column).alias("html"))
    return source.mapInArrow(run, "page_id long, text string, n_chars long, n_lines long")
