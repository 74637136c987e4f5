"""HTML extraction by layout: a tree with implied tags, visibility rules, and rendering in blocks, lists and aligned tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import zip_longest

import pyarrow as pa
from pyspark.sql import DataFrame

from lanecast.llm.words import map_batches

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset("head script style template noscript title iframe object datalist audio video canvas".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure".split())
CLOSES_P = BLOCKS - frozenset("body html li dd dt option optgroup legend summary".split())
#: An opening tag closes the nearest of these that is open, unless one of the fences lies between.
IMPLIED = {
    "li": ("li", ("ul", "ol", "menu")),
    "dt": ("dt dd", ("dl",)),
    "dd": ("dt dd", ("dl",)),
    "tr": ("tr", ("table",)),
    "td": ("td th", ("tr", "table")),
    "th": ("td th", ("tr", "table")),
    "thead": ("tr thead tbody tfoot caption colgroup", ("table",)),
    "tbody": ("tr thead tbody tfoot caption colgroup", ("table",)),
    "tfoot": ("tr thead tbody tfoot caption colgroup", ("table",)),
    "option": ("option", ("select", "datalist", "optgroup")),
    "optgroup": ("option optgroup", ("select",)),
}
#: What is open directly in a table, and what each part of a table may stand in. Anything else there goes before the table.
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
STANDS_IN = {part: ("table",) for part in ("caption", "colgroup", "col", "thead", "tbody", "tfoot")}
STANDS_IN |= {"tr": ("thead", "tbody", "tfoot", "table"), "td": ("tr", "thead", "tbody", "tfoot", "table"), "th": ("tr", "thead", "tbody", "tfoot", "table")}
#: Parts of drawings and formulas that are not drawn, and those whose text stands apart from that of their neighbours.
UNDRAWN = frozenset("desc metadata defs symbol annotation annotation-xml".split())
APART = frozenset("text mtd".split())
SCRIPTS = frozenset("mfrac msup msub msubsup mroot munder mover munderover".split())
_BARRIERS = frozenset("table td th caption button object template html".split())
_SPACES = re.compile(r"[ \t\n\r\f]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|content-visibility\s*:\s*hidden", re.I)
_VISIBILITY = re.compile(r"(?<![\w-])visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
#: Nesting from which text is emitted without layout.
DEEPEST = 400


class Node:
    __slots__ = ("tag", "attributes", "children", "shown")

    def __init__(self, tag: str, attributes: dict):
        self.tag, self.attributes, self.children, self.shown = tag, attributes, [], True


class TreeBuilder(HTMLParser):
    """Builds a tree from tags as they come: end tags may be missing, and stray ones are passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html", {})
        self.open = [self.root]
        #: Where each tag is open below the root, so that no tag has to look through all that is open.
        self.places: dict[str, list[int]] = {}

    def _push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def _cut(self, at: int) -> None:
        while len(self.open) > at:
            self.places[self.open.pop().tag].pop()

    def _nearest(self, tags) -> int:
        """Where the innermost of these tags is open; 0 if none is."""
        return max((places[-1] for places in map(self.places.get, tags) if places), default=0)

    def _close(self, tags, fences) -> None:
        at = self._nearest(tags)
        if at and at >= self._nearest(fences):
            self._cut(at)

    def handle_starttag(self, tag, attributes):
        if tag in ("html", "body"):
            # once is enough; what hides the body hides the page
            if tag == "body" and not self._nearest(("body",)):
                self._close(("head",), ())
                self._open("body", attributes)
            return
        if self.open[-1].tag == "head" and tag not in ("title", "meta", "link", "script", "style", "base", "noscript", "template"):
            self._close(("head",), ())
        if tag in CLOSES_P:
            self._close(("p",), _BARRIERS)
        if tag in IMPLIED:
            closed, fences = IMPLIED[tag]
            self._close(closed.split(), fences)
        if tag == "table" and self.open[-1].tag in TABLE_PARTS:
            self._close(("table",), ())
        in_table = self.open[-1].tag in TABLE_PARTS
        if tag in STANDS_IN and self._table() is not None:
            self._table_part(tag)
        self._open(tag, attributes)
        if tag in UNDRAWN and self._foreign():
            self.open[-1].attributes["hidden"] = ""
        if tag in VOID or (tag == "form" and in_table):
            self._cut(len(self.open) - 1)

    def _table(self) -> int | None:
        """Where the innermost open table is, as seen from the last open tag."""
        at = self._nearest(("table",))
        return at if at > self._nearest(("template",)) else None

    def _table_part(self, tag) -> None:
        """Closes what a part of a table cannot stand in, and opens the body and row that it needs."""
        at = len(self.open) - 1
        while self.open[at].tag not in STANDS_IN[tag]:
            at -= 1
        self._cut(at + 1)
        if tag in ("tr", "td", "th") and self.open[-1].tag == "table":
            self._open("tbody", ())
        if tag in ("td", "th") and self.open[-1].tag != "tr":
            self._open("tr", ())

    def _foreign(self) -> bool:
        return self._nearest(("svg", "math")) > 0

    def _add(self, child) -> Node:
        """Puts a node or text into what is open, or before the table if it cannot stand in one; what it was put into."""
        parent, table = self.open[-1], None
        if parent.tag in TABLE_PARTS and (child.strip() if isinstance(child, str) else child.tag not in STANDS_IN and child.tag not in HIDDEN):
            table = self._table()
        if table is None:
            parent.children.append(child)
        else:
            # an open table is the last child of what it stands in
            parent = self.open[table - 1]
            parent.children.insert(len(parent.children) - 1, child)
        return parent

    def _open(self, tag, attributes):
        node = Node(tag, {name: value or "" for name, value in attributes})
        parent = self._add(node)
        own = _VISIBILITY.findall(node.attributes.get("style", ""))
        node.shown = own[-1].lower() in ("visible", "initial") if own else parent.shown
        self._push(node)

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        # a slash closes nothing in HTML but what is empty anyway; in drawings and formulas it does
        if tag not in VOID and self.open[-1].tag == tag and self._foreign():
            self._cut(len(self.open) - 1)

    def handle_endtag(self, tag):
        if tag == "br":
            self._add(Node("br", {}))
        elif tag == "p" and not self._nearest(("p",)):
            self._add(Node("p", {}))
        else:
            self._close((tag,), ("table",) if tag not in ("table", "body", "html") else ())

    def handle_data(self, data):
        self._add(data)


def parse(html: str) -> Node:
    """The tree of a page; anything at all gives one."""
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def visible(node: Node) -> bool:
    """False for what no reader sees with all below it: scripts and the like, hidden attributes, styles without display, hidden inputs.

    ``Node.shown`` tells whether its own text is visible: that is inherited, and a child of a hidden parent may be visible again.
    """
    attributes = node.attributes
    return not (
        node.tag in HIDDEN
        or "hidden" in attributes
        or (node.tag == "input" and attributes.get("type", "").lower() == "hidden")
        or _INVISIBLE.search(attributes.get("style", ""))
    )


class _Lines:
    """Lines of output; inline text is gathered until a break, blank lines never double."""

    def __init__(self):
        self.lines: list[str] = []
        self.run: list[str] = []
        self.blank = False

    def text(self, data: str, literal: bool) -> None:
        if literal:
            first, *rest = data.split("\n")
            self.run.append(first)
            for line in rest:
                self.end(True)
                self.run.append(line)
        else:
            self.run.append(_SPACES.sub(" ", data))

    def end(self, keep: bool = False) -> None:
        line = "".join(self.run)
        self.run = []
        line = line.rstrip() if keep else _SPACES.sub(" ", line).strip()
        if line or keep:
            self.add([line])

    def add(self, lines: list[str]) -> None:
        if self.blank and self.lines and lines:
            self.lines.append("")
        self.blank = False
        self.lines += lines

    def gap(self) -> None:
        self.end()
        self.blank = True


def _cells(node: Node, depth: int) -> tuple[list[str], list[list[str]]]:
    """Caption lines and rows of rendered cells of a table, inner tables being text of their cell. A spanning cell leaves the others empty."""
    caption, rows, stack = [], [], [node]
    while stack:
        item = stack.pop()
        inner = [child for child in item.children if isinstance(child, Node) and visible(child)]
        if item.tag != "tr":
            caption += [line for child in inner if child.tag == "caption" for line in render_lines(child, depth + 2)]
            stack += [child for child in reversed(inner) if child.tag in ("thead", "tbody", "tfoot", "tr")]
            continue
        row: list[str] = []
        for cell in inner:
            if cell.tag in ("td", "th"):
                row.append(" ".join(line for line in render_lines(cell, depth + 2) if line))
                span = cell.attributes.get("colspan", "1")
                row += [""] * (min(int(span), 1000) - 1 if span.isdigit() else 0)
        rows.append(row)
    return caption, [row for row in rows if any(row)]


def _table(node: Node, depth: int) -> list[str]:
    caption, rows = _cells(node, depth)
    widths = [max(map(len, column)) for column in zip_longest(*rows, fillvalue="")]
    lines = ["  ".join(cell.ljust(width) for cell, width in zip(row, widths)).rstrip() for row in rows]
    return caption + lines


def _render(node: Node, out: _Lines, literal: bool, depth: int) -> None:
    number = int(node.attributes["start"]) if node.tag == "ol" and node.attributes.get("start", "").isdigit() else 1
    for child in node.children:
        if isinstance(child, str):
            if node.shown:
                out.text(child, literal)
            continue
        if not visible(child):
            continue
        tag = child.tag
        if tag == "br":
            out.end(True)
        elif tag == "hr":
            out.gap()
        elif tag == "img":
            out.text(child.attributes.get("alt", "") if child.shown else "", False)
        elif tag == "input":
            out.text(" " + (child.attributes.get("value", "") if child.shown else "") + " ", False)
        elif depth > DEEPEST:
            out.end() if tag in BLOCKS else None
            out.text(" ".join(_strings(child)), False)
            out.end() if tag in BLOCKS else None
        elif tag == "table":
            out.gap()
            out.add(_table(child, depth))
            out.blank = True
        elif tag == "li":
            out.end()
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += 1
            inner = [line for line in render_lines(child, depth + 1)]
            if not child.shown:
                # the mark of an item is as hidden as its text
                out.add(inner)
                continue
            out.add([mark + (inner[0] if inner else "")] + [" " * len(mark) + line if line else "" for line in inner[1:]])
        elif tag in BLOCKS:
            spaced = tag in SPACED and not (tag in ("ul", "ol", "dl") and node.tag in ("li", "ul", "ol"))
            out.gap() if spaced else out.end()
            if tag == "blockquote":
                out.add(["> " + line if line else ">" for line in render_lines(child, depth + 1)])
            elif tag == "dd":
                out.add(["  " + line if line else "" for line in render_lines(child, depth + 1)])
            else:
                _render(child, out, literal or tag == "pre", depth + 1)
            if spaced:
                out.end(tag == "pre" and any(out.run))
                out.blank = True
            else:
                out.end()
        elif tag in APART or node.tag in SCRIPTS:
            out.text(" ", False)
            _render(child, out, literal, depth + 1)
            out.text(" ", False)
        else:
            _render(child, out, literal or tag in ("textarea",), depth + 1)


def _strings(node: Node) -> Iterator[str]:
    """All visible text below a node, without layout and without recursion."""
    stack = [(node, True)]
    while stack:
        item, shown = stack.pop()
        if isinstance(item, str):
            if shown:
                yield item
        elif visible(item):
            stack += [(child, item.shown) for child in reversed(item.children)]


def render_lines(node: Node, depth: int = 0) -> list[str]:
    out = _Lines()
    _render(node, out, node.tag == "pre", depth)
    out.end(node.tag == "pre" and any(out.run))
    return out.lines


def visible_text(html: str) -> str:
    """The text of a page as a reader sees it: blocks apart, list items marked, table cells aligned."""
    lines = render_lines(parse(html))
    return "\n".join(line.rstrip() for line in lines).strip("\n")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_lines (int) of every page; a null or empty page gives an empty text. Repeated rows and null ids stay as they are."""

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        at = batch.schema.get_field_index
        texts = [visible_text(h) if h else "" for h in batch.column(at("html")).to_pylist()]
        yield {
            "page_id": batch.column(at("page_id")),
            "url": batch.column(at("url")),
            "text": texts,
            "n_lines": [len(t.split("\n")) if t else 0 for t in texts],
        }

    return map_batches(pages.select("page_id", "url", "html"), run, "page_id long, url string, text string, n_lines int")
