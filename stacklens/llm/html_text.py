"""Visible text of web pages, laid out: blocks, lists and aligned tables."""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stacklens.llm.common import whole

# Element names by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes noscript title textarea".split())
HIDDEN = frozenset(
    "head script style template noscript iframe noembed noframes title datalist audio video canvas object "
    "param source track area base meta link rp".split())
#: Not painted inside drawings and formulas.
UNPAINTED = frozenset("desc metadata defs symbol clippath mask pattern annotation annotation-xml mphantom".split())
#: Blank lines above and below; other blocks only start and end a line.
MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol menu dl blockquote pre table hr figure fieldset dir xmp listing".split())
BLOCK = MARGIN | frozenset(
    "html body address article aside center details dialog dd div dt figcaption footer form header hgroup legend li main nav "
    "optgroup option search section summary caption thead tbody tfoot tr select".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = (BLOCK - frozenset("html body caption thead tbody tfoot tr option optgroup legend select".split())) | {"plaintext"}
#: A start tag ends the nearest open one of these, if none of the second stands between.
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table td th".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "dd": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "option": (frozenset(["option"]), frozenset("select datalist optgroup table".split())),
    "optgroup": (frozenset(["optgroup", "option"]), frozenset("select table".split())),
    "td": (frozenset(["td", "th", "caption"]), frozenset("table".split())),
    "th": (frozenset(["td", "th", "caption"]), frozenset("table".split())),
    "tr": (frozenset(["tr", "caption"]), frozenset("table".split())),
    "thead": (frozenset("thead tbody tfoot caption".split()), frozenset("table".split())),
    "tbody": (frozenset("thead tbody tfoot caption".split()), frozenset("table".split())),
    "tfoot": (frozenset("thead tbody tfoot caption".split()), frozenset("table".split())),
    "a": (frozenset(["a"]), frozenset("table td th".split())),
    "button": (frozenset(["button"]), frozenset("table td th".split())),
    "body": (frozenset(["head"]), frozenset(["body"])),
}
CELLS = frozenset(["td", "th"])
SECTIONS = frozenset(["thead", "tbody", "tfoot"])
#: An end tag does not reach beyond these.
SCOPE = frozenset("table td th caption html".split())
IN_HEAD = frozenset("base link meta noscript script style template title head html".split())

# A quote opens a string only where the value of an attribute starts; a "=" where a name starts belongs to the name.
TOKEN = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|"""
    r"""<(/?)([A-Za-z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+)*+)>|[^<]++|<""", re.DOTALL)
LOOSE = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*+)))?""")
SPACES = re.compile(r"[\t\n\f\r][ \t\n\f\r]*| [ \t\n\f\r]+")
#: Cells wider than this do not widen their column.
WIDEST = 60
#: Tables nested deeper are laid out as blocks.
DEEPEST = 20


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []

    def get(self, name: str) -> str | None:
        """Value of an attribute, "" if it has none, None if it is absent."""
        if name in self.attrs.lower():
            for m in ATTRIBUTE.finditer(self.attrs):
                if m[1].lower() == name:
                    return html.unescape(next((v for v in m.groups()[1:] if v is not None), ""))
        return None

    def number(self, name: str, default: int, most: int = 10**9) -> int:
        m = re.match(r"\s*(-?\d{1,9})", self.get(name) or "")
        return min(int(m[1]), most) if m else default


class Builder:
    """Tree of a page: unclosed and implied elements end where HTML lets them end."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.count: dict[str, int] = {"html": 1}

    def _push(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def _pop_to(self, at: int) -> None:
        for node in self.open[at:]:
            self.count[node.tag] -= 1
        del self.open[at:]

    def _nearest(self, tags: frozenset, stop: frozenset) -> int | None:
        if not any(self.count.get(t) for t in tags):
            return None
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                return at
            if self.open[at].tag in stop:
                return None
        return None

    def _end_nearest(self, tags: frozenset, stop: frozenset) -> None:
        at = self._nearest(tags, stop)
        if at is not None:
            self._pop_to(at)

    def start(self, tag: str, attrs: str) -> None:
        if tag == "html" or tag == "body" and self.count.get("body"):
            return
        if tag not in IN_HEAD and self.count.get("head"):
            self._end_nearest(frozenset(["head"]), frozenset(["body", "template"]))
        if tag in CLOSES_P and self.count.get("p"):
            self._end_nearest(frozenset(["p"]), SCOPE | {"button", "object"})
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self._pop_to(len(self.open) - 1)
        if tag in ENDS:
            self._end_nearest(*ENDS[tag])
        if self.count.get("table"):
            self._imply(tag)
        drawn = self.count.get("svg") or self.count.get("math")
        if drawn and tag in UNPAINTED:
            attrs += " hidden"
        node = Node(tag, attrs)
        if tag in VOID or drawn and attrs.removesuffix(" hidden").endswith("/") and tag not in RAW:
            self.open[-1].children.append(node)
        else:
            self._push(node)

    def _imply(self, tag: str) -> None:
        if tag in CELLS:
            at = self._nearest(frozenset(["tr"]), frozenset(["table"]))
            if at is None:
                self._imply("tr")
                self._push(Node("tr"))
            else:
                self._pop_to(at + 1)
        elif tag == "tr":
            at = self._nearest(SECTIONS, frozenset(["table"]))
            if at is None:
                at = self._nearest(frozenset(["table"]), frozenset())
                if at is not None and not (CELLS & {n.tag for n in self.open[at:]}):
                    self._pop_to(at + 1)
                    self._push(Node("tbody"))
            else:
                self._pop_to(at + 1)
        elif tag in SECTIONS:
            at = self._nearest(frozenset(["table"]), frozenset())
            if at is not None:
                self._pop_to(at + 1)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif tag == "p" and self._nearest(frozenset(["p"]), SCOPE) is None:
            self.open[-1].children.append(Node("p"))
        elif tag not in ("html", "body"):
            tags = HEADINGS if tag in HEADINGS else frozenset([tag])
            self._end_nearest(tags, frozenset(["html"]) if tag == "table" else SCOPE - tags if tag not in (
                "tr", "thead", "tbody", "tfoot") else frozenset(["table"]))

    def text(self, text: str) -> None:
        if self.count.get("head") and not text.isspace() and self.open[-1].tag == "head":
            self._pop_to(len(self.open) - 1)
        self.open[-1].children.append(text)


def parse(page: str) -> Node:
    """Tree of ``page``; any input gives one."""
    builder, at, n = Builder(), 0, len(page)
    last = page.rfind(">")
    while at < n:
        if at > last:
            # No tag ends any more: all is text up to a comment, which would take the rest.
            stop = min((k for k in (page.find("<!", at), page.find("<?", at)) if k >= 0), default=n)
            if stop > at:
                builder.text(html.unescape(page[at:stop]))
                at = stop
                continue
        m = TOKEN.match(page, at)
        if m[0] == "<":
            m = LOOSE.match(page, at) or m
        at = m.end()
        if m.lastindex is None:
            if m[0][0] != "<" or m[0] == "<":
                builder.text(html.unescape(m[0]) if "&" in m[0] else m[0])
            continue
        tag = m[2].lower()
        if m[1]:
            builder.end(tag)
            continue
        builder.start(tag, m[3])
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            inner = page[at:close.start() if close else n]
            at = close.end() if close else n
            if tag in ("textarea", "xmp"):
                builder.text(html.unescape(inner) if tag == "textarea" else inner)
            builder.end(tag)
    return builder.root


def hidden(node: Node) -> bool:
    """Whether the element takes no place on the page."""
    tag, attrs = node.tag, node.attrs
    if tag in HIDDEN or tag == "input" and (node.get("type") or "").lower() == "hidden":
        return True
    if tag == "dialog" and node.get("open") is None:
        return True
    if not attrs:
        return False
    lower = attrs.lower()
    if "hidden" in lower and node.get("hidden") is not None:
        return True
    return "none" in lower and bool(re.search(r"(?:^|;)\s*display\s*:\s*none\b", node.get("style") or "", re.IGNORECASE))


def visibility(node: Node, now: bool) -> bool:
    """Whether text directly in the element is painted, given that of its parent."""
    if "visibility" in node.attrs.lower():
        m = re.search(r"(?:^|;)\s*visibility\s*:\s*(\w+)", node.get("style") or "", re.IGNORECASE)
        if m and m[1].lower() in ("hidden", "collapse", "visible"):
            return m[1].lower() == "visible"
    return now


def width(text: str) -> int:
    """Columns a text takes: two for wide characters, none for combining ones."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Canvas:
    """Lines of text, with collapsing white space and margins."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = [""]
        self.marker: str | None = None

    def add(self, text: str) -> None:
        text = SPACES.sub(" ", text)
        inner = text.strip(" ")
        self.space = self.space or text[:1] == " "
        if inner:
            if self.line and self.space:
                self.line.append(" ")
            self.line.append(inner.replace("\xa0", " "))
            self.space = text[-1] == " "

    def verbatim(self, text: str) -> None:
        first, *more = text.replace("\r\n", "\n").expandtabs(8).split("\n")
        if first:
            self.line.append(first)
        for line in more:
            self.end_line(force=True)
            if line:
                self.line.append(line)

    def end_line(self, force: bool = False) -> None:
        if self.line or force:
            self._out("".join(self.line).rstrip())
            self.line = []
        self.space = False

    def _out(self, text: str) -> None:
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        if self.marker is not None:
            indent = self.indent[-1]
            text = (indent[:len(indent) - len(self.marker)] + self.marker + text).rstrip()
            self.marker = None
        elif text:
            text = self.indent[-1] + text
        self.lines.append(text)

    def block(self, margin: int = 0) -> None:
        self.end_line()
        self.gap = max(self.gap, margin)

    def put(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self._out(line)


def _marker(node: Node, lists: list[list]) -> str:
    if not lists or lists[-1][0] != "ol":
        return "- "
    here = lists[-1]
    here[1] = node.number("value", here[1] + here[2])
    return f"{here[1]}. "


def render(root: Node, depth: int = 0, shown: bool = True) -> list[str]:
    """Lines of the visible text below ``root``, whose parent is ``shown`` or not; the walk keeps its own stack."""
    canvas = Canvas()
    lists: list[list] = []
    stack: list[tuple] = [(root, False, shown, False)]
    while stack:
        node, leaving, shown, pre = stack.pop()
        if isinstance(node, str):
            if shown:
                canvas.verbatim(node) if pre else canvas.add(node)
            elif not pre:
                canvas.space = canvas.space or " " in SPACES.sub(" ", node)
            continue
        tag = node.tag
        if leaving:
            if tag == "li" or tag in ("dd", "blockquote"):
                canvas.block()
                canvas.indent.pop()
                if tag == "li":
                    canvas.marker = None
            if tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
            if tag in BLOCK:
                canvas.block(int(tag in MARGIN and not (lists and tag in ("ul", "ol", "menu", "dir"))))
            elif tag in CELLS or tag in ("svg", "text"):
                canvas.space = True
            continue
        if hidden(node):
            continue
        shown = visibility(node, shown)
        if tag == "br":
            canvas.end_line(force=True)
            continue
        if tag == "hr":
            canvas.block(1)
            if shown:
                canvas.put(["---"])
            canvas.block(1)
            continue
        if tag == "input":
            if shown and (node.get("type") or "text").lower() in ("submit", "reset", "button", "text", "search", "email", "url", "tel", "number"):
                canvas.add(node.get("value") or "")
            continue
        if tag == "table" and depth < DEEPEST and node is not root:
            canvas.block(1)
            canvas.put(table(node, depth + 1, shown))
            canvas.block(1)
            continue
        if tag in BLOCK:
            canvas.block(int(tag in MARGIN and not (lists and tag in ("ul", "ol", "menu", "dir"))))
        if tag in ("ul", "ol", "menu", "dir"):
            step = -1 if node.get("reversed") is not None else 1
            items = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
            first = node.number("start", items if step < 0 else 1)
            lists.append([tag, first - step, step])
        elif tag == "li":
            marker = _marker(node, lists)
            canvas.marker = marker if shown else None
            canvas.indent.append(canvas.indent[-1] + " " * len(marker))
        elif tag == "dd":
            canvas.indent.append(canvas.indent[-1] + "    ")
        elif tag == "blockquote":
            canvas.indent.append(canvas.indent[-1] + "  ")
        elif tag in ("svg", "text"):
            canvas.space = True
        pre = pre or tag in ("pre", "listing", "xmp", "textarea")
        children = node.children
        if tag == "details" and node.get("open") is None:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag in ("pre", "listing") and children and isinstance(children[0], str) and children[0].startswith("\n"):
            children = [children[0][1:], *children[1:]]
        stack.append((node, True, shown, pre))
        stack += [(c, False, shown, pre) for c in reversed(children)]
    canvas.end_line()
    lines = canvas.lines
    while lines and not lines[-1]:
        lines.pop()
    start = next((i for i, x in enumerate(lines) if x), len(lines))
    return lines[start:]


def _loose(node: Node, shown: bool) -> list[tuple[Node, bool]]:
    """Texts that stand directly in a table, a section or a row."""
    found = []
    for child in node.children:
        if isinstance(child, str) and not child.isspace():
            wrapper = Node("div")
            wrapper.children.append(child)
            found.append((wrapper, shown))
    return found


def _rows(node: Node, shown: bool) -> tuple[list[tuple[Node, bool]], list[tuple[Node, bool]]]:
    """(captions and other content, rows) of a table, in order, each with whether its parent or, for a row, it is painted.

    What takes no place is left out.
    """
    captions, rows = _loose(node, shown), []
    for child in node.children:
        if isinstance(child, str) or hidden(child):
            continue
        if child.tag in SECTIONS:
            more, below = _rows(child, visibility(child, shown))
            captions += more
            rows += below
        elif child.tag == "tr":
            now = visibility(child, shown)
            captions += _loose(child, now)
            rows.append((child, now))
        else:
            captions.append((child, shown))
    return captions, rows


def table(node: Node, depth: int, shown: bool = True) -> list[str]:
    """Lines of a table: cells of a column start at one place, two blanks apart."""
    captions, rows = _rows(node, shown)
    grid: list[list[tuple[int, int, list[str]]]] = []
    # (first, end, row) of columns that cells of earlier rows hold until that row, by first column.
    busy: list[tuple[int, int, int]] = []
    widths: dict[int, int] = {}
    for y, (row, painted) in enumerate(rows):
        at, line, held = 0, [], []
        busy = [b for b in busy if b[2] > y]
        k = 0
        for cell in row.children:
            if isinstance(cell, str) or hidden(cell):
                continue
            while k < len(busy) and busy[k][0] <= at:
                at = max(at, busy[k][1])
                k += 1
            span, tall = max(1, cell.number("colspan", 1, 1000)), max(1, cell.number("rowspan", 1, 65534))
            inside = render(cell, depth, painted)
            line.append((at, span, inside))
            if span == 1:
                widths[at] = max(widths.get(at, 0), min(WIDEST, max(map(width, inside), default=0)))
            if tall > 1:
                # Neighbours that end together are one stretch.
                joins = held and held[-1][1] == at and held[-1][2] == y + tall
                first = held.pop()[0] if joins else at
                held.append((first, at + span, y + tall))
            at += span
        if held:
            busy = sorted(busy + held)
        grid.append(line)
    columns = sorted(widths)
    starts = [0, *accumulate(widths[k] + (2 if widths[k] else 0) for k in columns)]
    out = [x for c, painted in captions for x in render(c, depth, painted)]
    for line in grid:
        for k in range(max((len(inside) for _, _, inside in line), default=0)):
            text, used = [], 0
            for at, _, inside in line:
                if k < len(inside) and inside[k]:
                    room = starts[bisect_left(columns, at)] - used
                    pad = max(room, 2 if text else 0)
                    text += [" " * pad, inside[k]]
                    used += pad + width(inside[k])
            out.append("".join(text).rstrip())
    return out


def page_text(page: str) -> str:
    """All visible text of a page, laid out in lines."""
    return "\n".join(render(parse(page)))


def extract_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """One row per page: id, text, n_lines.

    A null or empty page has an empty text; what is not closed ends where HTML ends it or
    with the page. Repeated rows give repeated rows; an empty table gives none; other
    columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([page_text(x.as_py()) for x in batch["html"]], pa.string())
            yield pa.RecordBatch.from_arrays([batch["id"], texts], ["id", "text"])

    df = pages.select(F.col(id_col).alias("id"), whole(html_col).alias("html"))
    out = df.mapInArrow(run, f"id {df.schema['id'].dataType.simpleString()}, text string")
    lines = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    return out.select(F.col("id").alias(id_col), "text", lines.alias("n_lines"))
