"""Visible text of HTML pages, laid out as read on a screen.

A tree builder with the usual implied tags turns the markup into elements;
a renderer walks the tree without recursion and lays out blocks, lists and
tables.  All visible text is given, navigation and footers included.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
# Of drawings and formulas only these parts aren't shown.
UNSEEN = frozenset("script style head title template noscript noembed noframes iframe object audio video canvas "
                   "datalist rp annotation annotation-xml defs desc metadata symbol clippath mask pattern marker".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre "
                  "search section summary table ul caption optgroup option".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre table figure fieldset".split())
ENDS_P = BLOCK - frozenset("body html li dd dt caption legend summary option optgroup".split()) | {"summary"}
SCOPE = frozenset("table td th caption html template button object".split())
LISTS = frozenset("ul ol menu dir".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
# An opened tag ends these open ones, unless one of the second set stands between.
IMPLIED = {
    "li": (frozenset({"li"}), LISTS | SCOPE),
    "dd": (frozenset({"dd", "dt"}), frozenset({"dl"}) | SCOPE), "dt": (frozenset({"dd", "dt"}), frozenset({"dl"}) | SCOPE),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"}) | SCOPE),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select"}) | SCOPE),
    "tr": (frozenset({"tr", "caption"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"table", "tr"})), "th": (frozenset({"td", "th"}), frozenset({"table", "tr"})),
    "thead": (frozenset({"caption", "thead", "tbody", "tfoot"}), frozenset({"table"})),
    "tbody": (frozenset({"caption", "thead", "tbody", "tfoot"}), frozenset({"table"})),
    "tfoot": (frozenset({"caption", "thead", "tbody", "tfoot"}), frozenset({"table"})),
    "body": (frozenset({"head"}), frozenset()),
}
HEAD_ONLY = frozenset("base link meta title style script noscript template".split())
MAX_DEPTH = 512         # deeper elements become siblings, as browsers do
PAD = 80                # table columns wider than this aren't padded
SPAN = 1000             # columns or rows that one cell may span, as browsers do

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
# What comes next in a tag: its end, or an attribute and the sign or quote that its value follows.
_ATTR = re.compile(r"[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+([\"'])?+)?+)")
_UNQUOTED = re.compile(r"[^\s>]*+")
_NO_DISPLAY = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)


class Element:
    __slots__ = ("tag", "attrs", "children", "parent", "depth")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Element | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Element | str] = []
        self.depth = parent.depth + 1 if parent else 0

    def hidden(self) -> bool:
        a = self.attrs
        return (self.tag in UNSEEN or "hidden" in a or self.tag == "dialog" and "open" not in a
                or "style" in a and bool(_NO_DISPLAY.search(a["style"])))


class Tags:
    """Reads the tags of a page.  Quotes count where a value begins, as in browsers,
    and a value may have any length.  A tag with a quote that is never closed, or
    without an end, is no tag.

    Positions passed on the way to such a failure are kept, so that no later tag
    goes that way again and the time stays linear in the page.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in "<>\"'"}
        self.failed: set[int] = set()
        self.failed_name = -1       # end of the last name whose tag failed
        self.run = (0, -1)          # the unquoted value read last

    def read(self, at: int) -> tuple[str, dict[str, str], int] | None:
        """(name, attributes, end) of the tag whose name starts at ``at``."""
        html = self.html
        name = _NAME.match(html, at) if self.failed_name <= at < self.last[">"] else None
        if name is None:
            return None
        at, passed, spans = name.end(), [], []
        while at not in self.failed and (m := _ATTR.match(html, at)):
            if m[1]:
                attrs: dict[str, str] = {}
                for key, i, j in spans:
                    attrs.setdefault(key.lower(), unescape(html[i:j]))
                return name[0].lower(), attrs, m.end()
            passed.append(at)
            start = end = at = m.end()
            if m[3]:
                end = html.find(m[3], start) if start <= self.last[m[3]] else -1
                if end < 0:
                    break
                at = end + 1
            elif start > m.end(2):      # an equals sign
                if not self.run[0] <= start <= self.run[1]:
                    self.run = start, _UNQUOTED.match(html, start).end()
                end = at = self.run[1]
            spans.append((m[2], start, end))
        self.failed.update(passed)
        self.failed_name = name.end()
        return None


class TreeBuilder:
    def __init__(self) -> None:
        self.root = self.here = Element("html", {}, None)

    def _up_to(self, targets: frozenset, stops: frozenset) -> None:
        """Close the nearest open target, and all in it, if no stop stands before it."""
        e = self.here
        while e.parent is not None:
            if e.tag in targets:
                self.here = e.parent
                return
            if e.tag in stops:
                return
            e = e.parent

    def _in_table(self) -> Element | None:
        """The table if the open element takes no content of its own (text there goes before the table)."""
        e = self.here
        if e.tag not in TABLE_PARTS:
            return None
        while e is not None and e.tag != "table":
            e = e.parent
        return e

    def text(self, s: str) -> None:
        if not s:
            return
        table = self._in_table()
        if table is not None and not s.isspace():
            at = table.parent.children
            at.insert(len(at) - 1 if at and at[-1] is table else len(at), s)
        else:
            self.here.children.append(s)

    def open(self, tag: str, attrs: dict[str, str]) -> None:
        if tag == "html":
            return
        if self.here.tag == "head" and tag not in HEAD_ONLY and tag not in ("head", "body"):
            self.here = self.here.parent
        if tag in ENDS_P:
            self._up_to(frozenset({"p"}), SCOPE)
        if tag in ("h1", "h2", "h3", "h4", "h5", "h6") and re.fullmatch("h[1-6]", self.here.tag):
            self.here = self.here.parent
        if tag in IMPLIED:
            if tag in ("tr", "thead", "tbody", "tfoot"):
                self._up_to(frozenset({"td", "th"}), frozenset({"table"}))
                if tag != "tr":
                    self._up_to(frozenset({"tr"}), frozenset({"table"}))
            self._up_to(*IMPLIED[tag])
        if tag in ("td", "th") and self.here.tag in ("table", "thead", "tbody", "tfoot"):
            self.open("tr", {})
        parent = self.here
        while parent.depth >= MAX_DEPTH:
            parent = parent.parent
        self.here = parent
        e = Element(tag, attrs, parent)
        table = self._in_table()
        if table is not None and tag not in TABLE_PARTS | {"td", "th", "caption", "colgroup", "col", "form", "input"} \
                and tag not in HEAD_ONLY:
            at = table.parent.children      # content where a table takes none stands before it
            e.parent, e.depth = table.parent, table.parent.depth + 1
            at.insert(len(at) - 1 if at and at[-1] is table else len(at), e)
        else:
            parent.children.append(e)
        if tag not in VOID:
            self.here = e

    def close(self, tag: str) -> None:
        if tag == "br":
            return self.open("br", {})
        e, stop = self.here, None
        while e.parent is not None and e.tag != tag:
            if e.tag in ("td", "th", "caption") and tag not in TABLE_PARTS | {"td", "th"}:
                return          # an end tag inside a cell doesn't reach out of it
            stop, e = e, e.parent
        if e.parent is not None:
            self.here = e.parent
        elif tag == "p":
            self.here.children.append(Element("p", {}, self.here))


def build(html: str) -> Element:
    """The element tree of a page."""
    b, at, n, tags = TreeBuilder(), 0, len(html), Tags(html)
    start = html.find("<")
    while start >= 0:
        found, end, sign = None, -1, html[start + 1:start + 2]
        if html.startswith("<!--", start):
            end = html.find("-->", start + 4) + 3
            end = end if end > 2 else n
        elif found := tags.read(start + 1 + (sign == "/")):
            end = found[2]
        elif sign and sign in "!?/":
            end = html.find(">", start + 2) + 1 or n
        elif sign.isascii() and sign.isalpha() and start == tags.last["<"] and start > tags.last[">"]:
            end = n
        if end < 0:
            start = html.find("<", start + 1)
            continue
        b.text(unescape(html[at:start]))
        at = end
        if found is None or sign == "/":
            if found:
                b.close(found[0])
            start = html.find("<", at)
            continue
        tag = found[0]
        b.open(tag, found[1])
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = end.start() if end else n
            body = html[at:stop]
            if tag == "textarea":
                b.text(unescape(body))
            at = stop
            if not end:
                break
        elif tag == "plaintext":
            b.text(html[at:])
            at = n
        start = html.find("<", at)
    if at < n:
        b.text(unescape(html[at:]))
    return b.root


class Flow:
    """Lines of one box: words run on within a line, blocks break it, margins are one empty line."""

    __slots__ = ("lines", "now", "space", "gap")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []
        self.space = self.gap = False

    def words(self, s: str) -> None:
        if not s:
            return
        body = " ".join(s.split())
        if not body:
            self.space = True
            return
        if self.now and (self.space or s[0].isspace()):
            self.now.append(" ")
        self.now.append(body)
        self.space = s[-1].isspace()

    def lay(self) -> None:
        """End the line, if there is one."""
        if self.now:
            self._add("".join(self.now))
            self.now = []
        self.space = False

    def _add(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.append(line)

    def newline(self) -> None:
        if self.now:
            self.lay()
        elif self.lines:
            self._add("")

    def margin(self) -> None:
        self.lay()
        self.gap = True

    def preformatted(self, s: str) -> None:
        first, *rest = s.expandtabs(8).replace("\r\n", "\n").split("\n")
        self.now.append(first)
        for line in rest:
            self._add("".join(self.now))
            self.now = [line]

    def box(self, lines: list[str], first: str = "", other: str = "") -> None:
        self.lay()
        for i, line in enumerate(lines):
            self._add(((first if i == 0 else other) + line) if line or i == 0 else "")

    def done(self) -> list[str]:
        self.lay()
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return self.lines


def _span(e: Element, name: str) -> int:
    v = e.attrs.get(name, "1").strip()
    return max(1, min(int(v), SPAN)) if v.isascii() and v.isdigit() and len(v) < 9 else 1


def _grid(rows: list[list[tuple[Element, list[str]]]]) -> list[str]:
    """Lines of a table: columns begin at the same place in every row; a cell that spans
    rows or columns leaves the others empty."""
    placed: list[dict[int, list[str]]] = []
    below: dict[int, int] = {}
    for row in rows:
        at, cells, left = 0, {}, {c: k - 1 for c, k in below.items() if k > 1}
        for e, lines in row:
            while below.get(at, 0) > 0:
                at += 1
            cells[at] = lines
            across, down = _span(e, "colspan"), _span(e, "rowspan")
            for c in range(at, at + across):
                if down > 1:
                    left[c] = down - 1
            at += across
        placed.append(cells)
        below = left
    width: dict[int, int] = {}
    for cells in placed:
        for c, lines in cells.items():
            widest = max(map(len, lines), default=0)
            width[c] = max(width.get(c, 0), widest) if widest <= PAD else width.get(c, 0)
    used = sorted(width)
    out = []
    for cells in placed:
        for k in range(max((len(v) for v in cells.values()), default=0)):
            line = [(cells[c][k] if k < len(cells.get(c, ())) else "").ljust(width[c]) for c in used]
            out.append("  ".join(line).rstrip())
    return out


class _Table:
    def __init__(self) -> None:
        self.rows: list[list] = []


def render(root: Element) -> str:
    """The visible text of a tree.  Enter and leave steps are kept on a list, so that
    no depth of nesting can exhaust the stack."""
    flows, tables, counters, pre = [Flow()], [], [], 0
    todo: list[tuple[Element | str, bool]] = [(root, False)]
    while todo:
        e, leaving = todo.pop()
        flow = flows[-1]
        if isinstance(e, str):
            flow.preformatted(e) if pre else flow.words(e)
            continue
        tag = e.tag
        if leaving:
            if tag in ("td", "th") and tables:
                tables[-1].rows[-1].append((e, flows.pop().done()))
            elif tag == "table":
                lines = _grid(tables.pop().rows)
                flows[-1].box(lines)
                flows[-1].margin()
            elif tag == "li":
                lines = flows.pop().done()
                mark = "- "
                if counters and counters[-1] is not None:
                    counters[-1] += 1
                    mark = f"{counters[-1] - 1}. "
                flows[-1].box(lines or [""], mark, " " * len(mark))
            elif tag in ("dd", "blockquote"):
                lines = flows.pop().done()
                flows[-1].box(lines, "  ", "  ")
                if tag in SPACED:
                    flows[-1].margin()
            else:
                if tag == "pre":
                    if flow.now and not "".join(flow.now).strip():
                        flow.now = []
                    pre -= 1
                if tag in LISTS:
                    counters.pop()
                if tag == "q":
                    flow.now.append('"')
                nested = tag in LISTS and counters
                if tag in SPACED and not nested:
                    flow.margin()
                elif tag in BLOCK:
                    flow.lay()
            continue
        if e.hidden():
            continue
        if tag == "br":
            flow.newline()
            continue
        if tag == "hr":
            flow.box(["---"])
            continue
        if tag == "wbr" or tag in VOID:
            if tag == "input" and e.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                flow.words(e.attrs.get("value", ""))
            continue
        nested = tag in LISTS and bool(counters)
        if tag in SPACED and not nested:
            flow.margin()
        elif tag in BLOCK:
            flow.lay()
        if tag in ("td", "th") and tables:
            if not tables[-1].rows:
                tables[-1].rows.append([])
            flows.append(Flow())
        elif tag == "tr" and tables:
            tables[-1].rows.append([])
        elif tag == "table":
            tables.append(_Table())
        elif tag in ("li", "dd", "blockquote"):
            flows.append(Flow())
        elif tag == "pre":
            pre += 1
        elif tag == "q":
            if flow.space and flow.now:
                flow.now.append(" ")
            flow.space = False
            flow.now.append('"')
        if tag in LISTS:
            start = e.attrs.get("start", "").strip()
            counters.append(None if tag != "ol" else int(start) if re.fullmatch(r"-?[0-9]{1,8}", start) else 1)
        todo.append((e, True))
        todo.extend((c, False) for c in reversed(e.children))
    return "\n".join(flows[0].done())


def visible_text(html: str | None) -> str:
    return render(build(html)) if html else ""


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_chars) of every row: the visible text of its whole page; a map over the scan.

    Null or empty pages, and pages without visible text, give an empty text.
    Ids may be null or repeat: each row gives one row.  Markup that breaks
    the rules is read as far as it goes.  Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [visible_text(h) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "text", "n_chars"])

    return df.select(F.col(id_col).cast("bigint"), F.col(html_col)).mapInArrow(
        run, "page_id bigint, text string, n_chars bigint")
