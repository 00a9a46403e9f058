"""Layout-aware text of HTML pages.

A tree builder with implied tags reads a page once; each element is laid
out when it closes and its lines go to its parent, so nesting costs no
recursion and memory follows the page.  All visible text comes out, in
order: white space collapses, blocks stand on their own lines with a blank
line where a browser leaves a margin, list items get their marker and
indent, table cells are aligned in columns (a cell over ``WIDE`` characters
does not widen its column), ``pre`` keeps its spaces.

Inside ``svg`` the content of ``text`` and ``foreignObject`` is visible, of
``math`` all but annotations; both close at a self-closing slash and before
HTML tags that can't stand in them.

Invisible: ``head`` content, scripts, styles, templates, comments, replaced
content, ``hidden``, ``display:none``, ``visibility:hidden`` (until a
descendant is visible again), all of a closed ``details`` but its summary.

Defined results: null or empty html gives empty text and a null title; an
unclosed tag at the end is dropped, an unclosed element is closed; rows that
repeat a ``page_id`` each get their own result; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes noscript xmp".split())
UNSEEN = frozenset("head script style title template iframe noembed noframes noscript datalist object "
                   "video audio canvas".split())
#: Inside svg only ``text`` is drawn; these, and what math adds beside its formula, are not.
DRAWN = frozenset(["text"])
UNDRAWN = {"svg": frozenset("title desc metadata defs symbol clippath mask pattern marker filter style script".split()),
           "math": frozenset(["annotation", "annotation-xml"])}
#: Foreign elements whose content is HTML, and HTML tags that close an open svg or math.
HOLDS_HTML = {"svg": frozenset("foreignobject desc title".split()), "math": frozenset("mi mo mn ms mtext".split())}
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing "
                     "menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
#: Blank lines around a block.
MARGIN = {t: 1 for t in "p h1 h2 h3 h4 h5 h6 ul ol menu dl blockquote pre xmp table figure fieldset hr".split()} | {
    t: 0 for t in "html body div section article aside header footer nav main address form center details summary dir "
                  "dt dd li option optgroup select legend figcaption caption hgroup search textarea".split()}
TABLE_PARTS = frozenset("thead tbody tfoot tr td th caption colgroup col".split())
#: Table parts that hold no text of their own: it is shown before their table.
FOSTERED = frozenset("table thead tbody tfoot tr colgroup".split())
#: The open part that a table part goes into, whatever stands between.
CONTEXT = {t: frozenset(["table"]) for t in ("thead", "tbody", "tfoot", "caption", "colgroup")} | {
    "tr": frozenset("table thead tbody tfoot".split())} | {
    t: frozenset("table thead tbody tfoot tr".split()) for t in ("td", "th")}
#: An opening tag closes these open ones, up to the nearest of the second set.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
           "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
           "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
           "th": ({"td", "th"}, {"tr", "table"}), "body": ({"head"}, {"html"})} | {
    t: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}) for t in ("thead", "tbody", "tfoot")}
P_STAYS = frozenset("li dt dd option optgroup select tr td th caption".split())
BARRIER = frozenset("table td th caption button object template".split())
SCOPE = BARRIER | HOLDS_HTML["svg"] | HOLDS_HTML["math"]
HEAD_ONLY = frozenset("head title meta link base style script noscript template html".split())
WIDE, GAP, INDENT = 60, "  ", "  "

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>")
_ATTR = re.compile(r"([^\s=/>\"']++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Box:
    """An open element: what it holds so far, laid out."""

    def __init__(self, tag: str, attrs: dict[str, str], shown: bool, pre: bool, space: str = ""):
        self.tag, self.attrs, self.shown, self.pre, self.space = tag, attrs, shown, pre, space
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = 0
        self.items = 0  # list items so far
        self.rows: list[list[tuple[list[str], int, int]]] | None = [] if tag == "table" else None

    def text(self, s: str, pre: bool) -> None:
        self.inline.append(s if pre else _SPACE.sub(" ", s))

    def close_line(self, keep_empty: bool = False) -> None:
        if not self.inline and not keep_empty:
            return
        s = "".join(self.inline)
        self.inline = []
        if self.pre:
            made = [x.rstrip(" ") for x in s.split("\n")]
        else:
            s = re.sub(" {2,}", " ", s).strip(" ")
            made = [s] if s or keep_empty else []
        if made:
            self.add(made, 0)

    def add(self, lines: list[str], margin: int) -> None:
        """Whole lines, with ``margin`` blank ones before and after."""
        if not lines:
            return
        gap = max(self.gap, margin)
        if self.lines and gap:
            self.lines.append("")
        self.lines += lines
        self.gap = margin

    def block(self, lines: list[str], margin: int) -> None:
        self.close_line()
        self.add(lines, margin)


def _number(value: str | None, default: int, most: int) -> int:
    digits = re.match(r"\s*\+?(\d{1,9})", value or "")
    return min(int(digits[1]), most) if digits else default


def table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Cells (lines, columns, rows they span) in aligned columns.  No line
    ends in a space."""
    if all(len(row) < 2 and all(down == 1 for _, _, down in row) for row in rows):
        cells = [lines for row in rows for lines, _, _ in row]  # one column: nothing to align, whatever is nested in it
        return cells[0] if len(cells) == 1 else [x for lines in cells for x in lines]
    below: dict[int, int] = {}  # columns that a cell above still holds
    placed, width = [], {}
    for row in rows:
        at, cells, held = 0, [], below
        below = {c: n - 1 for c, n in held.items() if n > 1}
        for lines, across, down in row:
            while at in held:
                at += 1
            cells.append((at, lines))
            if down > 1:
                below.update((c, down - 1) for c in range(at, at + across))
            if across == 1:
                width[at] = max([width.get(at, 0), *(len(x) for x in lines if len(x) <= WIDE)])
            at += across
        placed.append(cells)
    left, at = {}, 0
    for c in range(max(width, default=-1) + 1):
        left[c] = at
        at += width.get(c, 0) + len(GAP) * (width.get(c, 0) > 0)
    out = []
    for cells in placed:
        for i in range(max((len(x) for _, x in cells), default=0)):
            line = ""
            for c, lines in cells:
                if i < len(lines) and lines[i]:
                    line = line.ljust(left.get(c, 0))
                    line += GAP * bool(line and not line.endswith(GAP)) + lines[i]
            out.append(line.rstrip(" "))
    return out


class Page:
    """Reads one page."""

    def __init__(self, html: str):
        self.title: str | None = None
        self.stack = [Box("#root", {}, True, False)]
        self.open: dict[str, int] = {}
        self._read(html)
        while len(self.stack) > 1:
            self._pop()
        root = self.stack[0]
        root.close_line()
        lines = root.lines
        self.text = "\n".join(x.replace("\xa0", " ").rstrip(" ") for x in lines).strip("\n")

    def _read(self, html: str) -> None:
        at, end = 0, len(html)
        while at < end:
            lt = html.find("<", at)
            if lt < 0:
                lt = end
            if lt > at:
                self._text(html[at:lt])
            if lt == end:
                return
            if html.startswith("<!--", lt):
                close = html.find("-->", lt + 2)
                at = end if close < 0 else close + 3
                continue
            if html.startswith("<![CDATA[", lt) and self.stack[-1].space:
                close = html.find("]]>", lt)
                self._text(html[lt + 9:close if close >= 0 else end], raw=True)
                at = end if close < 0 else close + 3
                continue
            m = _TAG.match(html, lt)
            if m:
                at = m.end()
                tag = m[2].lower()
                if m[1]:
                    self._end(tag)
                    continue
                found = list(_ATTR.finditer(m[3])) if m[3] and m[3] != "/" else []
                attrs = {a[1].lower(): unescape(next((x for x in a.groups()[1:] if x is not None), "")) for a in found}
                self._break_out(tag, attrs)
                if tag in ("svg", "math") or self._foreign():
                    self._start(tag, attrs)
                    # the slash may belong to a value without quotes
                    if m[3][-1:] == "/" and not (found and found[-1][4] and found[-1].end() == len(m[3])):
                        self._pop()
                    continue
                self._start(tag, attrs)
                if tag in RAW and m[3][-1:] != "/":
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                    stop = close.start() if close else end
                    if tag == "title" and self.title is None:
                        self.title = _SPACE.sub(" ", unescape(html[at:stop])).strip()
                    elif tag == "textarea" or tag == "xmp":
                        self._text(unescape(html[at:stop]) if tag == "textarea" else html[at:stop], raw=True)
                    self._end(tag)
                    at = html.find(">", stop) + 1 or end if close else end
            elif html[lt + 1:lt + 2] in ("!", "?") or html[lt + 1:lt + 3].startswith("/"):
                close = html.find(">", lt)
                at = end if close < 0 else close + 1
            elif html[lt + 1:lt + 2].isascii() and html[lt + 1:lt + 2].isalpha():
                return  # the page ends inside a tag
            else:
                self._text("<")
                at = lt + 1

    def _text(self, s: str, raw: bool = False) -> None:
        top = self.stack[-1]
        if top.tag == "head" and s.strip():
            self._end("head")
            top = self.stack[-1]
        host = self._line()
        if top.shown and (host is top or s.strip()):
            host.text(s if raw else unescape(s), top.pre and host is top)

    def _line(self) -> Box:
        """Where text goes: between cells, before the table."""
        return next(b for b in reversed(self.stack) if b.tag not in FOSTERED or b.space)

    def _foreign(self) -> bool:
        """Whether a tag here names an element of svg or math."""
        top = self.stack[-1]
        return bool(top.space) and top.tag not in HOLDS_HTML[top.space] and "html" not in (
            top.attrs.get("encoding", "").lower() if top.tag == "annotation-xml" else "")

    def _break_out(self, tag: str, attrs: dict[str, str] = {}) -> None:
        if tag in BREAKOUT or tag == "font" and not attrs.keys().isdisjoint(("color", "face", "size")):
            while self._foreign():
                self._pop()

    def _start(self, tag: str, attrs: dict[str, str]) -> None:
        if tag not in HEAD_ONLY and self.open.get("head"):
            self._end("head")
        if self._foreign():
            self._push(tag, attrs)
            return
        if tag in MARGIN and tag not in P_STAYS and self.open.get("p"):
            self._close({"p"}, SCOPE)
        if tag in IMPLIED:
            self._close(*IMPLIED[tag])
        if tag in CONTEXT and self.open.get("table"):
            self._back_to(CONTEXT[tag])
        if tag in ("td", "th") and self.stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            self._push("tr", {})
        top = self._line()
        if tag == "br" or tag == "hr":
            if top.shown:
                if tag == "br" and top.pre:
                    top.inline.append("\n")
                else:
                    top.close_line(keep_empty=tag == "br")
                    top.gap = max(top.gap, int(tag == "hr"))
            return
        if tag == "input" and top.shown and attrs.get("type", "").lower() in ("submit", "button", "reset"):
            top.text(attrs.get("value", ""), False)
        if tag not in VOID and tag not in ("html", "body"):
            self._push(tag, attrs)

    def _back_to(self, context: frozenset[str]) -> None:
        """Closes what stands between a table's parts and the next one."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in context:
                while len(self.stack) > i + 1:
                    self._pop()
                return
            if self.stack[i].tag == "template":
                return

    def _push(self, tag: str, attrs: dict[str, str]) -> None:
        top = self.stack[-1]
        style = attrs.get("style", "").lower().replace(" ", "") if "style" in attrs else ""
        space = tag if tag in ("svg", "math") else top.space if self._foreign() else ""
        gone = tag in UNDRAWN.get(space, UNSEEN) or "hidden" in attrs or "display:none" in style or top.attrs.get("#gone") is not None
        if top.tag == "details" and "open" not in top.attrs and tag != "summary":
            gone = True
        veiled = "visibility:hidden" in style or (top.attrs.get("#veil") is not None and "visibility:visible" not in style)
        if gone or veiled:
            attrs = attrs | ({"#gone": ""} if gone else {}) | ({"#veil": ""} if veiled else {})
        drawn = space != "svg" or tag in DRAWN or top.space == "svg" and top.attrs.get("#drawn") is not None
        if space and drawn:
            attrs = attrs | {"#drawn": ""}
        shown = not gone and not veiled and drawn and not (tag == "details" and "open" not in attrs)
        if top.tag == "details" and tag == "summary" and not gone and not veiled:
            shown = True
        box = Box(tag, attrs, shown, tag in ("pre", "textarea", "xmp") or top.pre and tag not in ("table", "td", "th"),
                  space)
        if space or tag not in MARGIN and tag not in TABLE_PARTS:  # an inline element writes into its block's line
            line = self._line()
            box.inline, box.lines = line.inline, line.lines
            box.attrs = attrs | {"#inline": ""}
            if space == "svg" and tag in DRAWN:  # stands apart from other texts
                box.text(" ", False)
        if tag == "optgroup" and shown:
            box.block([attrs.get("label", "")] if attrs.get("label") else [], 0)
        self.stack.append(box)
        self.open[tag] = self.open.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        if tag in ("br", "p"):
            self._break_out(tag)
        if tag == "br":
            self._start("br", {})
        elif tag == "p" and not self.open.get("p"):
            self._close_to_block()
        elif self.open.get(tag):
            stop = {"table"} if tag in TABLE_PARTS else set() if tag in ("table", "template") else BARRIER - {tag}
            for box in reversed(self.stack):
                if box.tag == tag:
                    while self.stack[-1] is not box:
                        self._pop()
                    self._pop()
                    return
                if box.tag in stop:
                    return

    def _close_to_block(self) -> None:
        self.stack[-1].close_line()

    def _close(self, tags: set[str], stop) -> None:
        """Closes the outermost open element of ``tags`` inside ``stop``."""
        if not any(self.open.get(t) for t in tags):
            return
        found = None
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in stop:
                break
            if self.stack[i].tag in tags:
                found = i
        if found:
            while len(self.stack) > found:
                self._pop()

    def _pop(self) -> None:
        box, top = self.stack.pop(), self.stack[-1]
        self.open[box.tag] -= 1
        if "#inline" in box.attrs:
            if box.space == "svg" and box.tag in DRAWN:
                box.text(" ", False)
            line = self._line()
            line.inline, line.gap = box.inline, max(line.gap, box.gap) if box.gap != line.gap else line.gap
            return
        box.close_line()
        lines, tag = box.lines, box.tag
        if tag == "table":
            made = table_lines(box.rows)
            lines = [*lines, *made] if lines else made
        elif tag in ("td", "th", "tr"):
            table = next((b for b in reversed(self.stack) if b.rows is not None), None)
            if table is not None:
                if tag == "tr":
                    table.rows.append(box.attrs.get("#cells", []))
                elif (box.shown or lines) and top.tag == "tr":
                    top.attrs.setdefault("#cells", []).append((lines, _number(box.attrs.get("colspan"), 1, 1000) or 1,
                                                              _number(box.attrs.get("rowspan"), 1, 65534) or 1))
                if tag == "tr" or top.tag == "tr":
                    return
        elif tag == "li" and box.shown:
            mark = "- "
            if top.tag == "ol":
                if not top.items:
                    top.items = _number(top.attrs.get("start"), 1, 10**9) - 1
                top.items = _number(box.attrs.get("value"), top.items + 1, 10**9)
                mark = f"{top.items}. "
            lines = [(mark + lines[0]).rstrip(" "), *(" " * len(mark) + x if x else x for x in lines[1:])] if lines else [mark.strip()]
        elif tag in ("dd", "blockquote"):
            lines = [INDENT + x if x else x for x in lines]
        if not (box.shown or lines):
            return
        host = self._line()
        if tag in MARGIN or tag in TABLE_PARTS:
            nested = tag in ("ul", "ol", "menu") and any(b.tag == "li" for b in self.stack)
            host.block(lines, 0 if nested else MARGIN.get(tag, 0))


def html_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, title, text``: one row per page."""
    def run(batches):
        for batch in batches:
            read = [Page(h or "") for h in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"], batch["url"], pa.array([p.title for p in read], pa.string()),
                 pa.array([p.text for p in read], pa.string())], ["page_id", "url", "title", "text"])

    read = pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "html")
    return read.mapInArrow(run, "page_id long, url string, title string, text string")
