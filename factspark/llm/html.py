"""Text of web pages as they are laid out.

A tokenizer and tree builder walk the page once, with an explicit stack of open
elements instead of recursion.  End tags that HTML lets authors leave out are
implied (``p``, ``li``, ``dt``, ``td``, ``tr``, ``option`` ...), what a browser
doesn't show (``head``, ``script``, ``hidden``, ``display:none`` by attribute or
by a simple rule of the page's own style sheets ...) is left out, and boxes are
rendered as they are closed: blocks on lines of their own with blank lines
where the default style sheet has margins, list items with their markers, and
tables as aligned columns.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factspark.llm.common import blocks, table
from factspark.shipping import shipped

# Elements by the part they have in the HTML standard's parsing and rendering sections.
_VOID = frozenset("area base br col embed hr img input link meta source track wbr param".split())
_RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext".split())
_NOT_SHOWN = frozenset("head script style title template noscript iframe noembed noframes datalist audio video canvas object area rp link meta base param source track colgroup".split())
_MARGIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu dir blockquote pre figure table xmp listing plaintext fieldset".split())
_BLOCK = _MARGIN | frozenset("html body div section article aside header footer nav main address center details summary dialog figcaption form hgroup hr legend li dt dd optgroup option search".split())
_ENDS_P = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li listing main menu nav ol p pre search section summary table ul xmp plaintext".split())
_HEAD = frozenset("html head title base link meta style script noscript template".split())
_LISTS = frozenset("ul ol menu dir".split())
_TABLE_PARTS = frozenset("caption colgroup col tbody thead tfoot tr td th".split())
_SCOPE = frozenset("html table td th caption template object".split())
# What a start tag closes, up to the elements that bound the search.
_IMPLIED = {
    "li": (frozenset({"li"}), _LISTS | _SCOPE),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"}) | _SCOPE),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}) | _SCOPE),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"}) | _SCOPE),
    "optgroup": (frozenset({"option", "optgroup"}), frozenset({"select", "datalist"}) | _SCOPE),
    "rt": (frozenset({"rt", "rp"}), frozenset({"ruby"}) | _SCOPE),
    "rp": (frozenset({"rt", "rp"}), frozenset({"ruby"}) | _SCOPE),
    "td": (frozenset({"td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "th": (frozenset({"td", "th", "caption", "colgroup"}), frozenset({"table"})),
    "tr": (frozenset({"tr", "caption", "colgroup"}), frozenset({"table"})),
    "tbody": (frozenset({"tbody", "thead", "tfoot", "caption", "colgroup"}), frozenset({"table"})),
    "thead": (frozenset({"tbody", "thead", "tfoot", "caption", "colgroup"}), frozenset({"table"})),
    "tfoot": (frozenset({"tbody", "thead", "tfoot", "caption", "colgroup"}), frozenset({"table"})),
}

_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']*+(?:\"[^\"]*+\"|'[^']*+'))*+[^>\"']*+|[^>]*+)>", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*+=\s*+(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_BLANKS = re.compile(r"[ \t\n\f\r]+")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DISPLAY = re.compile(r"\s*display\s*:\s*([a-z-]+(?:\s+[a-z-]+)*|var\(.*\))\s*(!\s*important\s*)?", re.I | re.S)
_CSS = re.compile(r"""/\*.*?(?:\*/|\Z)|"(?:[^"\\\n]|\\.)*+"?|'(?:[^'\\\n]|\\.)*+'?|\\.|[{};]|[^{};"'\\/]++|.""", re.S)
_MEDIUM = re.compile(r"(?:(not|only)\s+)?([a-z-]+)\b(.*)", re.I | re.S)
_OTHER_MEDIA = frozenset("print speech aural braille embossed handheld projection tty tv".split())
_VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.I)
_SIMPLE = re.compile(r"[a-z][a-z0-9]*|[.#][\w-]+", re.I)
# Foreign content: what ends it, what has text that is shown, and what is never shown.
_ENDS_FOREIGN = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
_HTML_WITHIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
_FOREIGN_NOT_SHOWN = frozenset("defs desc metadata symbol clippath mask pattern marker annotation annotation-xml".split())
_MATH_TOKENS = frozenset("mi mo mn ms mtext".split())
_MATH_PARTS = frozenset("mfrac msub msup msubsup munder mover munderover mroot mmultiscripts mtable mtr".split())
_UNQUOTED_SLASH = re.compile(r"=\s*[^\s\"'=]+/$")
# Whether a condition holds for a screen; in doubt, rules that hide don't count and rules that show do.
NO, DOUBT, YES = 0, 1, 2
MOST_SPAN = 1000  # the standard's limit for colspan
GUTTER = "  "


class _Box:
    """Lines that are being laid out: the page, or one table cell."""

    __slots__ = ("lines", "parts", "space", "gap", "indents", "marker", "pre")

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.space = False
        self.gap = 0
        self.indents: list[str] = []
        self.marker = ""
        self.pre = 0

    def text(self, data: str) -> None:
        if self.pre:
            first, *rest = data.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            if first:
                self.parts.append(first)
            for line in rest:
                self.end_line(True)
                if line:
                    self.parts.append(line)
            return
        bare = _BLANKS.sub(" ", data)
        words = bare.strip(" ")
        if not words:
            self.space = self.space or bool(bare and self.parts)
            return
        if (self.space or bare[0] == " ") and self.parts:
            self.parts.append(" ")
        self.parts.append(words)
        self.space = bare[-1] == " "

    def end_line(self, keep_empty: bool = False) -> None:
        self.space = False
        if not self.parts and not (keep_empty and (self.lines or self.marker)):
            return
        if self.lines and self.gap:
            self.lines.extend([""] * self.gap)
        self.gap = 0
        indent = "".join(self.indents)
        if self.marker:
            indent = indent[: len(indent) - len(self.marker)] + self.marker
            self.marker = ""
        line = indent + "".join(self.parts)
        self.lines.append(line if self.parts and line.strip() else line.rstrip())
        self.parts.clear()

    def block(self, gap: int) -> None:
        self.end_line()
        self.gap = max(self.gap, gap)

    def rows(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self.parts.append(line)
            self.end_line(True)

    def finish(self) -> list[str]:
        self.end_line()
        if self.marker:
            self.end_line(True)
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return self.lines


class _Table:
    """The grid of a table whose rows are being read."""

    __slots__ = ("rows", "filled", "row", "column", "caption")

    def __init__(self) -> None:
        self.rows: list[dict[int, tuple[int, list[str]]]] = []
        self.filled: dict[int, int] = {}  # column -> row up to which (exclusive) a rowspan fills it
        self.row, self.column = -1, 0
        self.caption: list[str] = []

    def next_row(self) -> None:
        self.rows.append({})
        self.row, self.column = self.row + 1, 0

    def add(self, lines: list[str], columns: int, rows: int) -> None:
        if self.row < 0:
            self.next_row()
        while self.filled.get(self.column, 0) > self.row:
            self.column += 1
        self.rows[self.row][self.column] = (columns, lines)
        if rows > 1:
            for k in range(columns):
                self.filled[self.column + k] = self.row + rows
        self.column += columns

    def render(self) -> list[str]:
        """Each cell begins where its column begins; a column is as wide as its widest cell that spans no other."""
        widths: dict[int, int] = {}
        for row in self.rows:
            for at, (span, lines) in row.items():
                if span == 1:
                    widths[at] = max(widths.get(at, 0), max(map(len, lines), default=0))
        for row in self.rows:  # a cell that spans several columns widens the last of them if they can't hold it
            for at, (span, lines) in row.items():
                if span > 1:
                    used = [widths.get(at + k, 0) for k in range(span)]
                    need = max(map(len, lines), default=0) - sum(used) - len(GUTTER) * (sum(u > 0 for u in used[:-1]))
                    if need > 0:
                        widths[at + span - 1] = widths.get(at + span - 1, 0) + need
        shown = [c for c in sorted(widths) if widths[c]]
        start, x = {}, 0
        for c in shown:
            start[c] = x
            x += widths[c] + len(GUTTER)
        out = list(self.caption)
        for row in self.rows:
            cells = [(next((start[c] for c in shown if c >= at), 0) if at not in start else start[at], lines) for at, (_, lines) in sorted(row.items()) if lines]
            for k in range(max((len(lines) for _, lines in cells), default=0)):
                line = ""
                for at, lines in cells:
                    if k < len(lines) and lines[k]:
                        line = line.ljust(at) + lines[k]
                out.append(line.rstrip())
        return out


class _Element:
    __slots__ = ("name", "shown", "visible", "box", "table", "item", "step", "spans", "indent", "gap", "pre", "line")

    def __init__(self, name: str, shown: bool, visible: bool) -> None:
        self.name, self.shown, self.visible = name, shown, visible
        self.box: _Box | None = None
        self.table: _Table | None = None
        self.item: int | None = None
        self.step = 1
        self.spans = (1, 1)
        self.indent = self.gap = self.pre = 0
        self.line = False  # a text of an image


def _number(text: str | None, default: int, least: int = -(10**9), most: int = 10**9) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return max(least, min(most, int(found[1]))) if found else default


def _media(queries: str) -> int:
    """Whether a list of media queries holds for a screen of unknown size."""
    return max((_medium(q.strip()) for q in queries.split(",")), default=YES)


def _medium(query: str) -> int:
    if not query:
        return YES
    found = _MEDIUM.fullmatch(query)
    if not found or found[2].lower() in ("not", "only", "and", "or"):
        return DOUBT  # features alone
    kind = found[2].lower()
    holds = YES if kind in ("all", "screen") else NO if kind in _OTHER_MEDIA else DOUBT
    if holds == YES and found[3].strip():
        holds = DOUBT
    return YES - holds if (found[1] or "").lower() == "not" else holds


def _displays(css: str, media: str = "") -> Iterator[tuple[str, tuple[int, int], bool]]:
    """What the style sheet says of the display of simple selectors (an element, a class or an id alone), in order: the selector, (important, not in a layer), and whether it hides."""
    # For each open block: the selectors that its declarations are for, whether it holds, and whether it is in a layer.
    open_: list[tuple[list[str] | None, int, bool]] = [(None, _media(media), False)]
    held: list[str] = []
    for token in [*(m[0] for m in _CSS.finditer(css)), "}"]:
        if token not in ("{", "}", ";"):
            if not token.startswith("/*") and (held or not token.isspace()):
                held.append(token)
            continue
        selectors, holds, layer = open_[-1]
        if selectors is None and token == ";" and (not held or held[0].lstrip()[:1] != "@"):
            held.append(token)  # a part of the next rule's selector, which it spoils
            continue
        part = "".join(held)
        held.clear()
        if token == "{":
            prelude = part.strip()
            name = prelude[1:].split(None, 1)[0].split("(")[0].lower() if prelude[:1] == "@" and prelude[1:].strip() else ""
            if name == "media":
                open_.append((selectors, min(holds, _media(prelude[6:])), layer))
            elif name in ("supports", "container", "scope", "starting-style"):
                open_.append((selectors, min(holds, DOUBT), layer))
            elif name == "layer":
                open_.append((selectors, holds, True))
            elif prelude[:1] == "@" or selectors is not None:
                open_.append(([], NO, layer))  # no style rules, or rules for what is within
            else:
                open_.append(([x.lower() if x[:1] not in ".#" else x for x in map(str.strip, prelude.split(",")) if _SIMPLE.fullmatch(x)], holds, layer))
            continue
        if selectors and holds != NO and (found := _DISPLAY.fullmatch(part)):
            hides = found[1].lower() == "none"
            if holds == YES or not hides:
                for x in selectors:
                    yield x, (int(bool(found[2])), int(not layer)), hides
        if token == "}" and len(open_) > 1:
            open_.pop()


class _Page:
    def __init__(self) -> None:
        self.page = _Box()
        root = _Element("html", True, True)
        root.box = self.page
        self.stack = [root]
        self.open: dict[str, int] = {"html": 1}
        self.boxes = [self.page]
        self.tables: list[_Table] = []
        self.displays: dict[str, tuple[tuple[int, int, int, int], bool]] = {}
        self.rules = 0

    # -- style sheets -------------------------------------------------------------------------------------------------

    def style(self, css: str, raw: str) -> None:
        """A style sheet, and the attributes of its tag."""
        media = next((a or b or c for k, a, b, c in _ATTRIBUTE.findall(raw) if k.lower() == "media"), "")
        for selector, (important, plain), hides in _displays(css, media):
            self.rules += 1
            rank = (important, plain, 2 if selector[0] == "#" else int(selector[0] == "."), self.rules)
            if selector not in self.displays or rank > self.displays[selector][0]:
                self.displays[selector] = (rank, hides)

    def displayed(self, name: str, attributes: dict[str, str], style: str) -> bool:
        """By the rules and its own style, of which the important ones, then its own, then those for ids, then classes, then the last win."""
        found = []
        if self.displays:
            keys = (name, *(f".{c}" for c in (attributes.get("class") or "").split()), f"#{attributes.get('id')}")
            found = [self.displays[k] for k in keys if k in self.displays]
        if style:
            for k, part in enumerate(_COMMENT.sub("", unescape(style)).split(";")):
                if own := _DISPLAY.fullmatch(part):
                    found.append(((int(bool(own[2])), 2, 0, k), own[1].lower() == "none"))
        return not found or not max(found)[1]

    # -- the tree -----------------------------------------------------------------------------------------------------

    def foreign(self) -> bool:
        """Whether the next tag is one of SVG or MathML."""
        return bool(self.open.get("svg") or self.open.get("math")) and next((e.name in ("svg", "math") for e in reversed(self.stack) if e.name in ("svg", "math") or e.name in _HTML_WITHIN), False)

    def start(self, name: str, raw: str) -> None:
        if name in ("html", "body", "frameset") or (name == "head" and self.open.get("head")):
            return
        if name not in _HEAD and self.open.get("head") and not self.open.get("noscript") and not self.open.get("template"):
            self.pop_to("head")
        if name in _ENDS_FOREIGN:
            while self.foreign():
                self.pop()
        if name in _ENDS_P and self.open.get("p"):
            self.close_within("p", _SCOPE)
        if name in _IMPLIED:
            names, bounds = _IMPLIED[name]
            self.close_through(names, bounds)
        if name in ("h1", "h2", "h3", "h4", "h5", "h6") and self.stack[-1].name in ("h1", "h2", "h3", "h4", "h5", "h6"):
            self.pop()
        if name == "tr" or name in ("td", "th"):
            if not self.tables:
                return  # outside a table, the tags of its parts mean nothing
            if name != "tr" and not self.within("tr", "table"):
                self.push("tr", {})
        elif name in _TABLE_PARTS and not self.tables:
            return
        if name == "a" and self.open.get("a"):
            self.close_within("a", _SCOPE)
        attributes = {k.lower(): a or b or c for k, a, b, c in reversed(_ATTRIBUTE.findall(raw))} if raw.strip(" /\t\n\r\f") else {}
        closed = name in _VOID or raw.endswith("/") and (name in ("svg", "math") or self.foreign()) and not _UNQUOTED_SLASH.search(raw)
        self.push(name, attributes)
        if closed:
            self.pop()

    def end(self, name: str) -> None:
        if name in ("html", "body") or name in _VOID and name != "br":
            return
        if name == "br":
            self.start("br", "")
        elif name == "p" and not self.open.get("p"):
            self.start("p", "")
            self.pop_to("p")
        elif self.open.get(name):
            self.close_within(name, frozenset({"table"}) if name in _TABLE_PARTS else frozenset({"td", "th", "table", "caption", "template"}) if name != "table" else frozenset())

    def within(self, name: str, bound: str) -> bool:
        return next((e.name for e in reversed(self.stack) if e.name in (name, bound)), bound) == name

    def close_within(self, name: str, bounds: frozenset[str]) -> None:
        for e in reversed(self.stack[1:]):
            if e.name == name:
                self.pop_to(name)
                return
            if e.name in bounds:
                return

    def close_through(self, names: frozenset[str], bounds: frozenset[str]) -> None:
        """Closes the outermost open element of these names that is within the innermost of the bounds."""
        found = None
        if any(self.open.get(n) for n in names):
            for k in range(len(self.stack) - 1, 0, -1):
                if self.stack[k].name in names:
                    found = k
                elif self.stack[k].name in bounds:
                    break
        while found is not None and len(self.stack) > found:
            self.pop()

    def pop_to(self, name: str) -> None:
        while len(self.stack) > 1:
            last = self.stack[-1].name
            self.pop()
            if last == name:
                return

    # -- the layout ---------------------------------------------------------------------------------------------------

    def push(self, name: str, attributes: dict[str, str]) -> None:
        above = self.stack[-1]
        style = attributes.get("style") or ""
        shown = above.shown and name not in _NOT_SHOWN and "hidden" not in attributes and ((not style and not self.displays) or self.displayed(name, attributes, style))
        svg = bool(self.open.get("svg"))
        if shown and (svg or self.open.get("math")):
            shown = name not in _FOREIGN_NOT_SHOWN and not (svg and attributes.get("display") == "none")
        if name == "input" or name == "dialog" and "open" not in attributes:
            shown = False
        if above.name == "details" and above.item is None and name != "summary":
            shown = False  # closed: only its summary is seen
        visible = above.visible
        if found := _VISIBILITY.search(style):
            visible = found[1].lower() == "visible"
        e = _Element(name, shown, visible)
        self.stack.append(e)
        self.open[name] = self.open.get(name, 0) + 1
        if name == "details":
            e.item = 1 if "open" in attributes else None
        if not shown:
            if name == "table":
                e.table = _Table()
                self.tables.append(e.table)
            return
        box = self.boxes[-1]
        if above.name in _MATH_PARTS and box.parts:
            box.space = True
        if name == "br":
            box.end_line(True)
        elif name in ("td", "th", "caption") and self.tables:
            e.box = _Box()
            e.spans = (_number(attributes.get("colspan"), 1, 1, MOST_SPAN), _number(attributes.get("rowspan"), 1, 0, 65534) or 65534)
            self.boxes.append(e.box)
        elif name == "tr" and self.tables:
            self.tables[-1].next_row()
        elif name == "text" and svg:
            e.line = True
            box.block(0)
        elif name in _BLOCK:
            # Lists within lists have no margins.
            e.gap = int(name in _MARGIN and not (name in _LISTS and any(self.open.get(x, 0) > (x == name) for x in _LISTS)))
            box.block(e.gap)
            if name == "table":
                e.table = _Table()
                self.tables.append(e.table)
            elif name in _LISTS:
                e.item = _number(attributes.get("start"), 1) if name == "ol" else None
                e.step = -1 if name == "ol" and "reversed" in attributes else 1
            elif name == "li":
                owner = next((x for x in reversed(self.stack[:-1]) if x.name in _LISTS or x.name in _SCOPE), None)
                marker = "- "
                if owner is not None and owner.item is not None and owner.name == "ol":
                    owner.item = _number(attributes.get("value"), owner.item)
                    marker = f"{owner.item}. "
                    owner.item += owner.step
                if box.marker:  # a list right inside of an item begins on a line of its own
                    box.end_line(True)
                e.indent = 1
                box.indents.append(" " * len(marker))
                box.marker = marker if visible else ""
            elif name in ("blockquote", "dd"):
                e.indent = 1
                box.indents.append("    ")
            elif name in ("pre", "listing", "xmp", "plaintext"):
                e.pre = 1
                box.pre += 1
        elif name == "textarea":
            e.pre = 1
            box.pre += 1

    def pop(self) -> None:
        e = self.stack.pop()
        self.open[e.name] -= 1
        if not e.shown:
            if e.table is not None:
                self.tables.pop()
            return
        if e.box is not None:
            self.boxes.pop()
            lines = e.box.finish()
            if not self.tables:
                self.boxes[-1].rows(lines)
            elif e.name == "caption":
                self.tables[-1].caption += lines
            else:
                self.tables[-1].add(lines, *e.spans)
            return
        box = self.boxes[-1]
        if e.table is not None:
            self.tables.pop()
            box.pre, held = 0, box.pre
            box.rows(e.table.render())
            box.pre = held
        if e.line:
            box.block(0)
        if e.name in _BLOCK:
            if e.name == "li" and box.marker and not box.parts:
                box.end_line(True)  # an item without text
            box.block(e.gap)
        if e.pre:
            box.pre -= 1
        if e.indent:
            box.indents.pop()

    def text(self, data: str) -> None:
        e = self.stack[-1]
        if self.open.get("head") and not data.isspace() and e.name == "head":
            self.pop_to("head")
            e = self.stack[-1]
        if self.open.get("svg") and not self.open.get("text") and not self.open.get("foreignobject"):
            return  # between the shapes of an image
        if self.open.get("math") and e.name not in _MATH_TOKENS and data.isspace():
            return
        if e.shown and e.visible and not (e.name == "details" and e.item is None) and e.name not in ("table", "tbody", "thead", "tfoot", "tr"):
            self.boxes[-1].text(unescape(data) if "&" in data else data)
        elif e.shown and e.visible and e.name in ("table", "tbody", "thead", "tfoot", "tr") and data.strip(" \t\n\f\r") and self.tables:
            # Text between a table's cells is shown before the table.
            place = next(k for k in range(len(self.stack) - 1, -1, -1) if self.stack[k].table is not None)
            if self.stack[place].table is self.tables[-1]:
                self.boxes[-1].text(unescape(data) if "&" in data else data)


def render(html: str) -> str:
    """The visible text of a page (or a part of one), laid out in lines. Never fails: what isn't understood is text."""
    page, n = _Page(), len(html)
    at, last = int(html[:1] == "\ufeff"), html.rfind(">")
    while at < n:
        if at > last:  # no tag ends any more: only a comment or declaration that is never closed isn't text
            opened = html.find("<!", at)
            page.text(html[at : opened if opened >= 0 else n])
            break
        token = _TOKEN.search(html, at)
        if token is None:
            page.text(html[at:])
            break
        if token.start() > at:
            page.text(html[at : token.start()])
        at = token.end()
        name = token[2]
        if name is None:
            continue
        name = name.lower()
        if token[1]:
            page.end(name)
            continue
        page.start(name, token[3])
        if name in _RAW and page.stack[-1].name == name:
            close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at) if name != "plaintext" else None
            stop = close.start() if close else n
            body = html[at:stop]
            if name == "style":
                page.style(body, token[3])
            elif name == "textarea":
                page.text(body.removeprefix("\n"))
            elif name in ("xmp", "plaintext"):
                page.text(body.replace("&", "&amp;"))
            at = stop
            if close is None:
                break
        elif name in ("pre", "listing") and html[at : at + 1] == "\n":
            at += 1
    while len(page.stack) > 1:
        page.pop()
    return "\n".join(page.page.finish())


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(id, text)`` for every row: the laid-out text of each whole page.

    A null page has a null text; one without visible text has an empty one. Rows
    that repeat are returned as often as they came; an empty table gives an
    empty result. Only the two named columns are read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in blocks(batches, "html"):
            raw, at = data.tobytes(), offsets.tolist()
            known = rows.column("html").is_valid().to_pylist()
            out = [render(raw[a:b].decode(errors="replace")) if ok else None for a, b, ok in zip(at, at[1:], known, strict=False)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(out, pa.string())], names=["id", "text"])

    kind = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")).transform(shipped).mapInArrow(run, f"id {kind}, text string")


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The laid-out text of every page."""
    return extract(table(spark, sf_dir, "pages")).select(F.col("id").alias("page_id"), "text", F.char_length("text").cast("long").alias("n_chars"))
