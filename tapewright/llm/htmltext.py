"""Visible text of HTML pages, laid out: blocks on lines of their own, lists, aligned tables."""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame

from tapewright.llm.columns import add_columns

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What a browser does not render: the head's parts, fallback content, suggestions of a datalist.
HIDDEN = frozenset(
    "script style head template noscript title iframe object audio video canvas datalist".split()
)
# The same inside drawings and formulas.
HIDDEN_IN = {
    "svg": frozenset(["desc", "metadata"]),
    "math": frozenset(["annotation", "annotation-xml", "mphantom"]),
}
# Parts of formulas whose children stand above or beside each other.
SPREAD = frozenset("mfrac mroot msub msup msubsup munder mover munderover mtr".split())
HTML_INSIDE = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
CHOICE = frozenset(["select", "optgroup", "option"])
RAW = frozenset("script style textarea title iframe noscript".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
# Blocks set apart by an empty line; others only begin a new line.
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
CLOSES_P = BLOCK - frozenset("body html td th tr tbody thead tfoot caption dd dt li".split())
# An element of the first kind ends an open one of the second, up to the third.
IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr"]), frozenset(["table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "caption"]), frozenset(["table"])),
    "thead": (frozenset(["tbody", "thead", "tfoot", "caption"]), frozenset(["table"])),
    "tfoot": (frozenset(["tbody", "thead", "tfoot", "caption"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
}
# What may stand in the head. Any other start tag and any text ends an open head.
HEAD_PARTS = frozenset(
    "base basefont bgsound link meta noframes noscript script style template title".split()
)
BEFORE_BODY = frozenset(["#root", "html", "head"])
# A closing tag looks no further out than these.
SCOPE = frozenset(["table", "td", "th", "caption", "html", "body"])

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>?",
    re.DOTALL,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_SHOWN_BY = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")
# Lists and tables inside so many others are laid out as plain blocks.
MAX_NESTING = 60
_OF_USE = re.compile(r"hidden|style|colspan|rowspan|start|type|value|reversed|open|placeholder", re.I)
# Shown only while open; of a closed <details> its summary is shown.
OPENED = frozenset(["details", "dialog"])
# Inputs that show no text; all others show their value, or what stands in for it.
SILENT_INPUTS = frozenset("hidden password checkbox radio file color range image".split())
BUTTONS = frozenset("submit reset button".split())
MOST_COLUMNS, MOST_ROWS = 1_000, 65_534  # that a cell may span; more count as so many


class Node:
    """An element. One that is ``hidden`` is not there for the reader, with all it holds; text of one
    that is ``unseen`` is left blank, but elements in it may be visible again."""

    __slots__ = ("tag", "attrs", "children", "hidden", "unseen", "block")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None, hidden=False, unseen=False):
        self.tag, self.attrs, self.children, self.hidden = tag, attrs or {}, [], hidden
        self.unseen, self.block = unseen, tag in BLOCK


def _attrs(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTR.findall(text):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found.setdefault(name.lower(), html.unescape(value) if "&" in value else value)
    return found


def _visibility(name: str, attrs: dict[str, str], unseen: bool) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether its text is unseen, in one that is ``unseen``."""
    # of repeated declarations the last one holds
    shown_by = {k.lower(): v.lower() for k, v in _SHOWN_BY.findall(attrs.get("style", ""))}
    hidden = "hidden" in attrs or shown_by.get("display") == "none"
    if name == "dialog" and "open" not in attrs:
        hidden = True
    kind = shown_by.get("visibility", "inherit")
    if kind in ("hidden", "collapse", "visible"):
        unseen = kind != "visible"
    return hidden, unseen


def _whole(text: str, otherwise: int, most: int) -> int:
    """A number as HTML reads it: what follows the digits is passed over, and more than ``most`` is that."""
    m = re.match(r"[ \t\n\f\r]*\+?([0-9]+)", text)
    return min(int(m[1][-18:]) if len(m[1].lstrip("0")) < 10 else most, most) if m else otherwise


def _signed(text: str) -> int | None:
    return int(text) if re.fullmatch(r"\s*[-+]?[0-9]{1,9}\s*", text) else None


def _shown(node: Node) -> list:
    """What an element shows of its children."""
    if node.tag == "details" and "open" not in node.attrs:
        return [x for x in node.children if isinstance(x, Node) and x.tag == "summary"][:1]
    return node.children


def _input_text(node: Node) -> str:
    """The text in an input, or on a button, as source text."""
    kind = node.attrs.get("type", "text").strip().lower()
    if kind in SILENT_INPUTS:
        return ""
    text = node.attrs.get("value", "")
    if not text and kind not in BUTTONS:
        text = node.attrs.get("placeholder", "")
    return f" {html.escape(text)} " if text.strip() else ""


def parse(source: str) -> Node:
    """The tree of a page. Missing end tags are implied, and stray ones passed over.

    An open head ends where the body begins: at <body>, or at what may not stand in a head.
    """
    root = Node("#root")
    stack = [root]
    drawn = [""]  # svg or math where the content of an open element is part of it, not HTML
    at = 0
    lowered = None
    depth_of: dict[str, int] = {}  # open elements of each name
    head_seen = in_body = False

    def pop_to(i: int) -> None:
        for node in stack[i:]:
            depth_of[node.tag] -= 1
        del stack[i:], drawn[i:]

    def begin_body() -> None:
        nonlocal in_body
        in_body = True
        if stack[-1].tag == "head":
            pop_to(len(stack) - 1)

    def add_text(text: str) -> None:
        if not in_body and stack[-1].tag in BEFORE_BODY and text.strip(" \t\n\r\f"):
            begin_body()
        stack[-1].children.append(" " if stack[-1].unseen else text)

    for m in _TOKEN.finditer(source):
        if m.start() < at:
            continue
        if m.start() > at:
            add_text(source[at : m.start()])
        at = m.end()
        closing, name, rest = m.group(1, 2, 3) if m.group(2) else m.group(4, 5, 6)
        if name is None:
            continue
        name = name.lower()
        if closing:
            if not in_body and stack[-1].tag in BEFORE_BODY and name in ("body", "html", "br"):
                begin_body()
            if not depth_of.get(name):
                if name == "p":
                    stack[-1].children.append(Node("p"))
                elif name == "br":
                    stack[-1].children.append(Node("br"))
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == name:
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE and name not in SCOPE and name not in IMPLIED:
                    break
            continue
        if name == "head":
            if in_body or head_seen or stack[-1].tag not in BEFORE_BODY:
                continue
            head_seen = True
        elif not in_body and stack[-1].tag in BEFORE_BODY and name not in HEAD_PARTS:
            if name != "html":
                begin_body()
            elif stack[-1].tag == "head":
                continue
        attrs = _attrs(rest) if rest and (name in CHOICE or _OF_USE.search(rest)) else {}
        if name in ("select", "input", "textarea", "optgroup") and depth_of.get("select"):
            at_select = max(i for i, x in enumerate(stack) if x.tag == "select")
            pop_to(at_select + (name == "optgroup"))
            if name == "select":
                continue
        if name in CLOSES_P and depth_of.get("p"):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    pop_to(i)
                    break
                if stack[i].tag in SCOPE:
                    break
        if name in IMPLIED:
            ends, limit = IMPLIED[name]
            if any(depth_of.get(x) for x in ends):
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in ends:
                        pop_to(i)
                        break
                    if stack[i].tag in limit:
                        break
        inside = drawn[-1]
        node = Node(name, attrs, name in HIDDEN, stack[-1].unseen)
        if attrs or name in OPENED:
            hidden, node.unseen = _visibility(name, attrs, node.unseen)
            node.hidden = node.hidden or hidden
        if node.unseen and name in ("input", "select", "textarea"):
            node.hidden = True
        if inside:
            node.hidden = node.hidden or name in HIDDEN_IN[inside]
            node.block = node.block or name in ("text", "mtr")
        stack[-1].children.append(node)
        if rest.endswith("/") and (inside or name in HIDDEN_IN):
            continue
        if name in RAW:
            lowered = source.lower() if lowered is None else lowered
            end = lowered.find(f"</{name}", at)
            if end < 0 or len(lowered) != len(source):
                close = re.compile(f"</{re.escape(name)}", re.I).search(source, at)
                end = close.start() if close else len(source)
            if name == "textarea":
                node.children.append(source[at:end])
            stop = source.find(">", end)
            at = len(source) if stop < 0 else stop + 1
        elif name not in VOID:
            stack.append(node)
            drawn.append(name if name in HIDDEN_IN else "" if name in HTML_INSIDE else inside)
            depth_of[name] = depth_of.get(name, 0) + 1
    if at < len(source):
        add_text(source[at:])
    return root


def _decoded(text: str) -> str:
    """Character references replaced; most texts have none, or only ampersands."""
    n = text.count("&")
    if not n:
        return text
    return text.replace("&amp;", "&") if n == text.count("&amp;") else html.unescape(text)


class _Lines:
    """Lines being written: words joined by single spaces, blocks set apart."""

    def __init__(self):
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = False

    def add(self, text: str) -> None:
        self.parts.append(text)

    def end_line(self) -> None:
        if not self.parts:
            return
        line = _SPACE.sub(" ", _decoded("".join(self.parts))).strip(" ")
        self.parts = []
        if line:
            self.put([line])

    def put(self, lines: list[str]) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.extend(lines)

    def space(self) -> None:
        self.end_line()
        self.gap = True


def _typed(node: Node) -> str:
    """The text in a textarea, as it stands there."""
    text = html.unescape("".join(x for x in node.children if isinstance(x, str)))
    return text.replace("\r\n", "\n").strip("\n")


def _choice(node: Node) -> list:
    """What a select shows: all options of a list box, else the chosen one."""
    size = node.attrs.get("size", "")
    box = "multiple" in node.attrs or bool(re.fullmatch(r"[0-9]{1,9}", size)) and int(size) > 1
    shown: list = []
    chosen = first = None
    todo = [(x, False) for x in reversed(node.children)]
    while todo:
        item, off = todo.pop()
        if isinstance(item, str) or item.hidden and (box or item.tag != "option"):
            continue
        off = off or "disabled" in item.attrs
        label = item.attrs.get("label", "").strip()
        if item.tag == "option":
            option = Node("div")
            option.children = [html.escape(label)] if label else item.children
            shown.append(option)
            if "selected" in item.attrs:
                chosen = option
            if first is None and not off:
                first = option
        else:
            if item.tag == "optgroup" and label:
                group = Node("div")
                group.children = [html.escape(label)]
                shown.append(group)
            todo.extend((x, off) for x in reversed(item.children))
    if box:
        return shown
    option = chosen or first
    return [" ", *option.children, " "] if option else []


def _lines(children: list, nested: int = 0) -> list[str]:
    """Lines of some siblings inside ``nested`` lists and tables; other depth is no limit."""
    out = _Lines()
    todo: list = [iter(children)]
    ends: list = [None]
    while todo:
        item = next(todo[-1], None)
        if item is None:
            todo.pop()
            end = ends.pop()
            if end is not None:
                end()
            continue
        if isinstance(item, str):
            out.add(item)
            continue
        if item.hidden:
            continue
        tag = item.tag
        if tag == "br":
            if out.parts:
                out.end_line()
        elif tag == "hr":
            out.space()
        elif tag == "pre":
            out.space()
            raw = html.unescape("".join(_raw_text(item))).strip("\n")
            if raw.strip():
                out.put([x.rstrip() for x in raw.split("\n")])
            out.gap = True
        elif tag == "table" and nested < MAX_NESTING:
            out.space()
            rows = _table(item, nested + 1)
            if rows:
                out.put(rows)
            out.gap = True
        elif tag in ("ul", "ol", "menu", "dir") and nested < MAX_NESTING:
            out.space()
            rows = _list(item, nested + 1)
            if rows:
                out.put(rows)
            out.gap = True
        elif tag == "textarea":
            out.end_line()
            raw = _typed(item)
            if raw.strip():
                out.put([x.rstrip() for x in raw.split("\n")])
        elif tag == "select":
            ends.append(None)
            todo.append(iter(_choice(item)))
        elif tag == "input":
            out.add(_input_text(item))
        else:
            if item.block:
                out.space() if tag in SPACED else out.end_line()
                ends.append(out.space if tag in SPACED else out.end_line)
            else:
                ends.append(None)
            inner = _shown(item)
            if tag in SPREAD:
                inner = [y for x in inner for y in (x, " ")]
            todo.append(iter(inner))
    out.end_line()
    return out.lines


def _raw_text(node: Node) -> list[str]:
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif not item.hidden:
            if item.tag == "br":
                out.append("\n")
            if item.tag == "textarea":
                out.append(html.escape(_typed(item)))
            else:
                inner = _choice(item) if item.tag == "select" else _shown(item)
                if item.tag == "input":
                    inner = [_input_text(item)]
                todo.extend(reversed(inner))
    return out


def _list(node: Node, nested: int) -> list[str]:
    out: list[str] = []
    items = [x for x in node.children if isinstance(x, Node) and x.tag == "li" and not x.hidden]
    down = node.tag == "ol" and "reversed" in node.attrs
    number = _signed(node.attrs.get("start", ""))
    if number is None:
        number = len(items) if down else 1
    loose: list = []

    def flush() -> None:
        out.extend(x for x in _lines(loose, nested) if x)
        loose.clear()

    for child in node.children:
        if isinstance(child, str) or child.tag != "li":
            loose.append(child)
            continue
        flush()
        if child.hidden:
            continue
        own = _signed(child.attrs.get("value", ""))
        number = number if own is None else own
        mark = f"{number}. " if node.tag == "ol" else "- "
        number += -1 if down else 1
        if child.unseen:
            mark = " " * len(mark)
        lines = [x for x in _lines(child.children, nested) if x]
        if lines:
            out.append(mark + lines[0])
            out.extend(" " * len(mark) + x for x in lines[1:])
    flush()
    return out


def _table(node: Node, nested: int) -> list[str]:
    """Rows of cells, padded so that columns line up; a caption goes above.

    A cell over several rows or columns stands in the first, and the others stay empty.
    """
    captions: list[str] = []
    rows: list[list[str]] = []
    todo = list(reversed(node.children))
    stray: list = []
    down: dict[int, int] = {}  # rows for which a cell above still takes a column
    while todo:
        item = todo.pop()
        if item is None:
            down.clear()  # no cell goes beyond its group of rows
        elif isinstance(item, str):
            stray.append(item)
        elif item.hidden:
            continue
        elif item.tag == "caption":
            captions.extend(_lines(item.children, nested))
        elif item.tag == "tr":
            cells: list[str] = []
            begun: dict[int, int] = {}
            for cell in item.children:
                if isinstance(cell, str):
                    stray.append(cell)
                elif not cell.hidden and cell.tag in ("td", "th"):
                    while down.get(len(cells)):
                        cells.append("")
                    at = len(cells)
                    cells.append(" ".join(x for x in _lines(cell.children, nested) if x))
                    extra = _whole(cell.attrs.get("colspan", ""), 1, MOST_COLUMNS) - 1
                    cells.extend([""] * max(0, extra))
                    more = _whole(cell.attrs.get("rowspan", ""), 1, MOST_ROWS) - 1
                    if more:  # 0 means to the end of the group
                        begun |= dict.fromkeys(range(at, len(cells)), more if more > 0 else 1 << 30)
                elif not cell.hidden:
                    stray.append(cell)
            rows.append(cells)
            down = {i: n - 1 for i, n in down.items() if n > 1} | begun
        elif item.tag in ("tbody", "thead", "tfoot", "colgroup", "form"):
            if item.tag[0] == "t":
                down.clear()
                todo.append(None)
            todo.extend(reversed(item.children))
        else:
            stray.append(item)
    outside = [x for x in _lines(stray, nested) if x]
    width = [0] * max((len(r) for r in rows), default=0)
    for row in rows:
        for i, cell in enumerate(row):
            width[i] = max(width[i], len(cell))
    laid = [
        "  ".join(cell.ljust(w) for cell, w in zip(row, width, strict=False)).rstrip() for row in rows
    ]
    return outside + captions + [x for x in laid if x]


def visible_text(source: str | None) -> str:
    """All visible text of a page; empty for null."""
    if not source:
        return ""
    return "\n".join(_lines(parse(source).children))


def extract(pages: DataFrame, html_column: str = "html", keep=None) -> DataFrame:
    """The kept columns (default: all) with ``text``, the page as a reader would see it.

    What a browser does not render gives nothing: scripts, styles, the head, templates, fallback
    content, titles and descriptions of drawings, elements hidden by ``hidden`` or their own style,
    closed dialogs, what a closed <details> holds besides its summary, and the options of a
    drop-down list that are not chosen. Text that is invisible by an inherited ``visibility`` is left
    blank, and elements in it that are visible again are shown. Attributes are not text, but for the
    labels of options and what stands in inputs and on buttons. Lists and tables inside more than
    ``MAX_NESTING`` others are laid out as plain blocks.

    Null and empty pages give an empty text. Pages of any length are rendered whole, each by itself;
    repeated ones keep their own rows. A column already called ``text`` is replaced.
    """

    def start():
        return lambda pages: [[visible_text(p) for p in pages.to_pylist()]]

    kept = pages.columns if keep is None else keep
    return add_columns(pages, [html_column], "text string", start, kept)
