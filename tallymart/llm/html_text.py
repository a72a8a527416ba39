"""Layout-aware text of web pages: all that a reader would see, laid out as lines.

A tree is built with the tags that authors leave out: items, cells, rows and
paragraphs end where the next one starts, a head ends where the body's content starts, a
cell without a row gets one.  What is not shown is skipped: head, scripts,
templates, ``hidden``, ``display:none``, closed dialogs and all but the summary of closed
details, and what is ``visibility:hidden`` by inheritance.  A select shows its chosen
option, or all if it is a list box; a field or button its value.  The rest is written with
blank lines between paragraphs, markers and indents for lists, kept white space
in ``pre``, and tables in columns.

A cell is a block of lines of its own: paragraphs, lists and tables in it keep
their layout.  A table with one column is running text.  A column is as wide as its
widest line, unless padding would outweigh the table's text ``PADDING`` times:
then the widest lines run on, and what stands right of them goes to the next
line, in its own column.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm.util import table, text_slices

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base link meta noscript script style template title head".split())
UNSEEN = frozenset(
    "head script style template noscript title iframe noembed noframes object audio video canvas "
    "datalist param source track".split()
)
#: Parts of drawings and formulas that are not drawn where they stand.
UNDRAWN = frozenset(
    "annotation annotation-xml clippath defs desc filter lineargradient marker mask metadata pattern radialgradient symbol".split()
)
FOREIGN = ("svg", "math")
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre figure dl ul ol".split())
BLOCK = SPACED | frozenset(
    "address article aside body caption center details dialog dd dir div dt fieldset figcaption footer form header "
    "hgroup hr html legend li main menu nav search section summary table tbody tfoot thead tr".split()
)
LISTS = frozenset(("ul", "ol", "menu", "dir"))
#: A start tag ends these open elements, as far up as the first of the others.
ENDS = {
    "li": (("li",), LISTS),
    "dt": (("dt", "dd"), frozenset(("dl",))),
    "dd": (("dt", "dd"), frozenset(("dl",))),
    "td": (("td", "th"), frozenset(("tr", "table"))),
    "th": (("td", "th"), frozenset(("tr", "table"))),
    "tr": (("tr",), frozenset(("table",))),
    **{g: (("thead", "tbody", "tfoot", "caption", "colgroup"), frozenset(("table",))) for g in ("thead", "tbody", "tfoot")},
    "option": (("option",), frozenset(("select", "datalist"))),
    "optgroup": (("optgroup", "option"), frozenset(("select", "datalist"))),
    "select": (("select",), frozenset(("table",))),
}
#: Inputs that show neither their value nor a placeholder.
WORDLESS = frozenset("hidden checkbox radio password file image color range date time month week datetime-local".split())
CELL = frozenset(("td", "th", "caption", "table"))

MARKUP = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)", re.DOTALL)
VALUE = r"""\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*"""
#: From a tag's name to its end, without going back: quoted values may hold any sign.
TAG_REST = re.compile(rf"(?:[\s/]+|[^\s/>=]+(?:\s*=\s*(?:{VALUE})?)?|=)*+>")
ATTRIBUTE = re.compile(rf"([^\s/>=]+)(?:\s*=\s*({VALUE})?)?")
STYLE = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)", re.IGNORECASE)
SPACE = re.compile(r"[ \t\n\r\f]+")
#: Padding of a table's columns as a multiple of its text, and how much any table may have.
PADDING, FREE_PADDING = 8, 4096
#: Tables of several columns within each other that are laid out in columns; deeper ones are running text.
MOST_NESTED = 64
# The most columns and rows that a cell may span.
MOST_COLUMNS, MOST_ROWS = 1000, 65534


class Node:
    __slots__ = ("tag", "children", "hidden", "visibility", "attributes")

    def __init__(self, tag: str, attributes: dict[str, str] | None = None, foreign: bool = False):
        self.tag, self.children, self.attributes = tag, [], attributes or {}
        style = {k.lower(): v.lower() for k, v in STYLE.findall(self.attributes.get("style", ""))}
        self.visibility = style.get("visibility")
        self.hidden = (
            tag in UNSEEN
            or (foreign and tag in UNDRAWN)
            or "hidden" in self.attributes
            or style.get("display") == "none"
            or (tag == "dialog" and "open" not in self.attributes)
        )

    def unseen(self, inherited: bool) -> bool:
        """Whether text right below is invisible, where it is for the parent or is not."""
        if self.visibility in ("hidden", "collapse"):
            return True
        return inherited and self.visibility != "visible"


# ------------------------------------------------------------------ tree


def build_tree(html: str) -> Node:
    """The tree of a page; any text is a page."""
    root = Node("html")
    stack = [root]
    opened: Counter = Counter()

    def close(names, until) -> None:
        """Pop up to the nearest of ``names``, if it is open and nearer than any of ``until``."""
        if not any(opened[n] for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            tag = stack[depth].tag
            if tag in names:
                for node in stack[depth:]:
                    opened[node.tag] -= 1
                del stack[depth:]
                return
            if tag in until:
                return

    def foreign() -> bool:
        return bool(opened["svg"] or opened["math"]) and not opened["foreignobject"]

    def start(tag: str, attributes: dict[str, str], empty: bool = False) -> None:
        while tag in BLOCK and foreign():  # blocks end drawings and formulas
            close(FOREIGN, ())
        if opened["head"] and tag not in HEAD:
            close(("head",), ())
        if tag in ENDS:
            close(*ENDS[tag])
            if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                start("tr", {})
            if tag in ("tr", "thead", "tbody", "tfoot"):
                close(("caption",), frozenset(("table",)))
        if tag in BLOCK:
            close(("p",), CELL | LISTS | {"li", "dd", "dt"})
        inside = foreign()
        node = Node(tag, attributes, inside)
        stack[-1].children.append(node)
        if tag not in VOID and not (empty and (inside or tag in FOREIGN)):
            stack.append(node)
            opened[tag] += 1

    def text(data: str) -> None:
        if data and opened["head"] and stack[-1].tag == "head" and not data.isspace():
            close(("head",), ())
        if data:
            stack[-1].children.append(unescape(data))

    at, size = 0, len(html)
    while at < size:
        found = MARKUP.search(html, at)
        if not found:
            text(html[at:])
            break
        text(html[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if name:
            rest = TAG_REST.match(html, at)
            if not rest:  # a tag without an end has no text after it
                break
            at = rest.end()
        if not name or name in ("html", "body", "!doctype"):
            if name == "body" and not found[1]:
                close(("head",), ())
            continue
        if found[1]:
            until = CELL if name not in ("table", "tr", "tbody", "thead", "tfoot") and name not in CELL else frozenset(("table",))
            close((name,), until - {name})
            continue
        attributes = {}
        if len(rest[0]) > 2:
            for key, value in ATTRIBUTE.findall(rest[0]):
                quoted = value[:1] in ("'", '"')
                attributes.setdefault(key.lower(), unescape(value[1:-1] if quoted else value))
        raw = name in RAW and not foreign()
        start(name, attributes, rest[0].endswith("/>"))
        if raw:
            end = re.compile(rf"</{name}\s*>", re.IGNORECASE).search(html, at)
            stop = end.start() if end else size
            text(html[at:stop])
            close((name,), ())
            at = end.end() if end else size
    return root


# ------------------------------------------------------------------ layout


class Flow:
    """Lines of running text: white space collapsed, breaks kept apart by at most one blank line."""

    def __init__(self):
        self.lines: list[str] = []
        self.words: list[str] = []
        self.gap = 0  # line breaks that are due before the next text
        self.space = False
        self.indents: list[str] = [""]
        self.marker = ""
        self.pre = 0

    def text(self, data: str) -> None:
        if self.pre:
            for i, line in enumerate(data.split("\n")):
                if i:
                    self.new_line()
                if line:
                    self._put(line)
            return
        words = SPACE.split(data)
        if len(words) > 1 and not words[0]:
            self.space = True
        shown = " ".join(w for w in words if w)
        if shown:
            self._put(shown)
            self.space = len(words) > 1 and not words[-1]

    def _put(self, shown: str) -> None:
        if self.gap:
            self._end_line()
            if self.gap > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap, self.space = 0, False
        if not self.words:
            self.words.append(self.marker or self.indents[-1])
            self.marker = ""
            if self.space and not self.pre:
                self.space = False
        self.words.append(" " + shown if self.space and len(self.words) > 1 else shown)
        self.space = False

    def _end_line(self) -> None:
        if self.words:
            self.lines.append("".join(self.words).rstrip())
            self.words = []

    def new_line(self) -> None:
        if self.gap:
            return
        if self.words:
            self._end_line()
        elif self.lines and self.pre:
            self.lines.append("")
        self.space = False

    def apart(self, breaks: int) -> None:
        if self.words or self.lines:
            self.gap = max(self.gap, breaks)
        self.space = False

    def item(self, marker: str) -> None:
        self.apart(1)
        self.marker = self.indents[-1] + marker
        self.indents.append(self.indents[-1] + " " * len(marker))

    def item_end(self) -> None:
        if self.marker:  # an item without text is still an item
            self._put("")
        self.indents.pop()
        self.apart(1)

    def rows(self, lines: list[str]) -> None:
        self.apart(1)
        for line in lines:
            self._put(line)
            self.apart(1)

    def finished(self) -> list[str]:
        self._end_line()
        return self.lines


def lay_out(root: Node, flow: Flow, counts: Counter, depth: int = 0, unseen: bool = False) -> Iterator:
    """Write what is shown below ``root``.  A step for ``finish``: cells are further steps, not calls."""
    lists: list[list] = []
    stack: list[tuple[Iterator, Node | None, bool]] = [(iter(root.children), None, root.unseen(unseen))]
    while stack:
        children, parent, unseen = stack[-1]
        node = next(children, None)
        if node is None:
            stack.pop()
            if parent is not None:
                _leave(parent, flow, lists)
        elif isinstance(node, str):
            if not unseen:
                flow.text(node)
        elif not node.hidden:
            below = node.unseen(unseen)
            if node.tag == "table":
                counts["tables"] += 1
                if depth < MOST_NESTED and _has_columns(node):
                    flow.apart(2)
                    flow.rows((yield _table_lines(node, counts, depth + 1, below)))
                    flow.apart(2)
                    continue
            if node.tag == "select":
                if not below:
                    _put_options(node, flow)
                continue
            _enter(node, flow, lists, counts, below)
            shown = node.children
            if node.tag == "details" and "open" not in node.attributes:
                shown = [c for c in shown if not isinstance(c, str) and c.tag == "summary"][:1]
            stack.append((iter(shown), node, below))


def finish(step: Iterator):
    """The result of a step and of the steps that it yields, however deep, without recursion."""
    steps, answer = [step], None
    while steps:
        try:
            steps.append(steps[-1].send(answer))
            answer = None
        except StopIteration as done:
            steps.pop()
            answer = done.value
    return answer


def _enter(node: Node, flow: Flow, lists: list, counts: Counter, unseen: bool) -> None:
    tag = node.tag
    if tag == "br":
        flow.new_line()
    elif tag in ("td", "th"):
        flow.space = True
    elif tag in ("option", "optgroup", "text"):
        flow.apart(1)
    elif tag == "input":
        kind = node.attributes.get("type", "").lower()
        if not unseen and kind not in WORDLESS:
            flow.text(node.attributes.get("value") or node.attributes.get("placeholder", ""))
    elif tag in LISTS:
        flow.apart(1 if lists else 2)
        first = node.attributes.get("start", "")
        lists.append([tag, int(first) if first.isdecimal() and len(first) < 9 else 1])
    elif tag == "li":
        counts["items"] += 1
        if lists and lists[-1][0] == "ol":
            flow.item(f"{lists[-1][1]}. ")
            lists[-1][1] += 1
        else:
            flow.item("- ")
        if unseen:
            flow.marker = ""
    elif tag in BLOCK:
        counts["rows"] += tag == "tr"
        flow.apart(2 if tag in SPACED or tag == "table" else 1)
        flow.pre += tag == "pre"


def _leave(node: Node, flow: Flow, lists: list) -> None:
    tag = node.tag
    if tag in LISTS:
        lists.pop()
        flow.apart(1 if lists else 2)
    elif tag == "li":
        flow.item_end()
    elif tag in ("option", "optgroup", "text"):
        flow.apart(1)
    elif tag in BLOCK:
        flow.pre -= tag == "pre"
        flow.apart(2 if tag in SPACED or tag == "table" else 1)


def _words(root: Node) -> str:
    parts, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if isinstance(node, str):
            parts.append(node)
        elif not node.hidden:
            waiting += reversed(node.children)
    return " ".join("".join(parts).split())


def _put_options(select: Node, flow: Flow) -> None:
    """The last option that is marked as selected, else the first that is not disabled; all of a list box."""
    options, waiting = [], [select]
    while waiting:
        node = waiting.pop()
        if isinstance(node, str) or node.hidden:
            continue
        if node.tag == "option" or (node.tag == "optgroup" and node.attributes.get("label")):
            options.append(node)
        if node.tag != "option":
            waiting += reversed(node.children)
    name = lambda node: node.attributes.get("label") or _words(node)
    size = select.attributes.get("size", "")
    if "multiple" in select.attributes or (size.isdecimal() and len(size) < 9 and int(size) > 1):
        for node in options:
            flow.apart(1)
            flow.text(name(node))
        flow.apart(1)
        return
    options = [o for o in options if o.tag == "option"]
    chosen = [o for o in options if "selected" in o.attributes][-1:]
    chosen = chosen or [o for o in options if "disabled" not in o.attributes][:1]
    for node in chosen:
        flow.text(name(node))


def _span(node: Node, name: str, most: int) -> int:
    value = node.attributes.get(name, "")
    span = int(value) if value.isdecimal() and len(value) < 9 else 1
    return min(most, span or (most if name == "rowspan" else 1))  # zero: all rows of the group


def _is_cell(node: Node | str) -> bool:
    return not isinstance(node, str) and node.tag in ("td", "th") and not node.hidden


def _has_columns(root: Node) -> bool:
    """Whether any row of the table, or of its groups, has more than one cell."""
    groups = [root, *(c for c in root.children if not isinstance(c, str) and c.tag in ("thead", "tbody", "tfoot"))]
    rows = (r for g in groups for r in g.children if not isinstance(r, str) and r.tag == "tr")
    return any(sum(map(_is_cell, r.children)) > 1 for r in rows)


def _lines(node: Node, counts: Counter, depth: int, unseen: bool) -> Iterator:
    """The lines of a cell, a caption or what stands between them."""
    flow = Flow()
    if not _is_cell(node):
        holder = Node("div")
        holder.children.append(node)
        node = holder
    yield lay_out(node, flow, counts, depth, unseen)
    return flow.finished()


def _table_lines(root: Node, counts: Counter, depth: int, unseen: bool) -> Iterator:
    """Captions and what stands between cells, then rows with their cells in columns."""
    lines: list[str] = []
    rows: list[list[tuple[int, int, list[str]]]] = []
    covered: dict[int, int] = {}  # rows that a cell above still takes of a column
    waiting: list[tuple[Node | str, bool]] = [(root, unseen)]
    while waiting:
        node, unseen = waiting.pop()
        if isinstance(node, str):
            if node.strip() and not unseen:
                lines.append(" ".join(node.split()))
        elif node.hidden:
            continue
        elif node.tag == "tr":
            row, column, above = [], 0, dict(covered)
            counts["rows"] += 1
            within = node.unseen(unseen)
            for cell in node.children:
                if isinstance(cell, str):
                    if cell.strip() and not within:
                        lines.append(" ".join(cell.split()))
                elif not _is_cell(cell):
                    lines += yield _lines(cell, counts, depth, within)
                else:
                    while above.get(column, 0):
                        column += 1
                    wide, high = _span(cell, "colspan", MOST_COLUMNS), _span(cell, "rowspan", MOST_ROWS)
                    row.append((column, wide, (yield _lines(cell, counts, depth, within))))
                    for c in range(column, column + wide):
                        covered[c] = high
                    column += wide
            covered = {c: n - 1 for c, n in covered.items() if n > 1}
            rows.append(row)
        elif node is root or node.tag in ("thead", "tbody", "tfoot"):
            covered = {}  # cells don't reach into the next group
            below = unseen if node is root else node.unseen(unseen)
            waiting += [(child, below) for child in reversed(node.children)]
        else:
            lines += yield _lines(node, counts, depth, unseen)
    starts = _column_starts(rows)
    for row in rows:
        for number in range(max((len(cell) for _, _, cell in row), default=0)):
            line = ""
            for column, _, cell in row:
                if number < len(cell) and cell[number]:
                    if line and len(line) >= starts[column]:  # a line that ran on
                        lines.append(line)
                        line = ""
                    line = line.ljust(starts[column]) + cell[number]
            lines.append(line.rstrip())
    return lines


def _column_starts(rows: list[list[tuple[int, int, list[str]]]]) -> dict[int, int]:
    """Where each column starts, two blanks behind the widest line of the one before it."""
    cells = [(wide, column, max(map(len, cell), default=0)) for row in rows for column, wide, cell in row]
    text = sum(len(line) for row in rows for _, _, cell in row for line in cell)
    height = sum(max((len(cell) for _, _, cell in row), default=0) for row in rows)
    last = max((column + wide for wide, column, _ in cells), default=0)
    most = max((width for _, _, width in cells), default=0)
    while True:
        widths = [0] * last
        for wide, column, width in sorted(cells):
            room = sum(widths[column : column + wide]) + 2 * (wide - 1)
            widths[column + wide - 1] += max(0, min(width, most) - room)
        if most == 0 or height * sum(widths) <= PADDING * text + FREE_PADDING:
            break
        most //= 2
    starts, at = {}, 0
    for column, width in enumerate(widths):
        starts[column] = at
        at += width + 2
    return starts


def render(html: str | None) -> tuple[str, Counter]:
    """The text of a page and counts of its list items, tables and table rows."""
    counts: Counter = Counter()
    if not html:
        return "", counts
    flow = Flow()
    finish(lay_out(build_tree(html), flow, counts))
    return "\n".join(flow.finished()).strip("\n"), counts


TEXTS = "page_id long, text string, n_items long, n_tables long, n_rows long"


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_items, n_tables, n_rows) of every row of (page_id, html).

    A null or empty html has an empty text; a null page_id is kept; repeated
    rows are rendered each; an empty table gives no rows; other columns are
    ignored.  Time and memory follow the page's length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "html"):
            done = [render(html) for html in batch.column("html").to_pylist()]
            count = lambda name: pa.array([c[name] for _, c in done], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), pa.array([t for t, _ in done], pa.string()),
                 count("items"), count("tables"), count("rows")],
                names=["page_id", "text", "n_items", "n_tables", "n_rows"],
            )

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    return narrow.mapInArrow(run, TEXTS)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))
