"""Layout-aware text of web pages.

Each page is parsed into a tree (a small builder with implied end tags, heads and table rows) and the
tree is rendered as a reader sees it: elements that are not displayed are left out with their content (a closed
``details`` shows its first summary only), the text of invisible ones up to a child that is visible again; of
several declarations of a property the last valid one holds, an important one before others. Blocks stand on
lines of their own, paragraphs are set off by an empty line, list items are bulleted or numbered and
indented, the cells of a table are padded to the columns' widths (a cell over several columns to their
joint width, one over several rows stands in the first), and preformatted text keeps its spacing.
Nothing is scored or removed as boilerplate: all visible text is emitted.

Pages are independent, so this is one pass without a shuffle; parsing and rendering use explicit
stacks, so nesting is bounded by memory and not by Python's recursion. Tables up to ``DEEP`` levels
are aligned, cells below that are joined by blanks.

Defined results: null, empty and all-hidden pages give empty text; unclosed tags, quotes and comments
end with the page; stray end tags are ignored, as is an inline
end tag whose element holds a block that is still open; text outside any tag is text; repeated rows give repeated
results; an empty table gives an empty result; extra columns pass through, result columns replace those
of the same name.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.common import map_in_arrow, read_table

# fixed values: element classes of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
INVISIBLE = frozenset("head script style title template noscript iframe noembed noframes datalist audio video canvas svg object select param meta link base".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption search".split())
SPACED = frozenset("p blockquote dl h1 h2 h3 h4 h5 h6 ol ul menu dir pre table figure".split())
CLOSES_P = BLOCK - frozenset("html body td th tr tbody thead tfoot caption li dd dt legend summary".split())
# a start tag ends open elements of these kinds, looked for up to one of the scopes
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}, {"table"}),
    "body": ({"head"}, set()), "rp": ({"rp", "rt"}, {"ruby"}), "rt": ({"rp", "rt"}, {"ruby"}),
}
SCOPE = frozenset("table td th caption html body".split())
TABLE_PARTS = frozenset("caption tbody thead tfoot tr td th".split())
LISTS = frozenset("ul ol menu dir".split())
DISPLAYS = frozenset("none block inline inline-block flex inline-flex grid inline-grid table inline-table table-row table-cell table-caption table-row-group table-header-group table-footer-group table-column table-column-group list-item contents flow-root run-in ruby ruby-text inherit initial unset revert revert-layer".split())
VISIBILITIES = {"visible": True, "initial": True, "hidden": False, "collapse": False, "inherit": None, "unset": None, "revert": None, "revert-layer": None}
# the largest spans of a cell
COLUMNS, ROWS = 1000, 65534
# start tags that leave an open head open; any other, and text, ends it
HEAD = frozenset("head base link meta title noscript noframes style script template".split())

DEEP = 8
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*+"|'[^']*+'|[^>"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARATION = re.compile(r"""(?:[^;"'(]|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|\([^)]*(?:\)|\Z))+""")
_IMPORTANT = re.compile(r"\s*!\s*important\Z")
_NEWLINE = re.compile(r"\r\n?|\n")
_SPACE = re.compile(r"[ \t\n\f\r]+")


class Node:
    """An element. ``visible``: None where the parent's holds; ``closed``: only the first summary is shown."""

    __slots__ = ("tag", "children", "hidden", "visible", "closed", "start", "span")

    def __init__(self, tag: str, hidden: bool = False):
        self.tag, self.children, self.hidden = tag, [], hidden
        self.visible, self.closed, self.start, self.span = None, False, 1, (1, 1)


def declared(style: str, name: str, valid) -> str | None:
    """The value of a property in a style attribute: the last valid one, important ones before others."""
    found, strong = None, False
    for declaration in _DECLARATION.findall(_COMMENT.sub(" ", style)):
        key, _, value = declaration.partition(":")
        if key.strip().lower() == name:
            value = value.strip().lower()
            plain = _IMPORTANT.sub("", value)
            if plain in valid and (plain != value or not strong):
                found, strong = plain, plain != value
    return found


def _span(given: str, least: int, most: int) -> int:
    digits = re.match(r"\s*\+?(\d+)", given)
    number = int(digits[1][:9]) if digits else 1
    return min(number, most) if number >= least else 1


def _element(tag: str, attributes: str) -> Node:
    node = Node(tag, tag in INVISIBLE)
    if node.hidden:
        return node
    given: dict[str, str] = {}
    for k, v in _ATTR.findall(attributes) if attributes else ():
        given.setdefault(k.lower(), html.unescape((v or "").strip("\"'")))
    display = None
    if "style" in given:
        display = declared(given["style"], "display", DISPLAYS)
        node.visible = VISIBILITIES.get(declared(given["style"], "visibility", VISIBILITIES))
    node.hidden = display == "none" or display is None and ("hidden" in given or tag == "dialog" and "open" not in given)
    node.closed = tag == "details" and "open" not in given
    if tag == "ol" and re.fullmatch(r"-?\d{1,9}", given.get("start", "")):
        node.start = int(given["start"])
    if tag in ("td", "th"):
        node.span = _span(given.get("colspan", ""), 1, COLUMNS), _span(given.get("rowspan", ""), 0, ROWS)
    return node


def _ends_search(tag: str, passed: str) -> bool:
    """An end tag does not reach beyond an open element of the second kind."""
    if tag == "table":
        return False
    if tag in TABLE_PARTS:
        return passed == "table"
    if tag not in BLOCK:
        return passed in BLOCK
    return passed in ("table", "td", "th", "caption") or tag == "li" and passed in LISTS


def build(page: str) -> Node:
    """Tree of a page: children are Nodes and pieces of text."""
    root = Node("html")
    stack, at = [root], 0

    def close(kinds, scopes) -> None:
        """End the outermost open element of these kinds within the scope."""
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in scopes:
                break
            if stack[i].tag in kinds:
                found = i
                while found > 1 and stack[found - 1].tag in kinds:
                    found -= 1
                del stack[found:]
                return

    def add(node: Node) -> None:
        stack[-1].children.append(node)
        stack.append(node)

    def end_head() -> None:
        while stack[-1].tag == "head":
            stack.pop()

    def add_text(piece: str) -> None:
        if stack[-1].tag == "head" and piece.strip(" \t\n\f\r"):
            end_head()
        stack[-1].children.append(html.unescape(piece))

    for m in iter(lambda: _TAG.search(page, at), None):
        if m.start() > at:
            add_text(page[at:m.start()])
        at = m.end()
        end, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if _ends_search(tag, stack[i].tag):
                    break
            continue
        if tag == "html":
            continue
        if tag not in HEAD:
            end_head()
        if tag in ENDS:
            close(*ENDS[tag])
        if tag in CLOSES_P:
            close({"p"}, SCOPE)
        if tag in ("td", "th") and stack[-1].tag != "tr":
            add(Node("tr"))
        node = _element(tag, attributes)
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            stack[-1].children.append(node)
        elif tag in RAW:
            stop = re.compile(f"</{re.escape(tag)}", re.I).search(page, at)
            if not node.hidden:
                node.children.append(html.unescape(page[at:stop.start() if stop else len(page)]))
            stack[-1].children.append(node)
            at = stop.start() if stop else len(page)
        else:
            add(node)
            if tag == "pre" and (line := _NEWLINE.match(page, at)):
                at = line.end()
    if at < len(page):
        add_text(page[at:])
    return root


class Writer:
    """Lines of a block; white space is collapsed outside preformatted text."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.prefix, self.mark, self.gap, self.pre, self.blank = "", "", False, 0, False

    def text(self, s: str) -> None:
        if self.pre:
            first, *rest = s.split("\n")
            self._put(first)
            for part in rest:
                if self.gap and not self.line:  # an empty first line stands after the block's gap
                    self.lines += [""] * bool(self.lines)
                    self.gap = False
                self._end(keep=True)
                self._put(part)
            return
        s = _SPACE.sub(" ", s)
        if s.startswith(" "):
            self.blank = bool(self.line)
            s = s[1:]
        if s:
            tail = s.endswith(" ")
            self._put((" " if self.blank else "") + (s[:-1] if tail else s))
            self.blank = tail

    def _put(self, s: str) -> None:
        if s:
            if self.gap and self.lines:
                self.lines.append("")
            self.gap = False
            self.line.append(s)

    def _end(self, keep: bool = False) -> None:
        if self.line or keep:
            body = "".join(self.line)
            self.lines.append((self.prefix + self.mark + body).rstrip())
            if self.mark:
                self.mark = ""
        self.line, self.blank = [], False

    def newline(self) -> None:
        self._end(keep=bool(self.line) or bool(self.lines))

    def block(self, spaced: bool) -> None:
        self._end()
        self.gap |= spaced

    def whole(self) -> str:
        self._end()
        lines = self.lines
        while lines and not lines[-1].strip():
            lines.pop()
        return "\n".join(lines)


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in s)


def placed(rows: list[list[tuple[str, tuple[int, int]]]]) -> list[list[tuple[int, int, str]]]:
    """(first column, column after the last, text) of the cells of each row; columns in which no cell starts are left out."""
    out, above = [], []  # above: (column, column after, first row without it) of cells from earlier rows
    for r, row in enumerate(rows):
        above = sorted(x for x in above if x[2] > r)
        at, k, cells, down = 0, 0, [], []
        for text, (columns, deep) in row:
            while k < len(above) and above[k][0] <= at:
                at = max(at, above[k][1])
                k += 1
            cells.append((at, at + columns, text))
            if deep != 1:
                down.append((at, at + columns, r + deep if deep else len(rows)))
            at += columns
        above += down
        out.append(cells)
    starts = sorted({a for cells in out for a, _, _ in cells})
    return [[(bisect_left(starts, a), bisect_left(starts, b), text) for a, b, text in cells] for cells in out]


def table_lines(rows: list[list[tuple[str, tuple[int, int]]]]) -> list[str]:
    """Rows of cells (text, (columns, rows)), padded to the width of their columns; a cell of several lines takes several lines."""
    cut = [[(a, b, text.split("\n")) for a, b, text in cells] for cells in placed(rows) if any(text for _, _, text in cells)]
    widths = [0] * max((b for cells in cut for _, b, _ in cells), default=0)
    wide = []
    for cells in cut:
        for a, b, lines in cells:
            if b == a + 1:
                widths[a] = max(widths[a], *map(_width, lines))
            else:
                wide.append((b - a, b, max(map(_width, lines))))
    for n, b, width in sorted(wide):  # the last column of a wide cell takes what the others leave
        widths[b - 1] += max(0, width - sum(widths[b - n:b]) - 3 * (n - 1))
    out = []
    for cells in cut:
        for k in range(max(len(lines) for _, _, lines in cells)):
            parts, at = [], 0
            for a, b, lines in cells:
                parts += [" " * w for w in widths[at:a]]
                line = lines[k] if k < len(lines) else ""
                parts.append(line + " " * (sum(widths[a:b]) + 3 * (b - a - 1) - _width(line)))
                at = max(at, b)
            out.append(" | ".join(parts).rstrip())
    return out


def render(root: Node) -> str:
    """Visible text of a tree."""
    writers, tables, lists, deep, shown = [Writer()], [], [], 0, True
    todo: list = [root]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            if shown:
                writers[-1].text(x)
            continue
        if isinstance(x, tuple):  # the end of an element
            tag, saved = x
            w = writers[-1]
            if tag == "visible":
                shown = saved
            elif tag == "cell":
                cell = writers.pop().whole()
                tables[-1][-1].append((cell, saved))
            elif tag == "table":
                w.block(True)
                for line in table_lines(tables.pop()):
                    w._put(line)
                    w._end()
                w.block(True)
            else:
                w.block(tag in SPACED)
                if tag == "pre":
                    w.pre -= 1
                elif tag == "deep":
                    deep -= 1
                elif tag in ("ul", "ol", "menu", "dir"):
                    lists.pop()
                    if lists:
                        w.gap = False
                elif tag in ("li", "blockquote", "dd"):
                    w.prefix, w.mark = saved, ""
            continue
        tag, w = x.tag, writers[-1]
        if x.hidden:
            continue
        if x.visible is not None and x.visible != shown:
            todo.append(("visible", shown))
            shown = x.visible
        if tag == "br":
            w.newline()
            continue
        if tag == "hr":
            w.block(True)
            continue
        if tag in ("td", "th") and tables and tables[-1] and not deep:
            writers.append(Writer())
            todo.append(("cell", x.span))
        elif tag in BLOCK:
            nested_list = tag in ("ul", "ol", "menu", "dir") and lists
            w.block(tag in SPACED and not nested_list)
            saved = w.prefix
            if tag == "table" and len(tables) < DEEP:
                tables.append([])
                todo.append((tag, None))
            else:
                deep += tag == "table"
                todo.append(("deep" if tag == "table" else "div" if tag in ("td", "th") else tag, saved))
            if tag == "tr" and tables and not deep:
                tables[-1].append([])
            elif tag == "pre":
                w.pre += 1
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag == "ol", x.start])
            elif tag == "li":
                numbered = bool(lists) and lists[-1][0]
                w.mark = "" if not shown else f"{lists[-1][1]}. " if numbered else "- "
                if numbered:
                    lists[-1][1] += 1
                depth = max(len(lists) - 1, 0)
                w.prefix = saved if not depth else saved + "  "
            elif tag == "blockquote":
                w.prefix = saved + "> "
            elif tag == "dd":
                w.prefix = saved + "  "
        if x.closed:
            todo += [c for c in x.children if isinstance(c, Node) and c.tag == "summary"][:1]
        else:
            todo.extend(reversed(x.children))
    return writers[0].whole()


def page_text(page: str | None) -> str:
    return render(build(page)) if page else ""


def extract(pages: DataFrame, column: str = "html") -> DataFrame:
    """``pages`` without the page source, with ``text``."""
    kept = [f for f in pages.schema.fields if f.name not in (column, "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                b = whole.slice(a, 500)
                text = pa.array([page_text(p) for p in b.column(column).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(f.name) for f in kept] + [text], names=[f.name for f in kept] + ["text"])

    return map_in_arrow(pages, run, T.StructType([*kept, T.StructField("text", T.StringType())]))


def op6_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", F.length("text").cast("long").alias("n_chars"), "text")
