"""Layout-aware rendering of the visible text of HTML trees.

`read` walks a tree once, without recursion, and gives the visible source lines
and, if asked for, a flat list of layout steps. `layout` makes text of the
steps: blocks on lines of their own with space between them, list marks,
preformatted text as it is, table cells in columns.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

from folioforge.functions.dom import BLOCK, Node

#: kinds of layout steps
TEXT, PRE, BREAK, BLOCK_EDGE, GAP_EDGE, ITEM, ITEM_END, TABLE, ROW, CELL, CELL_END, TABLE_END = range(12)
_SPAN = re.compile(r"colspan\s*=\s*[\"']?\s*(\d+)", re.I)
_START = re.compile(r"start\s*=\s*[\"']?\s*(-?\d+)", re.I)
_WRAPPERS = frozenset("header hgroup div span a".split())
#: a cell that claims more columns than this has this many: what follows is aligned all the same
MOST_COLUMNS = 1_000

Step = tuple[int, int, str]


@dataclass(slots=True)
class Line:
    """Visible text of a source line, and where it starts: in the content, in a headline, in which block."""

    pieces: list[str]
    inside: bool
    headline: bool
    block: Node

    def text(self) -> str:
        return " ".join(html.unescape("".join(self.pieces)).split())


@dataclass(slots=True)
class Reading:
    lines: dict[int, Line] = field(default_factory=dict)
    steps: list[Step] = field(default_factory=list)


@lru_cache(maxsize=50_000)
def style_of(tag: str, attrs: str) -> str:
    """Element name and class; '' without class."""
    m = re.search(r"(?:^|\s)class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", attrs, re.I)
    value = html.unescape(m.group(1) or m.group(2) or m.group(3) or "") if m else ""
    return f"{tag}.{value}" if value else ""


def _shown_texts(node: Node):
    """(text, whether it is in the first h1 around it) below node, without recursion."""
    stack = [(node, node.tag == "h1")]
    while stack:
        at, head = stack.pop()
        for child in reversed(at.children):
            if isinstance(child, Node):
                if not child.hidden:
                    stack.append((child, head or child.tag == "h1"))
            elif child[1].strip():
                yield child[1], head


def headline_of(root: Node) -> Node | None:
    """The first h1 with visible text."""
    stack = [root]
    while stack:
        at = stack.pop()
        if at.tag == "h1" and any(True for _ in _shown_texts(at)):
            return at
        stack.extend(c for c in reversed(at.children) if isinstance(c, Node) and not c.hidden)
    return None


def content_block(root: Node) -> Node | None:
    """The block that holds the headline and text besides it; None without a headline or such a block."""
    headline = headline_of(root)
    block = headline.parent if headline is not None else None
    while block is not None and block.parent is not None and block.tag in _WRAPPERS and all(head for _, head in _shown_texts(block)):
        block = block.parent
    return None if block is None or block.tag in ("#root", "html") else block


def read(root: Node, content: Node | None = None, steps: bool = False) -> Reading:
    """Visible source lines in order; with `steps` also the layout. Depth and size of the tree don't matter."""
    out = Reading()
    lines, add = out.lines, out.steps.append
    stack: list = []
    counters: list[int | None] = []
    node, children, block, inside, head, pre = root, iter(root.children), root, False, False, False
    while True:
        child = next(children, None)
        if child is None:
            if steps and node is not root:
                _close(node, counters, add)
            if not stack:
                return out
            node, children, block, inside, head, pre = stack.pop()
        elif not isinstance(child, Node):
            start, text = child
            for n, part in enumerate(text.split("\n"), start) if "\n" in text else ((start, text),):
                if part and not part.isspace():
                    own = lines.get(n)
                    if own is None:
                        lines[n] = Line([part], inside, head, block)
                    else:
                        own.pieces.append(part)
                if steps:
                    add((PRE if pre else TEXT, n, part if pre or n == start else " " + part))
        elif not child.hidden:
            stack.append((node, children, block, inside, head, pre))
            node, children, tag = child, iter(child.children), child.tag
            if tag in BLOCK:
                block = child
            inside = inside or child is content
            head = head or tag == "h1"
            pre = pre or tag == "pre"
            if steps:
                _open(child, counters, add)


def _open(node: Node, counters: list[int | None], add) -> None:
    tag = node.tag
    if tag == "br":
        add((BREAK, node.line, ""))
    elif tag == "table":
        add((TABLE, node.line, ""))
    elif tag == "tr":
        add((ROW, node.line, ""))
    elif tag in ("td", "th"):
        m = _SPAN.search(node.attrs)
        add((CELL, node.line, str(max(1, min(MOST_COLUMNS, int(m.group(1))))) if m else "1"))
    elif tag == "li":
        mark = "- "
        if counters and counters[-1] is not None:
            mark = f"{counters[-1]}. "
            counters[-1] += 1
        add((ITEM, node.line, mark))
    elif tag in ("ol", "ul", "menu"):
        m = _START.search(node.attrs)
        counters.append((int(m.group(1)) if m else 1) if tag == "ol" else None)
        add((GAP_EDGE if len(counters) == 1 else BLOCK_EDGE, node.line, ""))
    elif tag in BLOCK and tag not in ("tbody", "thead", "tfoot"):
        add((BLOCK_EDGE if tag == "div" else GAP_EDGE, node.line, ""))


def _close(node: Node, counters: list[int | None], add) -> None:
    tag = node.tag
    if tag == "table":
        add((TABLE_END, node.line, ""))
    elif tag in ("td", "th"):
        add((CELL_END, node.line, ""))
    elif tag == "li":
        add((ITEM_END, node.line, ""))
    elif tag in ("ol", "ul", "menu"):
        counters.pop()
        add((BLOCK_EDGE if counters else GAP_EDGE, node.line, ""))
    elif tag in BLOCK and tag not in ("tr", "tbody", "thead", "tfoot"):
        add((BLOCK_EDGE if tag == "div" else GAP_EDGE, node.line, ""))


def plain_steps(lines: list[tuple[int, str]]) -> list[Step]:
    """Steps of plain text: each line is a block, an empty source line between two is space."""
    out: list[Step] = []
    last = None
    for n, text in lines:
        out += [(GAP_EDGE if last is not None and n > last + 1 else BLOCK_EDGE, n, ""), (TEXT, n, text)]
        last = n
    return out


class _Frame:
    """What is being written: lines, and whether space is due before the next."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.gap = False
        self.pre_line: int | None = None
        self.marks: list[list] = []
        self.rows: list[list[tuple[int, list[str]]]] = []


def layout(steps: list[Step], keep: set[int] | None = None) -> str:
    """Text of the steps; only source lines in `keep` are shown, all if None."""
    frames = [_Frame()]
    buffer: list[str] = []
    spans: list[int] = []

    def put(text: str) -> None:
        top = frames[-1]
        if top.gap and top.lines:
            top.lines.append("")
        top.gap = False
        prefix = ""
        for k, m in enumerate(top.marks):
            prefix += m[0] if k == len(top.marks) - 1 and not m[1] else " " * len(m[0])
            m[1] = m[1] or k == len(top.marks) - 1
        top.lines.append(prefix + text)

    def flush() -> None:
        if buffer:
            text = " ".join(html.unescape("".join(buffer)).split())
            buffer.clear()
            if text:
                put(text)
        frames[-1].pre_line = None

    for op, n, text in steps:
        top = frames[-1]
        if op == TEXT:
            if keep is None or n in keep:
                buffer.append(text)
        elif op == PRE:
            if keep is None or n in keep:
                if top.pre_line == n:
                    top.lines[-1] += html.unescape(text)
                elif text.strip() or top.pre_line is not None:
                    flush()
                    put(html.unescape(text))
                    top.pre_line = n
        elif op in (BREAK, BLOCK_EDGE):
            flush()
        elif op == GAP_EDGE:
            flush()
            top.gap = True
        elif op == ITEM:
            flush()
            top.marks.append([text, False])
        elif op == ITEM_END:
            flush()
            if top.marks:
                top.marks.pop()
        elif op == TABLE:
            flush()
            frames.append(_Frame())
        elif op == ROW:
            flush()
            top.rows.append([])
        elif op == CELL:
            flush()
            spans.append(int(text))
            frames.append(_Frame())
        elif op == CELL_END:
            flush()
            cell = frames.pop()
            own = (spans.pop(), cell.lines)
            if frames[-1].rows:
                frames[-1].rows[-1].append(own)
            else:
                # a cell without a row
                for x in own[1]:
                    put(x)
        elif op == TABLE_END:
            flush()
            table = frames.pop()
            frames[-1].gap = bool(frames[-1].lines)
            for x in [*table.lines, *_table(table.rows)]:
                put(x)
            frames[-1].gap = True
    flush()
    return "\n".join(x.rstrip() for x in frames[0].lines).strip("\n")


def _table(rows: list[list[tuple[int, list[str]]]]) -> list[str]:
    """Lines of a table: cells in columns, or, where cells have several lines, which lays out a page, one after the other."""
    if any(len([x for x in lines if x]) > 1 for r in rows for _, lines in r):
        cells = [lines for r in rows for _, lines in r if lines]
        return [x for k, c in enumerate(cells) for x in ([""] if k else []) + c]
    flat = [[(span, " ".join(lines).strip()) for span, lines in r] for r in rows]
    widths: dict[int, int] = {}
    for r in flat:
        at = 0
        for span, text in r:
            if span == 1:
                widths[at] = max(widths.get(at, 0), len(text))
            at += span
    out = []
    for r in flat:
        line, at = "", 0
        for span, text in r:
            room = sum(widths.get(k, 0) for k in range(at, at + span)) + 2 * (span - 1)
            line += text.ljust(room) + "  "
            at += span
        if line.strip():
            out.append(line.rstrip())
    return out
