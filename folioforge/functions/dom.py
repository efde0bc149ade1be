"""A tolerant HTML tree builder.

Pure Python on single documents; called on Arrow batches only. Every piece of
text keeps the number of its source line, counted from 1.
"""

from __future__ import annotations

import html
import re

# Element names by their part in parsing and layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template svg".split())
HIDDEN = frozenset("head script style title template noscript svg iframe object select option datalist meta link".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split()
)
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
#: an opening tag ends open elements of these names, up to the element that bounds the search
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu", "nav", "td", "body", "div", "aside", "section"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HIDING_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    """An element; children are nodes and (line, text) pairs."""

    __slots__ = ("tag", "attrs", "parent", "children", "line", "hidden")

    def __init__(self, tag: str, attrs: str, parent: "Node | None", line: int):
        self.tag, self.attrs, self.parent, self.line = tag, attrs, parent, line
        self.children: list = []
        self.hidden = bool(parent and parent.hidden) or tag in HIDDEN
        if attrs and not self.hidden and ("hidden" in attrs or "none" in attrs):
            a = self.attributes()
            self.hidden = "hidden" in a or a.get("aria-hidden") == "true" or bool(_HIDING_STYLE.search(a.get("style", "")))

    def attributes(self) -> dict[str, str]:
        return {k.lower(): html.unescape(a or b or c or "") for k, a, b, c in _ATTRIBUTE.findall(self.attrs)}


def parse(document: str) -> Node:
    """The tree of a document, whatever it is: end tags may be missing, crossed or stray."""
    root = node = Node("#root", "", None, 1)
    line, at = 1, 0
    while at < len(document):
        m = _TOKEN.match(document, at)
        text, tag = m.group(), m.group(2)
        start, at = line, m.end()
        line += text.count("\n")
        if tag is None:
            if text[0] != "<" or text == "<":
                node.children.append((start, text))
            continue
        tag = tag.lower()
        if m.group(1):
            there = node
            while there is not root and there.tag != tag:
                # an inline end tag doesn't end blocks
                if there.tag in BLOCK and tag not in BLOCK:
                    there = root
                else:
                    there = there.parent
            if there is not root:
                node = there.parent
            continue
        if tag in IMPLIED_END:
            ends, bounds = IMPLIED_END[tag]
            there, top = node, None
            while there is not root and there.tag not in bounds:
                if there.tag in ends:
                    top = there
                there = there.parent
            if top is not None:
                node = top.parent
        if tag in CLOSES_P:
            there = node
            while there is not root and there.tag not in BLOCK:
                there = there.parent
            if there.tag == "p":
                node = there.parent
        new = Node(tag, m.group(3), node, start)
        node.children.append(new)
        if tag in VOID or m.group(3).endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(document, at)
            stop = end.start() if end else len(document)
            new.children.append((line, document[at:stop]))
            at = end.end() if end else len(document)
            line += document.count("\n", m.end(), at)
            continue
        node = new
    return root


def elements(node: Node, tags: frozenset[str] | set[str] | None = None):
    """Elements below node in document order, of the given names or all; nesting of any depth."""
    stack = [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif isinstance(child, Node):
            if tags is None or child.tag in tags:
                yield child
            stack.append(iter(child.children))


def text_of(node: Node) -> str:
    """Text of an element and all below it, entities decoded, white space stripped around each piece."""
    pieces: list[str] = []
    stack = [iter(node.children)]
    while stack:
        child = next(stack[-1], None)
        if child is None:
            stack.pop()
        elif not isinstance(child, Node):
            pieces.append(html.unescape(child[1]).strip())
        elif child.tag not in ("script", "style", "template"):
            stack.append(iter(child.children))
    return "".join(pieces)


def ancestors(node: Node):
    """Elements around node, the nearest first."""
    while node.parent is not None:
        node = node.parent
        yield node


def classes(node: Node) -> list[str]:
    return node.attributes().get("class", "").split() if "class" in node.attrs else []
