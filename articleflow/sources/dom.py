"""A light tree of one HTML page and the few selectors the rule table needs.

Runs inside tasks, one page at a time. Supported selectors: tag, ``.class``,
``#id``, ``[attr*=text]`` (any case), ``:not(.class)``, ``:first-child``,
descendant and ``>``, and comma lists.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Set
from functools import lru_cache
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "main nav ol p pre section table ul".split()
)
# An open element of the value is ended by a new element of the key.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table select body html".split())
P_SCOPE = SCOPE | frozenset("td th li div article section".split())
SILENT = frozenset(("script", "style", "template"))


# Tags, comments and declarations. A quoted value ends at its quote and may hold ``>``; a quote
# elsewhere, or one that is never closed, is an ordinary character. Nothing is tried twice.
_NAME = r"[^\s/>=][^\s/>=]*+"
_VALUE = r"(?:\"[^\"]*+\"|'[^']*+'|[^\s>]++)"
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/=]++|{_NAME}(?:\s*+=\s*+{_VALUE})?+)*+)>", re.DOTALL
)
_ATTRIBUTE = re.compile(rf"({_NAME})(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]++)))?+")
# Elements whose content is text only, up to their end tag.
_RAW = ("script", "style", "textarea", "title")
_RAW_END = {tag: re.compile(f"</{tag}", re.IGNORECASE) for tag in _RAW}


class Node:
    __slots__ = ("tag", "raw", "items", "parent", "_attrs")

    def __init__(self, tag: str, raw: str, parent: Node | None):
        self.tag, self.raw, self.parent = tag, raw, parent
        self.items: list[Node | str] = []
        self._attrs: dict[str, str] | None = None

    @property
    def attrs(self) -> dict[str, str]:
        """Attributes, read when first asked for: most elements are never asked."""
        if self._attrs is None:
            self._attrs = {
                m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(self.raw)
            }
        return self._attrs

    def descend(self, skip: Set[Node] = frozenset()) -> Iterator[Node]:
        """Elements below this one in document order, without ``skip`` and their content."""
        stack = [iter(self.items)]
        while stack:
            for item in stack[-1]:
                if isinstance(item, Node) and item not in skip:
                    yield item
                    stack.append(iter(item.items))
                    break
            else:
                stack.pop()

    def text(self, sep: str = " ", skip: Set[Node] = frozenset()) -> str:
        """Trimmed text pieces below this element, joined by ``sep``."""
        out: list[str] = []
        stack = [iter(self.items)]
        while stack:
            for item in stack[-1]:
                if isinstance(item, str):
                    piece = (unescape(item) if "&" in item else item).strip()
                    if piece:
                        out.append(piece)
                elif item not in skip and item.tag not in SILENT:
                    stack.append(iter(item.items))
                    break
            else:
                stack.pop()
        return sep.join(out)


# Elements that begin and end a line of shown text; cells of a row stand on one line.
LINES = BLOCK | frozenset("body br caption center dd details dt figcaption figure html legend li optgroup option summary tbody tfoot thead tr".split())
CELLS = frozenset(("td", "th"))
UNSHOWN = frozenset((*SILENT, "head", "title", "noscript"))


def text_lines(root: Node) -> list[tuple[str, str]]:
    """The lines of text as a page shows them, blanks collapsed, each with the address of the first link
    that covers part of it (empty if none does)."""
    out: list[tuple[str, str]] = []
    buffer: list[str] = []
    anchors: list[str] = []
    link = ""

    def end_line() -> None:
        nonlocal link
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                out.append((text, link))
            buffer.clear()
        link = ""

    stack: list[tuple[Node, Iterator[Node | str]]] = [(root, iter(root.items))]
    while stack:
        node, items = stack[-1]
        for item in items:
            if isinstance(item, str):
                text = unescape(item) if "&" in item else item
                buffer.append(text)
                if anchors and not link and text.strip():
                    link = anchors[-1]
            elif item.tag not in UNSHOWN:
                if item.tag in LINES:
                    end_line()
                elif item.tag in CELLS:
                    buffer.append(" ")
                if item.tag == "a":
                    anchors.append(item.attrs.get("href", "").strip())
                stack.append((item, iter(item.items)))
                break
        else:
            stack.pop()
            if node.tag in LINES:
                end_line()
            elif node.tag == "a":
                anchors.pop()
    end_line()
    return out


class _Open:
    """The open elements: where the next one goes, and how many there are of each tag."""

    def __init__(self, root: Node):
        self.at = root
        self.count: dict[str, int] = {}

    def push(self, node: Node) -> None:
        self.count[node.tag] = self.count.get(node.tag, 0) + 1
        self.at = node

    def close(self, tags: Set[str], stop: Set[str] = frozenset()) -> None:
        """End the nearest open element of ``tags``, not looking beyond ``stop``. A tag that is not
        open costs nothing, and every element is passed once when it is ended."""
        if not any(self.count.get(t) for t in tags):
            return
        node = self.at
        while node.parent is not None and node.tag not in tags:
            if node.tag in stop:
                return
            node = node.parent
        if node.parent is None or node.tag in stop:
            return
        while self.at is not node.parent:
            self.count[self.at.tag] -= 1
            self.at = self.at.parent


def parse(html: str) -> Node:
    root = Node("", "", None)
    opened = _Open(root)
    end, last = 0, html.rfind(">")
    while True:
        # Behind the last ``>`` no tag can end.
        mark = _MARKUP.search(html, end) if end <= last or html.startswith("<!--", end) else None
        if mark is None:
            if end < len(html):
                opened.at.items.append(html[end:])
            return root
        if mark.start() > end:
            opened.at.items.append(html[end : mark.start()])
        end = mark.end()
        if mark[2] is None:
            continue
        tag = mark[2].lower()
        if mark[1]:
            opened.close({tag})
            continue
        if tag in BLOCK:
            opened.close({"p"}, P_SCOPE)
        if tag in ENDS:
            opened.close(ENDS[tag], SCOPE)
        node = Node(tag, mark[3], opened.at)
        opened.at.items.append(node)
        if tag in _RAW:
            stop = _RAW_END[tag].search(html, end)
            close = stop.start() if stop else len(html)
            node.items.append(html[end:close])
            end = close
            opened.push(node)
        elif tag not in VOID and not mark[3].endswith("/"):
            opened.push(node)


_PART = re.compile(
    r"(?P<tag>^[a-zA-Z][\w-]*)|\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)"
    r"|\[(?P<attr>[\w-]+)(?:\*=(?P<val>[^\]]*))?\]|:not\(\.(?P<no>[\w-]+)\)|(?P<fc>:first-child)"
)


@lru_cache(maxsize=512)
def _compile(selector: str) -> tuple[dict, tuple]:
    """Alternatives by the tag they ask for, and those for any tag.

    An alternative is a tuple of (child_of, tests), last compound first.
    """
    by_tag: dict[str, tuple] = {}
    any_tag: tuple = ()
    for alternative in selector.split(","):
        steps, child = [], False
        for word in alternative.split():
            if word == ">":
                child = True
                continue
            tests = tuple((m.lastgroup, m.groupdict()) for m in _PART.finditer(word))
            steps.append((child, tests))
            child = False
        if not steps:
            continue
        tag = next((g["tag"] for kind, g in steps[-1][1] if kind == "tag"), None)
        if tag is None:
            any_tag += (tuple(reversed(steps)),)
        else:
            by_tag[tag] = by_tag.get(tag, ()) + (tuple(reversed(steps)),)
    return by_tag, any_tag


def _is(node: Node, tests: tuple) -> bool:
    for kind, g in tests:
        if kind == "tag":
            if node.tag != g["tag"]:
                return False
        elif kind == "fc":
            if node is not next(i for i in node.parent.items if isinstance(i, Node)):
                return False
        elif kind == "no":
            if g["no"] in node.attrs.get("class", "").split():
                return False
        elif not node.raw:
            return False
        elif kind == "cls":
            if g["cls"] not in node.attrs.get("class", "").split():
                return False
        elif kind == "id":
            if node.attrs.get("id") != g["id"]:
                return False
        else:
            value = node.attrs.get(g["attr"])
            if value is None or (g["val"] and g["val"].lower() not in value.lower()):
                return False
    return True


def _matches(node: Node, steps: tuple) -> bool:
    child, tests = steps[0]
    if not _is(node, tests):
        return False
    if len(steps) == 1:
        return True
    up = node.parent
    if child:
        return up is not None and _matches(up, steps[1:])
    while up is not None:
        if _matches(up, steps[1:]):
            return True
        up = up.parent
    return False


def select(root: Node, selector: str, skip: Set[Node] = frozenset()) -> Iterator[Node]:
    by_tag, any_tag = _compile(selector)
    for node in root.descend(skip):
        for steps in by_tag.get(node.tag, ()):
            if _matches(node, steps):
                yield node
                break
        else:
            if any_tag and any(_matches(node, steps) for steps in any_tag):
                yield node


def first(root: Node, selector: str, skip: Set[Node] = frozenset()) -> Node | None:
    return next(select(root, selector, skip), None) if selector else None
