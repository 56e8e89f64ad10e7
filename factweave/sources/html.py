"""A tolerant HTML tree over the standard library's tokenizer, with the few selectors that cards need."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: A start tag that ends open elements of these names. Fixed values.
CLOSES = {"p": ("p",), "li": ("li",), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th"), "option": ("option",)}
SILENT = frozenset(("script", "style", "template"))


class Node:
    __slots__ = ("attrs", "children", "order", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None, order: int):
        self.tag, self.attrs, self.parent, self.order, self.children = tag, attrs, parent, order, []

    @property
    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def walk(self) -> Iterator[Node]:
        """Elements below, in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            node = stack.pop()
            yield node
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self, separator: str = " ") -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                out.append(item)
            elif item.tag not in SILENT:
                stack += reversed(item.children)
        return " ".join(separator.join(out).split())

    def ancestors(self) -> Iterator[Node]:
        node = self.parent
        while node is not None:
            yield node
            node = node.parent

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None, 0)
        self.n = 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        for name in CLOSES.get(tag, ()):
            node = self.at
            while node.parent is not None and node.tag not in (name, "table", "ul", "ol", "div", "section", "body"):
                node = node.parent
            if node.tag == name:
                self.at = node.parent
        self.n += 1
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at, self.n)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data: str) -> None:
        self.at.children.append(data)


def parse(html: str | None) -> Node:
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


_SIMPLE = re.compile(r"([a-zA-Z][a-zA-Z0-9]*)|\.([\w-]+)|\[([\w-]+)(?:([*$^]?)=['\"]?([^'\"\]]*)['\"]?)?\]|:(first-of-type|first-child)")


def _fits(node: Node, simple: str) -> bool:
    for tag, cls, attr, how, want, place in _SIMPLE.findall(simple):
        if tag and node.tag != tag.lower() or cls and cls not in node.classes:
            return False
        if attr:
            value = node.attrs.get(attr)
            if value is None or want and not {"*": want in value, "$": value.endswith(want), "^": value.startswith(want), "": value == want}[how]:
                return False
        if place:
            same = [e for e in node.parent.elements() if place == "first-child" or e.tag == node.tag] if node.parent else [node]
            if same[0] is not node:
                return False
    return True


def matches(node: Node, selector: str) -> bool:
    """Alternatives by commas; within one, steps by white space (ancestor) or `+` (the element before)."""
    return any(_chain(node, one.replace("+", " + ").split()) for one in selector.split(","))


def _chain(node: Node, steps: list[str]) -> bool:
    if not steps or not _fits(node, steps[-1]):
        return False
    rest = steps[:-1]
    if not rest:
        return True
    if rest[-1] == "+":
        around = node.parent.elements() if node.parent else []
        k = next(k for k, e in enumerate(around) if e is node)
        return k > 0 and _chain(around[k - 1], rest[:-1])
    return any(_chain(a, rest) for a in node.ancestors())


def select(node: Node, selector: str) -> list[Node]:
    return [n for n in node.walk() if matches(n, selector)]


def first(node: Node, selector: str) -> Node | None:
    return next((n for n in node.walk() if matches(n, selector)), None)
