"""A small element tree and CSS subset for listing pages.

Supported: type, ``*``, ``.class``, ``#id``, ``[attr]``, ``[attr=v]`` with ``=``,
``^=``, ``*=`` and ``$=``, descendant and child combinators, comma lists.
Anything else raises ``ValueError``.  Unclosed elements stay open until an
enclosing element ends, and end tags that match nothing are ignored.
"""

from __future__ import annotations

import html
import re
from html.parser import HTMLParser

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr basefont bgsound command frame "
    "image isindex nextid spacer".split()
)
_HIDDEN_TEXT = frozenset(["script", "style", "template"])


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def release(self) -> None:
        """Take a tree that is no longer used apart, so that its memory is free at once and not when cycles are looked for."""
        stack: list[Node | str] = [self]
        while stack:
            item = stack.pop()
            if isinstance(item, Node):
                stack.extend(item.children)
                item.children, item.parent = [], None

    def walk(self):
        """Elements below this one, in document order."""
        stack = list(reversed(self.children))
        while stack:
            child = stack.pop()
            if isinstance(child, Node):
                yield child
                stack.extend(reversed(child.children))

    def text(self) -> str:
        """Stripped text pieces joined by a space, without script and style contents."""
        pieces, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                if piece := item.strip():
                    pieces.append(piece)
            elif item is self or item.tag not in _HIDDEN_TEXT:
                stack.extend(reversed(item.children))
        return " ".join(pieces)

    def source(self) -> str:
        """The element as markup."""
        out, stack = [], [self]
        while stack:
            item = stack.pop()
            if isinstance(item, tuple):
                out.append(item[0])
            elif isinstance(item, str):
                out.append(item if _raw_text(stack) else html.escape(item, quote=False))
            else:
                attrs = "".join(f' {k}="{html.escape(v, quote=False).replace(chr(34), "&quot;")}"'
                                for k, v in item.attrs.items())
                out.append(f"<{item.tag}{attrs}{'/' if item.tag in _VOID else ''}>")
                if item.tag not in _VOID:
                    stack.append((f"</{item.tag}>",))
                    stack.extend(reversed(item.children))
        return "".join(out)


def _raw_text(stack: list) -> bool:
    ends = [item[0] for item in stack[-1:] if isinstance(item, tuple)]
    return ends in (["</script>"], ["</style>"])


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self._open = [self.root]

    def handle_starttag(self, tag, attrs):
        parent = self._open[-1]
        node = Node(tag, {k: v or "" for k, v in attrs}, parent)
        parent.children.append(node)
        if tag not in _VOID:
            self._open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self._open) - 1, 0, -1):
            if self._open[depth].tag == tag:
                del self._open[depth:]
                return

    def handle_data(self, data):
        self._open[-1].children.append(data)


def parse(markup: str) -> Node:
    builder = _Builder()
    builder.feed(markup)
    builder.close()
    return builder.root


_SIMPLE = re.compile(
    r"""(?P<type>\*|[A-Za-z][\w-]*)|\.(?P<cls>[\w-]+)|\#(?P<id>[\w-]+)
      |\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[\^*$]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<raw>[^\]\s]+))\s*)?\]""",
    re.VERBOSE,
)
_COMBINATOR = re.compile(r"\s*(>)\s*|\s+")
# A comma outside of quoted attribute values.
_COMMA = re.compile(r""",(?=(?:[^"']|"[^"]*"|'[^']*')*$)""")


class Selector:
    """A compiled selector list."""

    def __init__(self, text: str):
        self._chains = [self._chain(part.strip()) for part in _COMMA.split(text)]

    @staticmethod
    def _chain(text: str) -> list[tuple[str, list]]:
        """Compound selectors from left to right, each with the combinator before it."""
        chain, position, combinator = [], 0, " "
        while position < len(text):
            tests = []
            while found := _SIMPLE.match(text, position):
                if found["type"] and tests:
                    break
                tests.append(found.groupdict())
                position = found.end()
            if not tests:
                raise ValueError(f"unsupported selector: {text!r}")
            chain.append((combinator, tests))
            if position < len(text):
                between = _COMBINATOR.match(text, position)
                if not between or between.end() == len(text):
                    raise ValueError(f"unsupported selector: {text!r}")
                combinator = between[1] or " "
                position = between.end()
        if not chain:
            raise ValueError("empty selector")
        return chain

    @staticmethod
    def _is(node: Node, tests: list[dict]) -> bool:
        for t in tests:
            if t["type"]:
                if t["type"] not in ("*", node.tag) and t["type"].lower() != node.tag:
                    return False
            elif t["cls"]:
                if t["cls"] not in node.attrs.get("class", "").split():
                    return False
            elif t["id"]:
                if node.attrs.get("id") != t["id"]:
                    return False
            else:
                value = node.attrs.get(t["attr"].lower())
                if value is None:
                    return False
                wanted = next((t[k] for k in ("dq", "sq", "raw") if t[k] is not None), None)
                if t["op"] == "=" and value != wanted:
                    return False
                if t["op"] in ("^=", "*=", "$=") and not (
                    wanted and {"^=": value.startswith, "$=": value.endswith, "*=": value.__contains__}[t["op"]](wanted)
                ):
                    return False
        return True

    def _matches(self, node: Node, chain: list, last: int) -> bool:
        combinator, tests = chain[last]
        if node.parent is None or not self._is(node, tests):
            return False
        if last == 0:
            return True
        parent = node.parent
        if combinator == ">":
            return self._matches(parent, chain, last - 1)
        while parent is not None:
            if self._matches(parent, chain, last - 1):
                return True
            parent = parent.parent
        return False

    def select(self, root: Node):
        """Matching elements below the root, in document order."""
        for node in root.walk():
            if any(self._matches(node, chain, len(chain) - 1) for chain in self._chains):
                yield node

    def first(self, root: Node) -> Node | None:
        return next(self.select(root), None)


class Field:
    """A compiled field specification: where in an item its value is.

    ``css@text()`` and ``css`` give text, ``css@attr`` an attribute; the last
    ``@`` counts unless the specification starts with ``[``.  Without a css part
    the item's document itself is meant: it has text but no attributes.
    """

    def __init__(self, spec: str | None):
        spec = (spec or "").strip()
        css, at, attribute = spec.rpartition("@")
        if not at or spec.startswith("["):
            css, attribute = spec, "text()"
        css, self._attribute = css.strip(), attribute.strip()
        self._wanted, self._selector = bool(spec), Selector(css) if css else None

    def value(self, root: Node) -> str | None:
        """The value in a parsed item; empty values are null."""
        node = self._selector.first(root) if self._selector else root
        if node is None or not self._wanted:
            return None
        return (node.text() if self._attribute == "text()" else node.attrs.get(self._attribute)) or None


def extract_value(root: Node, spec: str | None) -> str | None:
    """Value of a field specification against a parsed item."""
    return Field(spec).value(root)
