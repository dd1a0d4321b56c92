"""Parsing expressions: small matchers that are put together to grammars and give parse trees.

A matcher takes (text, place) and gives (node, new place), or None where it doesn't match. A node is (name, text or children).
"""

from __future__ import annotations

import re
from collections.abc import Callable

Node = tuple[str, object]
Match = Callable[[str, int], "tuple[Node, int] | None"]


def rx(pattern: str, name: str = "", flags: int = 0) -> Match:
    """Text that a regular expression matches here."""
    compiled = re.compile(pattern, flags)

    def match(s: str, i: int):
        m = compiled.match(s, i)
        return m and ((name, m[0]), m.end())

    return match


def seq(*parts: Match, name: str = "") -> Match:
    """All parts, one after the other."""

    def match(s: str, i: int):
        nodes = []
        for p in parts:
            r = p(s, i)
            if r is None:
                return None
            nodes.append(r[0])
            i = r[1]
        return (name, nodes), i

    return match


def alt(*parts: Match) -> Match:
    """The first part that matches."""

    def match(s: str, i: int):
        for p in parts:
            if (r := p(s, i)) is not None:
                return r
        return None

    return match


def opt(part: Match) -> Match:
    return lambda s, i: part(s, i) or (("", ""), i)


def many(part: Match, name: str = "", least: int = 0) -> Match:
    """As often as the part matches."""

    def match(s: str, i: int):
        nodes = []
        while (r := part(s, i)) is not None and r[1] > i:
            nodes.append(r[0])
            i = r[1]
        return ((name, nodes), i) if len(nodes) >= least else None

    return match


def find(node: Node, name: str) -> Node | None:
    """The first node of this name in the tree, the node itself included."""
    if node[0] == name:
        return node
    if isinstance(node[1], list):
        for child in node[1]:
            if (r := find(child, name)) is not None:
                return r
    return None


def text_of(node: Node | None) -> str:
    """All text under a node."""
    if node is None:
        return ""
    return node[1] if isinstance(node[1], str) else "".join(map(text_of, node[1]))
