"""A small parsing-expression-grammar engine whose terminals are compiled patterns.

A rule is a function ``(text, pos, state) -> Node | None``. Choice is ordered and the first alternative that
matches wins, so a grammar is unambiguous by construction. Repetition loops, it does not recurse: the depth of
the stack follows the nesting of the text, bounded by ``MAX_DEPTH``, never its length.
"""

from __future__ import annotations

from collections.abc import Callable

import regex

MAX_DEPTH = 60


class Node:
    __slots__ = ("name", "start", "end", "kids", "value")

    def __init__(self, name: str, start: int, end: int, kids: list | None = None, value=None):
        self.name, self.start, self.end, self.kids, self.value = name, start, end, kids, value


Rule = Callable[[str, int, dict], Node | None]


def rx(name: str, pattern: str, flags: int = 0) -> Rule:
    match = regex.compile(pattern, flags | regex.V1).match

    def run(text: str, pos: int, state: dict) -> Node | None:
        m = match(text, pos)
        return Node(name, pos, m.end()) if m else None

    return run


def seq(name: str, *parts: Rule) -> Rule:
    def run(text: str, pos: int, state: dict) -> Node | None:
        kids, at = [], pos
        for p in parts:
            n = p(text, at, state)
            if n is None:
                return None
            kids.append(n)
            at = n.end
        return Node(name, pos, at, kids)

    return run


def choice(*parts: Rule) -> Rule:
    def run(text: str, pos: int, state: dict) -> Node | None:
        for p in parts:
            n = p(text, pos, state)
            if n is not None:
                return n
        return None

    return run


def star(name: str, part: Rule) -> Rule:
    def run(text: str, pos: int, state: dict) -> Node | None:
        kids, at = [], pos
        while at < len(text):
            n = part(text, at, state)
            if n is None or n.end == at:
                break
            kids.append(n)
            at = n.end
        return Node(name, pos, at, kids)

    return run


def guard(first: str, part: Rule) -> Rule:
    """Try ``part`` only where the next character is one of ``first``."""
    chars = frozenset(first)
    return lambda text, pos, state: part(text, pos, state) if pos < len(text) and text[pos] in chars else None


def nested(get: Callable[[], Rule]) -> Rule:
    """A rule named before it is defined; fails beyond ``MAX_DEPTH`` levels instead of exhausting the stack.

    Results are remembered by position, so text that nests without end is tried once, not once per level; what came
    out under a limit of depth is not remembered, as it may come out otherwise from a lower level.
    """

    def run(text: str, pos: int, state: dict) -> Node | None:
        memo = state.setdefault("memo", {})
        if pos in memo:
            return memo[pos]
        if state.get("depth", 0) >= MAX_DEPTH:
            state["limited"] = True
            return None
        before, state["limited"] = state.get("limited", False), False
        state["depth"] = state.get("depth", 0) + 1
        try:
            got = get()(text, pos, state)
        finally:
            state["depth"] -= 1
        if not state["limited"]:
            memo[pos] = got
        state["limited"] = state["limited"] or before
        return got

    return run
