"""Helpers for writing long column expressions as SQL text.

The geometry expressions run to thousands of calls; as text they reach the JVM in one.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

_NUMBERS = count()


def fresh(stem: str = "v") -> str:
    """A lambda variable name that no other expression uses."""
    return f"{stem}_{next(_NUMBERS)}"


def num(value: float) -> str:
    """Double literal."""
    return f"({float(value)!r}D)"


def struct(**fields: str) -> str:
    """Struct with the given fields."""
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def each(items: str, body: Callable[[str], str], stem: str = "e") -> str:
    """``body`` of every item."""
    v = fresh(stem)
    return f"transform({items}, {v} -> {body(v)})"


def each_indexed(items: str, body: Callable[[str, str], str], stem: str = "e") -> str:
    """``body`` of every item and its 0-based place."""
    v, i = fresh(stem), fresh("i")
    return f"transform({items}, ({v}, {i}) -> {body(v, i)})"


def keep(items: str, test: Callable[[str], str], stem: str = "k") -> str:
    """Items that pass ``test``."""
    v = fresh(stem)
    return f"filter({items}, {v} -> {test(v)})"


def some(items: str, test: Callable[[str], str], stem: str = "s") -> str:
    """Whether an item passes ``test``."""
    v = fresh(stem)
    return f"exists({items}, {v} -> {test(v)})"


def let(value: str, body: Callable[[str], str], stem: str = "v") -> str:
    """Evaluate ``value`` once and hand it to ``body``, so that it is not repeated inline."""
    return f"element_at({each(f'array({value})', body, stem)}, 1)"


def add(terms: list[str]) -> str:
    """Sum."""
    return "(" + " + ".join(terms) + ")"


def joined(*lists: str) -> str:
    """Lists one after the other; quicker row by row than ``concat``."""
    return f"flatten(array({', '.join(lists)}))"
