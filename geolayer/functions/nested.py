"""Values along a path of a nested JSON column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _null_variant() -> Column:
    return F.parse_json(F.lit("null"))


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _fan_out(value: Column) -> Column:
    """Items of a list, or the value itself; an empty list gives one null."""
    return let(_items(value), lambda items: F.when(items.isNull(), F.array(value)).when(
        F.size(items) == 0, F.array(_null_variant())).otherwise(items))


def _any_list(values: Column) -> Column:
    return F.exists(values, lambda i: _items(i).isNotNull())


def list_depth(text: Column) -> Column:
    """How deep lists lie in each other in a JSON text, read in one pass.

    What is quoted is taken out, then all but the brackets; a running sum over them has its peak at
    the depth. Every pattern is a plain run of characters, so long texts do no harm.
    """
    plain = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), '"[^"]*"', "")
    marks = F.split(F.regexp_replace(plain, r"[^\[\]]+", ""), "")
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("most"))

    def count(state: Column, mark: Column) -> Column:
        at = state["at"] + F.when(mark == "[", 1).when(mark == "]", -1).otherwise(0)
        return F.struct(at.alias("at"), F.greatest(state["most"], at).alias("most"))

    return F.aggregate(marks, start, count, lambda state: state["most"])


def _spread(values: Column, depth: Column) -> Column:
    """Lists among the values replaced by their items until no list is left.

    ``depth`` is at least the number of lists that lie in each other, so as many rounds reach any of
    them; rounds after the last list do nothing.
    """
    def once(state: Column, _: Column) -> Column:
        spread = let(F.flatten(F.transform(state["v"], _fan_out)),
                     lambda v: F.struct(v.alias("v"), _any_list(v).alias("more")))
        return F.when(state["more"], spread).otherwise(state)

    start = F.struct(values.alias("v"), _any_list(values).alias("more"))
    return F.aggregate(F.array_repeat(F.lit(0), depth), start, once, lambda state: state["v"])


def _step(values: Column, key: str, depth: Column) -> Column:
    """Value of ``key`` for each item, lists spread out first; null where it is absent."""
    quoted = "$['" + key.replace("'", "\\'") + "']"
    # Bound once, since the walk over lists names them twice.
    return F.transform(let(values, lambda v: _spread(v, depth)), lambda i: F.coalesce(
        F.try_variant_get(i, quoted, "variant"), _null_variant()))


def _walk(start: Column, path: list[str], depth: Column) -> Column:
    items = F.array(start)
    for key in path:
        items = _step(items, key, depth)
    return F.transform(items, lambda v: F.try_variant_get(v, "$", "string"))


def traverse_json(text: Column, path: list[str]) -> Column:
    """Values found along ``path``, as text, one list per item of a top-level list.

    Lists take no path step, however deep they lie in lists. A missing key, an empty list, a
    scalar before the end of the path and a null give one null each. A list at the final key is kept whole, as JSON text. A top-level
    object gives one list. Text that is not JSON gives null.
    """
    def outer(value: Column, depth: Column) -> Column:
        items = F.try_variant_get(value, "$", "array<variant>")
        each = F.transform(items, lambda i: _walk(i, path, depth))
        return F.when(items.isNotNull(), each).otherwise(F.array(_walk(value, path, depth)))

    # Value and depth are bound once for a document, not worked out again for its items.
    both = F.struct(F.try_parse_json(text).alias("v"), list_depth(text).alias("depth"))
    return let(both, lambda b: F.when(b["v"].isNotNull(), outer(b["v"], b["depth"])))
