"""Nested markup of any depth as native expressions.

A text is taken apart once into delimiters and what lies between them. A running
state over these parts, not a pass for each level, tells what is inside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

TEMPLATE, TABLE, LINK = ("{{", "}}"), ("{|", "|}"), ("[[", "]]")
#: What a link must begin with to be dropped with all that it holds.
MEDIA = r"^\s*(?i:category|file|image):"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, start: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The states before the first and after each element: ``step(state, element)``, from ``start`` on.

    An array that grows by one element at a time costs the square of its length,
    so states are gathered over runs of about the root of the length.
    """
    run = F.greatest(F.ceil(F.sqrt(F.size(values))), F.lit(1)).cast("int")
    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), run)

    def over_run(states: Column, at: Column) -> Column:
        own = F.aggregate(F.slice(values, at, run), F.array(F.element_at(states, -1)), lambda seen, value: F.concat(seen, F.array(step(F.element_at(seen, -1), value))))
        return F.concat(states, F.slice(own, F.lit(2), run))

    return F.aggregate(starts, F.array(start), over_run)


def without_nested(text: Column, pair: tuple[str, str] = TEMPLATE, begins: str | None = None, replacement: str = "") -> Column:
    """The text without everything between an opening and its closing delimiter, however deeply nested, in one pass.

    Delimiters pair like brackets, from left to right. A closing one without an
    opening stays as text, and so does an opening one that nothing closes; what
    follows it is judged by itself. With ``begins`` only those pairs go whose
    content starts with that pattern, and all that they hold; others stay as they
    are. Null stays null.
    """
    opening, closing = pair
    alone = "".join(sorted({f"\\{mark[0]}" for mark in pair}))
    parts = F.regexp_extract_all(text, F.lit(rf"(?s)(\Q{opening}\E|\Q{closing}\E|[^{alone}]+|.)"), F.lit(1))
    cut = let(parts, lambda parts: let(_closings(parts, opening, closing), lambda signs: _cut(parts, signs, begins, replacement)))
    return F.when(F.contains(text, F.lit(opening)), cut).otherwise(text)


def _closings(parts: Column, opening: str, closing: str) -> Column:
    """1 for each opening part, -1 for each closing one that has an opening before it, else 0."""
    signs = F.transform(parts, lambda part: F.when(part == opening, 1).when(part == closing, -1).otherwise(0))
    deeper = lambda depth, sign: F.greatest(depth + sign, F.lit(0))
    known = lambda signs: let(
        running(signs, F.lit(0), deeper), lambda depth: F.transform(signs, lambda sign, at: F.when((sign == -1) & (F.get(depth, at) == 0), 0).otherwise(sign))
    )
    return let(signs, known)


def _cut(parts: Column, signs: Column, begins: str | None, replacement: str) -> Column:
    """The parts outside all pairs, read from the right, where each closing sign has its opening."""
    shallower = lambda depth, sign: F.greatest(depth - sign, F.lit(0))
    depth = F.reverse(running(F.reverse(signs), F.lit(0), shallower))  # before each part, and at the end
    if begins is None:
        return let(depth, lambda depth: _joined(parts, F.transform(parts, lambda _, at: (F.get(depth, at) > 0) | (F.get(depth, at + 1) > 0)), replacement))

    # From the left again: the depth that a dropped pair was opened at, 0 while none is open.
    def drops(depth: Column) -> Column:
        follows = F.transform(parts, lambda _, at: F.struct(F.get(depth, at).alias("was"), F.get(depth, at + 1).alias("is"), F.get(parts, at + 1).alias("next")))
        return F.transform(follows, lambda f: F.struct(f["was"], f["is"], ((f["is"] > f["was"]) & F.coalesce(f["next"], F.lit("")).rlike(begins)).alias("opens")))

    def step(open_: Column, item: Column) -> Column:
        return F.when((open_ == 0) & item["opens"], item["is"]).when((open_ > 0) & (item["is"] < open_), 0).otherwise(open_)

    opened = lambda items: let(running(items, F.lit(0), step), lambda open_: _joined(parts, F.transform(parts, lambda _, at: (F.get(open_, at) > 0) | (F.get(open_, at + 1) > 0)), replacement))
    return let(depth, lambda depth: let(drops(depth), opened))


def _joined(parts: Column, inside: Column, replacement: str) -> Column:
    """The parts that are not inside; ``replacement`` for each run of those that are."""
    shown = lambda inside: F.transform(
        parts, lambda part, at: F.when(~F.get(inside, at), part).when((at == 0) | ~F.get(inside, at - 1), F.lit(replacement)).otherwise(F.lit(""))
    )
    return F.array_join(let(inside, shown), "")
