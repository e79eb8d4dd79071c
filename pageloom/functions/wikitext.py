"""Markup extraction and cleaning as native regular-expression columns."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageloom.functions.arrays import clean_array, or_empty
from pageloom.functions.nesting import LINK, MEDIA, TEMPLATE, let, without_nested

# Capture patterns, group 1 is the result.
CATEGORY_PATTERN = r"\[\[(?i:Category):([^\]\|]+)"
TEMPLATE_PATTERN = r"\{\{\s*([^\|\}\n<]+)"
EXTERNAL_LINK_PATTERN = r"(https?://[^\]\|\n<>]+)"
LINK_PATTERN = r"\[\[([^\]\|#]+)"
LEADING_COLONS = r"^:+"
EXCLUDED_LINK_NAMESPACES = ("category:", "file:", "image:")

# Patterns counted when a page table has no extracted arrays.
LINK_MARKUP = r"\[\["
CATEGORY_MARKUP = r"\[\[Category:"
TEMPLATE_MARKUP = r"\{\{"

# Cleaning rules as (name, pattern, replacement).
CLEANING_RULES = [
    ("paired_refs", r"(?is)<ref[^>]*>.*?</ref>", " "),
    ("closed_refs", r"(?i)<ref[^>]*/>", " "),
    ("blocks", r"(?is)<(gallery|script|style|noinclude)[^>]*>.*?</$1>", " "),
    ("line_breaks", r"(?i)<br\s*/?>", "\n"),
    ("tags", r"<[^>]+>", " "),
    ("media_links", r"\[\[(?i:(Category|File|Image)):[^\]]*?\]\]", " "),
    ("pipe_lines", r"(?m)^\s*\|.*$", ""),
    ("inner_templates", r"\{\{[^\{\}]*\}\}", ""),
    ("template_rest", r"(?s)\{\{[^}]*?\}\}", ""),
    ("labelled_links", r"\[\[[^|\]]+\|([^\]]+)\]\]", "$1"),
    ("plain_links", r"\[\[([^\]]+)\]\]", "$1"),
    ("labelled_urls", r"\[https?://[^\s\]]+\s+([^\]]+)\]", "$1"),
    ("bracketed_urls", r"\[https?://[^\]]+\]", " "),
    ("bare_urls", r"https?://\S+", " "),
    ("table_open", r"(?m)^\s*\{\|.*$", ""),
    ("table_close", r"(?m)^\s*\|\}.*$", ""),
    ("table_rows", r"(?m)^\s*\|-.*$", ""),
    ("table_cells", r"(?m)^\s*\|\s*", ""),
    ("headers", r"(?m)^=+\s*(.*?)\s*=+$", "$1"),
    ("emphasis", r"'{2,5}", ""),
    ("bullets", r"(?m)^\s*[*#;:]+\s*", ""),
    ("blanks", r"[ \t]+", " "),
    ("line_ends", r"(?m)^[ \t]+|[ \t]+$", ""),
    ("newlines", r"[\n\r]\s*[\n\r]+", "\n"),
    ("outer", r"^[ \n\r\t]+|[ \n\r\t]+$", ""),
]

# Elements dropped with their content.
DROPPED_BLOCKS = ("gallery", "script", "style", "noinclude")

# Of which a text must hold one to be changed by a rule; looking for it costs a small part of the rule itself.
NEEDED = {
    "paired_refs": ("</",),
    "closed_refs": ("/>",),
    "blocks": ("</",),
    "line_breaks": ("<",),
    "tags": ("<",),
    "media_links": ("[[",),
    "pipe_lines": ("|",),
    "inner_templates": ("{{",),
    "template_rest": ("{{",),
    "labelled_links": ("[[",),
    "plain_links": ("[[",),
    "labelled_urls": ("[http",),
    "bracketed_urls": ("[http",),
    "bare_urls": ("http",),
    "table_open": ("{|",),
    "table_close": ("|}",),
    "table_rows": ("|-",),
    "table_cells": ("|",),
    "headers": ("=",),
    "emphasis": ("''",),
    "bullets": ("*", "#", ";", ":"),
    "newlines": ("\r", "\n\n", "\n ", "\n\t", "\n\x0b", "\n\f"),
}
# What else than \n ends a line for the patterns.
OTHER_LINE_ENDS = ("\r", "\u0085", "\u2028", "\u2029")


def nested_steps() -> list[tuple[str, str] | str]:
    """The default steps with ``media`` and ``templates`` in the places of the rules that nesting replaces."""
    rules = {(pattern, new): name for name, pattern, new in CLEANING_RULES}
    named = {"media_links": "media", "template_rest": "templates"}
    return [named.get(rules.get(step, ""), step) for step in cleaning_steps(template_depth=0)]


def cleaning_steps(compat: bool = False, template_depth: int = 2) -> list[tuple[str, str]]:
    """The (pattern, replacement) pairs in the order they are applied.

    The default order removes self-closed references before paired ones, so a
    paired match never starts at a self-closed tag; drops each block element by a
    pattern of its own; and removes templates before lines led by a pipe, so such
    a line cannot take the closing braces of a template with it. ``compat=True``
    applies the rules strictly as listed.
    """
    rules = {name: (pattern, replacement) for name, pattern, replacement in CLEANING_RULES}
    names = list(rules)
    if not compat:
        names.remove("closed_refs")
        names.insert(names.index("paired_refs"), "closed_refs")
        names.remove("pipe_lines")
        names.insert(names.index("template_rest") + 1, "pipe_lines")

    steps: list[tuple[str, str]] = []
    for name in names:
        if name == "inner_templates":
            steps += [rules[name]] * template_depth
        elif name == "blocks" and not compat:
            steps += [(rf"(?is)<{tag}[^>]*>.*?</{tag}>", " ") for tag in DROPPED_BLOCKS]
        else:
            steps.append(rules[name])
    return steps


def _has_one(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(or_, (F.contains(text, F.lit(part)) for part in parts))


def _single_blanks(text: Column) -> Column:
    """``blanks`` by plain replacement, which leaves the single blanks between words alone; longer runs go to a pattern."""
    spaced = F.replace(text, F.lit("\t"), F.lit(" "))
    for _ in range(3):
        spaced = F.replace(spaced, F.lit("  "), F.lit(" "))
    return let(spaced, lambda spaced: F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " +", " ")).otherwise(spaced))


def _bare_lines(pattern: str) -> Callable[[Column], Column]:
    """``line_ends`` after ``blanks``, where every blank is a single one."""

    def bare(text: Column) -> Column:
        plain = F.trim(F.replace(F.replace(text, F.lit(" \n"), F.lit("\n")), F.lit("\n "), F.lit("\n")))
        return F.when(_has_one(text, OTHER_LINE_ENDS), F.regexp_replace(text, pattern, "")).otherwise(plain)

    return bare


def _bare_text(pattern: str) -> Callable[[Column], Column]:
    """``outer`` by trimming; before a last line end of another kind the pattern also takes blanks away."""

    def bare(text: Column) -> Column:
        other = reduce(or_, (F.endswith(text, F.lit(end)) for end in OTHER_LINE_ENDS[1:]))
        return F.when(other, F.regexp_replace(text, pattern, "")).otherwise(F.trim(text, F.lit(" \n\r\t")))

    return bare


def _apply(text: Column, steps: list[tuple[str, str]]) -> Column:
    """The steps one after the other, each only on texts that it can change.

    The result is that of the patterns alone. Each step's text is computed once,
    however often the step names it.
    """
    names = {pattern: name for name, pattern, _ in CLEANING_RULES}
    names |= {pattern: "blocks" for pattern, _ in cleaning_steps() if pattern not in names}
    for at, (pattern, replacement) in enumerate(steps):
        name = names[pattern]
        if name == "blanks":
            text = _single_blanks(text)
        elif name == "line_ends" and at and names[steps[at - 1][0]] == "blanks":
            text = let(text, _bare_lines(pattern))
        elif name == "outer":
            text = let(text, _bare_text(pattern))
        elif name in NEEDED:
            text = let(text, _if_needed(NEEDED[name], pattern, replacement))
        else:
            text = F.regexp_replace(text, pattern, replacement)
    return text


def _if_needed(parts: tuple[str, ...], pattern: str, replacement: str) -> Callable[[Column], Column]:
    return lambda text: F.when(_has_one(text, parts), F.regexp_replace(text, pattern, replacement)).otherwise(text)


def clean_nested(text: Column) -> Column:
    """Markup flattened to plain text, templates and media links gone with all that is nested in them, at any depth.

    Null becomes empty text. Delimiters without a partner stay, as in ``without_nested``.
    """
    cleaned, steps = F.coalesce(text.cast("string"), F.lit("")), nested_steps()
    media, templates = steps.index("media"), steps.index("templates")
    cleaned = let(_apply(cleaned, steps[:media]), lambda text: without_nested(text, LINK, MEDIA, " "))
    cleaned = let(_apply(cleaned, steps[media + 1 : templates]), lambda text: without_nested(text, TEMPLATE))
    return _apply(cleaned, steps[templates + 1 :])


def clean_wikitext(text: Column, compat: bool = False, template_depth: int = 2) -> Column:
    """Markup flattened to plain text; null becomes empty text."""
    return _apply(F.coalesce(text.cast("string"), F.lit("")), cleaning_steps(compat, template_depth))


def _captures(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def categories(text: Column) -> Column:
    return or_empty(clean_array(_captures(text, CATEGORY_PATTERN)))


def templates(text: Column) -> Column:
    return or_empty(clean_array(_captures(text, TEMPLATE_PATTERN)))


def external_links(text: Column) -> Column:
    return or_empty(clean_array(_captures(text, EXTERNAL_LINK_PATTERN)))


def link_targets(text: Column) -> Column:
    """Every internal link target in reading order, one element per mention."""
    targets = F.transform(
        _captures(text, LINK_PATTERN), lambda target: F.trim(F.regexp_replace(target, LEADING_COLONS, ""))
    )
    special = "^(" + "|".join(EXCLUDED_LINK_NAMESPACES) + ")"
    return or_empty(F.filter(targets, lambda target: (target != "") & ~F.lower(target).rlike(special)))


def links(text: Column) -> Column:
    """Distinct spellings of the internal link targets."""
    return F.array_distinct(link_targets(text))


def split_count(text: Column, pattern: str) -> Column:
    """Occurrences of a pattern; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))
