"""Titles and node identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_empty(text: Column) -> Column:
    """Trimmed text, null when nothing is left."""
    return F.nullif(F.trim(text.cast("string")), F.lit(""))


def norm_title(title: Column) -> Column:
    """Key under which spellings of one title meet: blanks for underscores, one blank per run, lower case."""
    return F.lower(F.regexp_replace(F.trim(title.cast("string")), r"[\s_]+", " "))


def category_title(name: Column) -> Column:
    return F.concat(F.lit("Category:"), name)


def stable_node_id(prefix: str, title: Column) -> Column:
    """Negative 64-bit id for a node that is not a page, so it never meets a page id.

    The negative half holds the one value without a positive twin, so flipping
    positive hashes cannot overflow.
    """
    hashed = F.xxhash64(F.concat(F.lit(f"{prefix}:"), F.coalesce(title.cast("string"), F.lit(""))))
    return F.when(hashed > 0, -hashed).otherwise(hashed)
