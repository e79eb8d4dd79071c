"""Array and vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_empty(values: Column) -> Column:
    """A null array becomes an empty one."""
    return F.coalesce(values, F.array().cast("array<string>"))


def clean_array(values: Column) -> Column:
    """Trim every element, drop the empty ones, keep the first of each."""
    return F.array_distinct(F.filter(F.transform(values, lambda item: F.trim(item)), lambda item: item != ""))


def argmax(values: Column) -> Column:
    """Zero-based position of the largest element; the lowest position wins a tie."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def label_from_terms(terms: Column) -> Column:
    """The first three usable terms as a short name, ``(unlabeled)`` when there is none."""
    spaced = F.transform(terms, lambda term: F.trim(F.translate(term, "_", " ")))
    head = F.slice(F.filter(spaced, lambda term: term != ""), 1, 3)
    return F.coalesce(F.nullif(F.array_join(head, " / "), F.lit("")), F.lit("(unlabeled)"))
