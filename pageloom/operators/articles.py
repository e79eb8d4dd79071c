"""Choosing pages: articles, documents for text mining, previews."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}, got: {df.columns}")


def is_article(df: DataFrame) -> Column:
    """In the main namespace and not a redirect; a test whose column is absent passes."""
    condition = F.lit(True)
    if "ns" in df.columns:
        condition = F.col("ns").cast("int") == 0
    if "redirect" in df.columns:
        condition = condition & F.col("redirect").isNull()
    return condition


def article_filter(pages: DataFrame) -> DataFrame:
    return pages.where(is_article(pages))


def nlp_docs(pages: DataFrame, min_chars_src: int = 500, min_chars_clean: int = 300) -> DataFrame:
    """``id, title, text`` of articles longer than both limits."""
    require_columns(pages, ("id", "title", "ns", "redirect", "text"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return (
        article_filter(pages)
        .where(F.length(text) > max(min_chars_src, min_chars_clean))
        .select("id", "title", text.alias("text"))
    )


def text_head(docs: DataFrame, rows: int = 3, chars: int = 240) -> DataFrame:
    """The beginning of the first few documents by id."""
    return docs.orderBy("id", "title").limit(rows).select("title", F.substring("text", 1, chars).alias("text_head"))


def sample_page(pages: DataFrame) -> DataFrame:
    """One parsed page of the main namespace: the smallest id that has text."""
    return (
        pages.where(F.col("text_raw").isNotNull() & (F.col("ns") == 0))
        .orderBy("id", "revision_id")
        .limit(1)
        .select("*", F.length("text").alias("text_length"), F.substring("text_raw", 1, 500).alias("raw_head"))
    )
