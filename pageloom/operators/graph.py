"""Page and category graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.titles import category_title, non_empty, norm_title, stable_node_id
from pageloom.functions.wikitext import link_targets
from pageloom.operators.articles import article_filter, require_columns
from pageloom.operators.redirects import follow, redirect_ends, redirect_steps
from pageloom.operators.skew import ROWS_PER_SPLIT, join_split
from pageloom.storage import durable


def _linkable(pages: DataFrame) -> DataFrame:
    """Articles with an id and a title: the pages that become vertices, so no edge starts elsewhere."""
    require_columns(pages, ("id", "title"))
    return article_filter(pages).where(F.col("id").isNotNull() & non_empty(F.col("title")).isNotNull())


def page_vertices(pages: DataFrame) -> DataFrame:
    """One vertex per page id under its smallest title."""
    return (
        _linkable(pages)
        .groupBy(F.col("id").cast("bigint").alias("id"))
        .agg(F.min(non_empty(F.col("title"))).alias("title"))
        .select("id", "title", F.lit("page").alias("kind"), norm_title(F.col("title")).alias("title_norm"))
    )


def link_mentions(pages: DataFrame, links: Column | str = "links") -> DataFrame:
    """``src_id, title_norm``, one row per link, map-only.

    Pass ``wikitext.link_targets`` of the raw text as ``links`` to get a row for
    every mention instead of every spelling.
    """
    if isinstance(links, str):
        require_columns(pages, (links,))
    source = links if isinstance(links, Column) else F.col(links)
    return (
        _linkable(pages)
        .select(F.col("id").cast("bigint").alias("src_id"), F.explode(source).alias("link"))
        .select("src_id", norm_title(F.col("link")).alias("title_norm"))
        .where(F.col("title_norm") != "")
    )


def link_title_join(
    mentions: DataFrame, vertices: DataFrame, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Resolve linked titles to page ids: ``src_id, dst_id``, one row per mention and page of that title.

    Pages that share a normalized title are all linked. A title whose mentions
    times pages are very many is split over several tasks. Both inputs are read
    twice; pass written tables.
    """
    targets = vertices.select(F.col("id").alias("dst_id"), "title_norm")
    return join_split(mentions, targets, "title_norm", F.col("src_id"), rows_per_split).select("src_id", "dst_id")


def link_edges(
    pages: DataFrame, links: Column | str = "links", rows_per_split: int = ROWS_PER_SPLIT, redirects: bool = False
) -> DataFrame:
    """Page-to-page edges weighted by mentions, without self-loops.

    Counting follows the join, where a row is a pair of ids: that shuffle is
    narrower than one of titles, and links to missing pages are gone by then. With
    ``redirects`` a link to a redirect counts for the page that it ends at.
    """
    mentions = link_mentions(pages, links)
    if redirects:
        mentions = follow(mentions, redirect_ends(redirect_steps(pages)))
    mentions = durable(mentions, "link_mentions")
    return (
        link_title_join(mentions, durable(page_vertices(pages), "page_vertices"), rows_per_split)
        .where(F.col("src_id") != F.col("dst_id"))
        .groupBy("src_id", "dst_id")
        .agg(F.count("*").alias("weight"))
        .withColumn("edge_type", F.lit("link"))
    )


def _memberships(pages: DataFrame) -> DataFrame:
    """``src_id, dst_id, title`` of every page in a category."""
    named = (
        _linkable(pages)
        .select(F.col("id").cast("bigint").alias("src_id"), F.explode("categories").alias("category"))
        .select("src_id", category_title(non_empty(F.col("category"))).alias("title"))
        .where(F.col("title").isNotNull())
    )
    return named.select("src_id", stable_node_id("category", F.col("title")).alias("dst_id"), "title")


def category_vertices(pages: DataFrame) -> DataFrame:
    """One vertex per category: distinct titles by hash, so a hot category is one row of each task."""
    titles = _memberships(pages).select("title").distinct()
    return titles.select(
        stable_node_id("category", F.col("title")).alias("id"),
        "title",
        F.lit("category").alias("kind"),
        norm_title(F.col("title")).alias("title_norm"),
    )


def named_category_edges(pages: DataFrame) -> DataFrame:
    """Category edges that carry the title of their end, so that it need not be joined back."""
    return (
        _memberships(pages)
        .distinct()
        .select("src_id", "dst_id", "title", F.lit(1).cast("bigint").alias("weight"), F.lit("has_category").alias("edge_type"))
    )


def category_edges(pages: DataFrame) -> DataFrame:
    return named_category_edges(pages).drop("title")


def graph_vertices(pages: DataFrame) -> DataFrame:
    """``id, title, kind`` of all pages and, if the pages have categories, all categories."""
    vertices = page_vertices(pages)
    if "categories" in pages.columns:
        vertices = vertices.unionByName(category_vertices(pages))
    return vertices.select("id", "title", "kind")


def graph_edges(
    pages: DataFrame, every_mention: bool = False, rows_per_split: int = ROWS_PER_SPLIT, redirects: bool = False
) -> DataFrame:
    """``src_id, dst_id, weight, edge_type`` of all edges.

    ``every_mention`` counts mentions, not spellings; ``redirects`` follows redirects.
    """
    links = link_targets(F.col("text_raw")) if every_mention else "links"
    edges = link_edges(pages, links, rows_per_split, redirects)
    if "categories" in pages.columns:
        edges = edges.unionByName(category_edges(pages))
    return edges


def graph_counts(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Numbers of vertices by kind and edges by type, each table read once."""
    per_kind = vertices.groupBy(F.lit("vertices").alias("part"), "kind").agg(F.count("*").alias("count"))
    per_type = edges.groupBy(F.lit("edges").alias("part"), F.col("edge_type").alias("kind")).agg(
        F.count("*").alias("count")
    )
    return per_kind.unionByName(per_type)
