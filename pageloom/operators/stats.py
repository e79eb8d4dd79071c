"""Corpus statistics. Every report is one aggregate over narrow columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions import tokens as tk
from pageloom.functions import wikitext
from pageloom.functions.wikitext import split_count
from pageloom.operators.articles import article_filter, is_article, require_columns
from pageloom.sources.mediawiki import RAWEST_TEXT_PATHS, text_column

PERCENTILE_ACCURACY = 10_000


def _blank(text: Column) -> Column:
    return F.trim(text) == ""


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def stats_text(pages: DataFrame) -> Column:
    """The best text column a page table has, null as empty text."""
    found = text_column(pages)
    if found is None:
        raise ValueError(f"no text column found, got: {pages.columns}")
    return F.coalesce(found.cast("string"), F.lit(""))


def _markup_count(pages: DataFrame, array_name: str, pattern: str) -> Column:
    """Size of the extracted array, or the number of openings in the rawest text."""
    if array_name in pages.columns:
        return F.coalesce(F.size(array_name), F.lit(0))
    raw = text_column(pages, RAWEST_TEXT_PATHS)
    if raw is None:
        raise ValueError(f"neither {array_name} nor a text column found, got: {pages.columns}")
    return split_count(F.coalesce(raw.cast("string"), F.lit("")), pattern)


def page_facts(pages: DataFrame) -> DataFrame:
    """One narrow row per page: all that the reports below need, without the text.

    Map-only. Written once, it saves every report a further scan of the text.
    """
    text = stats_text(pages)
    keep = [name for name in ("id", "title", "ns", "redirect") if name in pages.columns]
    return pages.select(
        *keep,
        is_article(pages).alias("is_article"),
        F.length(text).alias("text_len"),
        _blank(text).alias("is_blank"),
        _markup_count(pages, "links", wikitext.LINK_MARKUP).alias("link_count"),
        _markup_count(pages, "categories", wikitext.CATEGORY_MARKUP).alias("category_count"),
        _markup_count(pages, "templates", wikitext.TEMPLATE_MARKUP).alias("template_count"),
    )


def page_counts(pages: DataFrame) -> DataFrame:
    redirects = F.col("redirect").isNotNull() if "redirect" in pages.columns else F.lit(False)
    return pages.agg(F.count("*").alias("total_pages"), F.count_if(redirects).alias("redirect_pages"))


def title_stats(pages: DataFrame) -> DataFrame:
    """Distinct and missing titles. Counting per title first keeps a hot title small."""
    per_title = pages.groupBy("title").agg(F.count("*").alias("pages"))
    missing = F.col("title").isNull() | _blank(F.col("title"))
    return per_title.agg(
        F.count("title").alias("distinct_titles"),
        F.coalesce(F.sum(F.when(missing, F.col("pages"))), F.lit(0)).alias("missing_titles"),
    )


def duplicate_titles(pages: DataFrame) -> DataFrame:
    per_title = pages.groupBy("title").agg(F.count("*").alias("pages"))
    return per_title.agg(F.count_if(F.col("pages") > 1).alias("duplicate_title_groups"))


def namespace_distribution(pages: DataFrame) -> DataFrame:
    return pages.groupBy("ns").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "ns")


def top_namespaces(pages: DataFrame, k: int = 25) -> DataFrame:
    return namespace_distribution(pages).limit(k)


def _length_measures(value: str, accuracy: int) -> list[Column]:
    """Min, percentiles, max, mean and deviation of a length column, 0 over no rows."""

    def whole(measure: Column) -> Column:
        return F.coalesce(measure.cast("bigint"), F.lit(0).cast("bigint"))

    def real(measure: Column) -> Column:
        return F.coalesce(measure.cast("double"), F.lit(0.0))

    shares = F.percentile_approx(value, [0.5, 0.9, 0.99], accuracy)  # one sketch serves all three
    return [
        whole(F.min(value)).alias("min"),
        *(whole(shares[place]).alias(name) for place, name in enumerate(("p50", "p90", "p99"))),
        whole(F.max(value)).alias("max"),
        real(F.avg(value)).alias("avg"),
        real(F.stddev(value)).alias("stddev"),
    ]


def length_summary(
    df: DataFrame, label: str, len_col: str = "text_len", accuracy: int = PERCENTILE_ACCURACY
) -> DataFrame:
    """Summary of any length column."""
    return df.agg(*_length_measures(len_col, accuracy)).select(F.lit(label).alias("scope"), "*")


def text_length_global(facts: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    summary = facts.agg(F.count_if(F.col("is_blank")).alias("empty_text"), *_length_measures("text_len", accuracy))
    return summary.select(F.lit("global").alias("scope"), "*")


def text_length_articles(facts: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    summary = facts.where("is_article").agg(
        F.count("*").alias("articles_count"),
        F.count_if(F.col("is_blank")).alias("empty_text"),
        *_length_measures("text_len", accuracy),
    )
    return summary.select(F.lit("articles").alias("scope"), "*")


def link_counts(facts: DataFrame) -> DataFrame:
    """Articles with their markup counts and links per thousand characters."""
    density = F.col("link_count") / (F.col("text_len") / 1000.0)
    return facts.where("is_article").select(
        *(name for name in ("id", "title") if name in facts.columns),
        "text_len",
        "link_count",
        "category_count",
        "template_count",
        F.when(F.col("text_len") > 0, density).otherwise(0.0).alias("links_per_kchar"),
    )


def link_density_summary(facts: DataFrame, accuracy: int = PERCENTILE_ACCURACY) -> DataFrame:
    links = F.percentile_approx("link_count", [0.5, 0.9], accuracy)
    return link_counts(facts).agg(
        F.min("link_count").alias("min_links"),
        links[0].alias("p50_links"),
        links[1].alias("p90_links"),
        F.max("link_count").alias("max_links"),
        F.avg("links_per_kchar").alias("avg_links_per_kchar"),
        F.percentile_approx("links_per_kchar", 0.9, accuracy).alias("p90_links_per_kchar"),
        F.avg("category_count").alias("avg_categories"),
        F.avg("template_count").alias("avg_templates"),
    )


def top_most_linked(facts: DataFrame, k: int = 200) -> DataFrame:
    require_columns(facts, ("id", "title"))
    return (
        link_counts(facts)
        .orderBy(F.desc("link_count"), "id", "title")
        .limit(k)
        .select("title", "text_len", "link_count", "links_per_kchar", "category_count", "template_count")
    )


def token_counts(texts: DataFrame, text: Column, stop_words: list[str], separator: str = tk.WORDS) -> DataFrame:
    """Occurrences of every token that is no stop word.

    Splitting, filtering and the partial count run in one stage, so the shuffle
    carries one row per token and task.
    """
    return (
        texts.select(F.explode(F.split(F.lower(text), separator)).alias("token"))
        .where((F.length("token") >= tk.MIN_TOKEN_LENGTH) & ~F.col("token").isin(stop_words))
        .groupBy("token")
        .agg(F.count("*").alias("count"))
    )


def top_tokens(pages: DataFrame, top_k: int = 25) -> DataFrame:
    """The ``top_k`` most frequent tokens of the articles."""
    counts = token_counts(article_filter(pages), stats_text(pages), tk.english_stop_words())
    return counts.orderBy(F.desc("count"), "token").limit(top_k)


def overview(facts: DataFrame) -> DataFrame:
    """All headline counts from one pass: per title first, then over the titles."""
    redirects = F.col("redirect").isNotNull() if "redirect" in facts.columns else F.lit(False)
    title = F.col("title") if "title" in facts.columns else F.lit(None).cast("string")
    per_title = facts.groupBy(title.alias("title")).agg(
        F.count("*").alias("pages"),
        F.count_if(redirects).alias("redirects"),
        F.count_if(F.col("is_article")).alias("articles"),
        F.count_if(F.col("is_blank")).alias("blank"),
        F.count_if(F.col("is_blank") & F.col("is_article")).alias("blank_articles"),
    )
    missing = F.col("title").isNull() | _blank(F.col("title"))

    def total(measure: Column | str) -> Column:
        return F.coalesce(F.sum(measure), F.lit(0).cast("bigint"))

    has_title = F.lit("title" in facts.columns)
    return per_title.agg(
        total("pages").alias("total_pages"),
        total("redirects").alias("redirect_pages"),
        F.count("title").alias("distinct_titles"),
        total(F.when(missing & has_title, F.col("pages"))).alias("missing_titles"),
        F.count_if((F.col("pages") > 1) & has_title).alias("duplicate_title_groups"),
        total("articles").alias("articles_count"),
        total("blank").alias("empty_text_global"),
        total("blank_articles").alias("empty_text_articles"),
    )


def overview_ratios(overview_row: DataFrame) -> DataFrame:
    """Shares of the overview counts, 0 where there is nothing to divide by."""
    pages, articles = F.col("total_pages"), F.col("articles_count")
    return overview_row.select(
        _ratio(F.col("redirect_pages"), pages).alias("redirect_ratio"),
        _ratio(F.col("empty_text_global"), pages).alias("empty_text_global_ratio"),
        _ratio(articles, pages).alias("article_ratio"),
        _ratio(F.col("empty_text_articles"), articles).alias("empty_text_articles_ratio"),
    )
