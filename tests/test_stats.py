"""Reports on edge inputs."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from pageloom.operators import articles, stats

PAGES = "id long, title string, ns int, redirect string, text string, links array<string>, categories array<string>, templates array<string>"


def frame(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def test_empty_frame_gives_zeros(spark):
    facts = stats.page_facts(frame(spark, []))
    for report in (stats.text_length_global, stats.text_length_articles):
        row = report(facts).drop("scope").first()
        assert all(value == 0 for value in row)
    assert all(value == 0 for value in stats.overview(facts).first())
    assert all(value == 0 for value in stats.overview_ratios(stats.overview(facts)).first())
    assert tuple(stats.title_stats(frame(spark, [])).first()) == (0, 0)


def test_one_row_has_no_deviation(spark):
    row = stats.text_length_global(stats.page_facts(frame(spark, [(1, "a", 0, None, "abc", [], [], [])]))).first()
    assert (row["min"], row.p50, row["max"], row.avg, row.stddev) == (3, 3, 3, 3.0, 0.0)


def test_overview_counts(spark):
    pages = frame(
        spark,
        [
            (1, "a", 0, None, "x", ["l"], [], []),
            (2, "a", 0, None, " ", [], [], []),
            (3, None, 0, "a", None, [], [], []),
            (4, None, 1, None, "y", [], [], []),
            (5, "  ", 0, None, "", None, None, None),
        ],
    )
    row = stats.overview(stats.page_facts(pages)).first()
    assert row.asDict() == {
        "total_pages": 5,
        "redirect_pages": 1,
        "distinct_titles": 2,
        "missing_titles": 3,
        "duplicate_title_groups": 2,
        "articles_count": 3,
        "empty_text_global": 3,
        "empty_text_articles": 2,
    }
    assert tuple(stats.title_stats(pages).first()) == (2, 3)
    assert stats.duplicate_titles(pages).first()[0] == 2
    counts = {row.id: row for row in stats.link_counts(stats.page_facts(pages)).collect()}
    assert counts[5].link_count == 0 and counts[5].links_per_kchar == 0.0
    assert counts[1].links_per_kchar == 1000.0


def test_columns_may_be_absent(spark):
    bare = spark.createDataFrame([("[[a]] [[Category:b]] {{c}}",)], "text_raw string")
    facts = stats.page_facts(bare)
    row = facts.first()
    assert (row.link_count, row.category_count, row.template_count, row.is_article) == (2, 1, 1, True)
    assert stats.page_counts(bare).first().redirect_pages == 0
    assert stats.overview(facts).first().missing_titles == 0
    with pytest.raises(ValueError):
        stats.page_facts(spark.range(1))
    with pytest.raises(ValueError):
        articles.nlp_docs(bare)


def test_ties_are_broken_by_key(spark):
    rows = [(n, f"t{n}", n, None, "x y", ["l"], [], []) for n in range(9, -1, -1)]
    pages = frame(spark, rows).repartition(4)
    assert [row.ns for row in stats.top_namespaces(pages, 3).collect()] == [0, 1, 2]
    articles_only = pages.withColumn("ns", F.lit(0))
    top = stats.top_most_linked(stats.page_facts(articles_only), 3).collect()
    assert [row.title for row in top] == ["t0", "t1", "t2"]


def test_top_tokens(spark):
    text = "The cat, the CAT and a dog-dog; it's 12 123 foo_bar"
    pages = frame(spark, [(1, "a", 0, None, text, [], [], []), (2, "b", 1, None, "cat", [], [], [])])
    found = [tuple(row) for row in stats.top_tokens(pages).collect()]
    assert found == [("cat", 2), ("dog", 2), ("123", 1), ("foo_bar", 1)]


def test_doc_limits(spark):
    rows = [(n, "t", 0, None, "x" * n, [], [], []) for n in (299, 300, 301, 500, 501)]
    pages = frame(spark, rows)
    assert [row.id for row in articles.nlp_docs(pages).collect()] == [501]
    assert [row.id for row in articles.nlp_docs(pages, min_chars_src=100).collect()] == [301, 500, 501]


def test_percentiles_match_a_sorted_list(spark):
    values = spark.range(1000).select((F.col("id") * 37 % 1000).alias("text_len"))
    row = stats.length_summary(values, "all").first()
    assert (row.p50, row.p90, row.p99, row["min"], row["max"]) == (499, 899, 989, 0, 999)
    assert math.isclose(row.stddev, 288.8194361, rel_tol=1e-6)


def test_top_tokens_honours_its_size(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}x" for i in range(100)]
    pages = spark.createDataFrame([(1, "t", 0, None, " ".join(words))], "id int, title string, ns int, redirect string, text string")
    assert stats.top_tokens(pages, 100).count() == 100 and stats.top_tokens(pages).count() == 25
