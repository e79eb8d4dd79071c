"""Graph construction and ranks against plain Python."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pageloom.operators import graph, pagerank, skew

PAGES = "id long, title string, ns int, redirect string, links array<string>, categories array<string>"


def hub_pages(spark, n=60):
    """A third of all links point to one title, and one page holds a third of all links."""
    rows = [(0, "Hub", 0, None, [f"p{i}" for i in range(1, n)], ["big"])]
    for i in range(1, n):
        rows.append((i, f"P{i}", 0, None, ["hub", "HUB_", f"p{(i * 7) % n}", "missing"], ["big", f"c{i % 3}"]))
    rows += [
        (n, "hub", 0, None, ["P1"], []),  # shares a normalized title
        (n + 1, "R", 0, "Hub", ["P1"], ["big"]),  # redirect
        (n + 2, "Talk", 1, None, ["P1"], ["big"]),  # other namespace
        (n + 3, " ", 0, None, ["P1"], ["big"]),  # no title
        (None, "NoId", 0, None, ["P1"], ["big"]),  # no id
        (1, "A1", 0, None, ["P2", "P2 "], ["big"]),  # same id, smaller title
    ]
    return spark.createDataFrame(rows, PAGES).repartition(4)


def norm(title):
    return " ".join(title.strip().replace("_", " ").split(" ")).lower()


def expected_edges(rows):
    pages = [r for r in rows if r.ns == 0 and r.redirect is None and r.id is not None and r.title.strip()]
    title = {}
    for r in pages:
        title[r.id] = min(title.get(r.id, r.title.strip()), r.title.strip())
    by_norm = defaultdict(list)
    for id, name in title.items():
        by_norm[norm(name)].append(id)
    weights = Counter()
    for r in pages:
        for link in r.links:
            for dst in by_norm.get(norm(link), ()):
                if dst != r.id:
                    weights[(r.id, dst)] += 1
    member = {(r.id, f"Category:{c}") for r in pages for c in r.categories}
    return title, weights, member


@pytest.mark.parametrize("rows_per_split", [1_000_000, 5])
def test_edges_with_a_hot_title(spark, rows_per_split):
    pages = hub_pages(spark)
    title, weights, member = expected_edges(pages.collect())
    assert {r.id: r.title for r in graph.page_vertices(pages).collect()} == title
    found = graph.link_edges(pages, rows_per_split=rows_per_split).collect()
    assert len(found) == len(weights)
    assert {(r.src_id, r.dst_id): r.weight for r in found} == weights
    names = {r.id: r.title for r in graph.category_vertices(pages).collect()}
    edges = graph.category_edges(pages).collect()
    assert len(edges) == len(member) and {(r.src_id, names[r.dst_id]) for r in edges} == member


def test_edges_end_at_vertices(spark):
    pages = hub_pages(spark)
    vertices, edges = graph.graph_vertices(pages), graph.graph_edges(pages)
    for end in ("src_id", "dst_id"):
        assert edges.join(vertices, F.col(end) == F.col("id"), "left_anti").isEmpty()
    counts = {(r.part, r.kind): r["count"] for r in graph.graph_counts(vertices, edges).collect()}
    assert counts[("vertices", "page")] == 61 and counts[("vertices", "category")] == 4


def test_pages_without_categories(spark):
    pages = hub_pages(spark).drop("categories")
    assert graph.graph_vertices(pages).where("kind <> 'page'").isEmpty()
    assert graph.graph_edges(pages).where("edge_type <> 'link'").isEmpty()


def test_a_hot_key_is_listed_and_split(spark):
    mentions = graph.link_mentions(hub_pages(spark))
    heavy = skew.heavy_keys(mentions, "title_norm", rows_per_split=20)
    splits = {r.heavy_key: r.splits for r in heavy.collect()}
    assert splits["hub"] == 3 and "p1" not in splits
    salted = skew.salt_large_side(mentions, "title_norm", F.col("src_id"), heavy)
    assert salted.where("title_norm = 'hub'").select("salt").distinct().count() == 3
    assert salted.count() == mentions.count()
    assert skew.heavy_keys(mentions, "title_norm", rows_per_split=1000) is None


def test_only_small_tables_are_marked_for_broadcast(spark):
    def plan(df):
        joined = spark.range(10).join(df, "id")
        return joined._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(skew.broadcast_if_small(spark.range(5), max_rows=5))
    assert "strategy=broadcast" not in plan(skew.broadcast_if_small(spark.range(6), max_rows=5))


def brute_ranks(nodes, edges, rounds=10, reset=0.15):
    out = Counter(src for src, _ in edges)
    rank = dict.fromkeys(nodes, 1.0)
    for _ in range(rounds):
        received = defaultdict(float)
        for src, dst in edges:
            received[dst] += rank[src] / out[src]
        rank = {node: reset + (1 - reset) * received[node] for node in nodes}
    total = sum(rank.values())
    return {node: value * len(nodes) / total for node, value in rank.items()}


@pytest.mark.parametrize("rows_per_split,checkpoint_every", [(1_000_000, 5), (5, 3)])
def test_pagerank(spark, rows_per_split, checkpoint_every):
    pages = hub_pages(spark)
    vertices, edges = graph.graph_vertices(pages), graph.graph_edges(pages)
    ranked = pagerank.pagerank(
        vertices, edges, checkpoint_every=checkpoint_every, rows_per_split=rows_per_split
    ).collect()
    expected = brute_ranks(
        [r.id for r in vertices.collect()], [(r.src_id, r.dst_id) for r in edges.collect()]
    )
    assert len(ranked) == len(expected)
    assert all(abs(r.pagerank - expected[r.id]) < 1e-9 for r in ranked)
    assert abs(sum(r.pagerank for r in ranked) - len(expected)) < 1e-6


def test_pagerank_with_a_sink_and_with_nothing(spark):
    vertices = spark.createDataFrame([(i, f"t{i}", "page") for i in range(5)], "id long, title string, kind string")
    pairs = [(0, 1), (1, 2), (2, 0), (0, 3), (3, 4)]
    edges = spark.createDataFrame(pairs, "src_id long, dst_id long")
    ranked = pagerank.pagerank(vertices, edges)
    expected = brute_ranks(range(5), pairs)
    assert all(abs(r.pagerank - expected[r.id]) < 1e-12 for r in ranked.collect())
    top = pagerank.top_by_rank(ranked, "page", 2).collect()
    assert [r.id for r in top] == sorted(expected, key=lambda i: -expected[i])[:2]
    assert pagerank.pagerank(vertices.limit(0), edges.limit(0)).isEmpty()


def test_a_title_of_many_pages_with_many_links_is_split(spark):
    mentions = spark.createDataFrame([(i, "hub") for i in range(200)] + [(i, f"t{i}") for i in range(50)], "src_id long, title_norm string")
    vertices = spark.createDataFrame([(1000 + i, "hub") for i in range(30)] + [(2000 + i, f"t{i}") for i in range(50)], "id long, title_norm string")
    plain = graph.link_title_join(mentions, vertices)
    split = graph.link_title_join(mentions, vertices, rows_per_split=100)
    assert plain.count() == 200 * 30 + 50
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()


def test_links_must_be_there(spark):
    with pytest.raises(ValueError, match="links"):
        graph.link_mentions(hub_pages(spark).drop("links"))


def test_mentions_can_weigh_the_graph(spark):
    pages = spark.createDataFrame(
        [(1, "A", 0, None, "[[B]] [[B]] [[b]]", ["B", "b"]), (2, "B", 0, None, "", [])],
        "id long, title string, ns int, redirect string, text_raw string, links array<string>",
    )
    assert [r.weight for r in graph.graph_edges(pages).collect()] == [2]
    assert [r.weight for r in graph.graph_edges(pages, every_mention=True).collect()] == [3]


def test_hot_categories_are_hashed_not_sorted(spark):
    plan = graph.category_vertices(hub_pages(spark))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
