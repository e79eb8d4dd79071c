"""Redirects, shared titles and node ids against plain Python, hot keys included."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_graph import brute_ranks, expected_edges, hub_pages

from pageloom.operators import factored, graph, node_ids, pagerank, redirects
from pageloom.storage import durable

STEPS = "title_norm string, target string"


def ends_of(spark, steps):
    frame = spark.createDataFrame(list(steps.items()), STEPS).repartition(3)
    return {r.title_norm: (r.end, r.hops) for r in redirects.redirect_ends(frame).collect()}


def plain_ends(steps):
    out = {}
    for title in steps:
        at, hops = title, 0
        while at in steps and hops <= len(steps):
            at, hops = steps[at], hops + 1
        out[title] = (None, None) if at in steps else (at, hops)
    return out


def test_chains_circles_and_dead_ends(spark):
    steps = {f"c{i}": f"c{i + 1}" for i in range(40)} | {"a": "b", "b": "c", "c": "a", "into": "a", "self": "self", "x": "nowhere", "y": "x"}
    assert ends_of(spark, steps) == plain_ends(steps)
    only_circle = {f"r{i}": f"r{(i + 1) % 7}" for i in range(7)}
    assert ends_of(spark, only_circle) == dict.fromkeys(only_circle, (None, None))
    assert ends_of(spark, {}) == {}
    assert ends_of(spark, {"one": "two"}) == {"one": ("two", 1)}


PAGES = "id long, title string, ns int, redirect string, links array<string>"


def test_links_follow_redirects(spark):
    rows = [
        (1, "Home", 0, None, ["Old name", "old_name", "Circle", "Gone", "Home"]),
        (2, "New", 0, None, ["R2"]),
        (3, "Old Name", 0, "R2#part", None),
        (4, "R2", 0, "new", None),
        (5, "R2", 0, "zzz", None),  # of two targets the smaller counts
        (6, "Circle", 0, "circle", None),
        (7, "Gone", 0, "Nowhere", None),
        (8, "New", 0, "Home", None),  # an article has this title, so it is no redirect
        (9, "Talk", 1, "Home", None),
        (10, None, 0, "Home", None),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    steps = {r.title_norm: r.target for r in redirects.redirect_steps(pages).collect()}
    assert steps == {"old name": "r2", "r2": "new", "circle": "circle", "gone": "nowhere"}
    found = {(r.src_id, r.dst_id): r.weight for r in graph.link_edges(pages, redirects=True).collect()}
    assert found == {(1, 2): 2}
    assert graph.link_edges(pages).isEmpty()
    assert not graph.link_edges(pages.drop("redirect").limit(0)).count()


@pytest.mark.parametrize("rows_per_split", [1_000_000, 5])
def test_grouped_links_are_the_expanded_ones(spark, rows_per_split):
    pages = durable(hub_pages(spark), "hub_pages")
    _, weights, member = expected_edges(pages.collect())
    nodes = durable(factored.grouped_vertices(pages, rows_per_split=rows_per_split), "grouped_vertices")
    links = durable(factored.grouped_links(pages, rows_per_split=rows_per_split), "grouped_links")
    assert {(r.id, r.title, r.kind) for r in nodes.collect()} == {(r.id, r.title, r.kind) for r in graph.graph_vertices(pages).collect()}
    out = factored.expanded(links, nodes, rows_per_split).collect()
    assert {(r.src_id, r.dst_id): r.weight for r in out if r.edge_type == "link"} == weights
    assert sum(r.edge_type == "has_category" for r in out) == len(member)
    ranks = factored.grouped_pagerank(nodes, links, checkpoint_every=3, rows_per_split=rows_per_split).collect()
    expected = brute_ranks([r.id for r in ranks], [(r.src_id, r.dst_id) for r in out])
    assert all(abs(r.pagerank - expected[r.id]) < 1e-9 for r in ranks)


def test_written_out_edges_are_dealt_over_tasks(spark, monkeypatch):
    """Few links and pages make many edges, so the tasks don't follow from the little that is shuffled."""
    monkeypatch.setattr(factored, "PAGES_PER_BLOCK", 64, raising=False)
    n = 300
    links = [(i, 1, 1 + i % 3, "link") for i in range(n)] + [(0, 1, 1, "link"), (None, 1, 1, "link"), (5, None, 1, "link"), (7, 9, 1, "link"), (8, 2, 4, "x")]
    nodes = [(i, 1) for i in range(n)] + [(3, 1), (None, 1), (1_000, 2), (1_001, None)]
    expected = Counter((s, d, w, kind) for s, g, w, kind in links for d, h in nodes if None not in (s, d, g, h) and g == h and s != d)
    links = durable(spark.createDataFrame(links, "src_id long, group_id long, weight long, edge_type string").coalesce(1), "links")
    nodes = durable(spark.createDataFrame(nodes, "id long, group_id long").coalesce(1), "nodes")
    out = factored.expanded(links, nodes, 2_000)
    assert out.columns == ["src_id", "dst_id", "weight", "edge_type"]
    found = out.withColumn("task", F.spark_partition_id()).collect()
    assert Counter((r.src_id, r.dst_id, r.weight, r.edge_type) for r in found) == expected
    tasks = Counter(r.task for r in found)
    assert len(tasks) >= 8 and max(tasks.values()) < len(found) / 4
    assert factored.expanded(links.limit(0), nodes).isEmpty() and factored.expanded(links, nodes.limit(0)).isEmpty()


def test_written_out_edges_take_little_disk(spark, tmp_path):
    """Pages of a hot title come in the same order for each link; files are a fraction of a byte an edge where that repeats."""
    n, m = 3_701, 600
    nodes = durable(spark.range(n).select((F.col("id") * 7919 + 10**12).alias("id"), F.lit(1).cast("long").alias("group_id")), "nodes")
    links = spark.range(m).select(F.col("id").alias("src_id"), F.lit(1).cast("long").alias("group_id"), F.lit(2).cast("long").alias("weight"), F.lit("link").alias("edge_type"))
    factored.expanded(durable(links, "links"), nodes).write.parquet(str(tmp_path / "edges"))
    found = spark.read.parquet(str(tmp_path / "edges"))
    assert found.count() == n * m == found.select("src_id", "dst_id").distinct().count()
    assert sum(f.stat().st_size for f in (tmp_path / "edges").glob("part-*")) < 0.5 * n * m


def test_a_title_of_very_many_pages_costs_a_sum(spark):
    """2,000 pages share a title that 2,000 pages link to, themselves among them: 4 million edges written out."""
    n = 2_000
    pages = spark.range(n).select("id", F.lit("Hub").alias("title"), F.lit(0).alias("ns"), F.array(F.lit("hub"), F.lit("Other")).alias("links"))
    pages = durable(pages.unionByName(spark.createDataFrame([(n, "Other", 0, ["hub"])], pages.schema)), "shared_pages")
    nodes, links = durable(factored.grouped_vertices(pages), "grouped_vertices"), durable(factored.grouped_links(pages), "grouped_links")
    assert nodes.count() == n + 1 and links.count() == 2 * n + 1
    ranks = {r.id: r.pagerank for r in factored.grouped_pagerank(nodes, links, rows_per_split=500).collect()}
    hub, other = 1.0, 1.0  # all hub pages are alike: each links to the n - 1 others and to the other page
    for _ in range(pagerank.MAX_ITER):
        hub, other = 0.15 + 0.85 * ((n - 1) * hub / n + other / n), 0.15 + 0.85 * n * hub / n
    scale = (n + 1) / (n * hub + other)
    assert abs(ranks[n] - other * scale) < 1e-9 and max(abs(ranks[i] - hub * scale) for i in range(n)) < 1e-9


def test_dense_ids_are_numbers_of_sorted_names(spark):
    names = [f"n{i % 500}" for i in range(2_000)] + [None, "", "Ä", "z" * 5_000]
    found = {r.title: r.id for r in node_ids.dense_ids(spark.createDataFrame([(n,) for n in names], "title string").repartition(5)).collect()}
    ordered = sorted({n for n in names if n is not None}, key=lambda n: n.encode())
    assert found == {name: -1 - i for i, name in enumerate(ordered)}
    up = node_ids.dense_ids(spark.createDataFrame([("b",), ("a",)], "title string"), first=10, step=1)
    assert {r.title: r.id for r in up.collect()} == {"a": 10, "b": 11}
    assert node_ids.dense_ids(spark.createDataFrame([], "title string")).isEmpty()


def test_forced_collisions_are_reported(spark):
    names = spark.createDataFrame([(f"n{i}",) for i in range(50)] * 2, "title string")
    groups = Counter(i % 7 for i in range(50))
    found = node_ids.id_collisions(names, F.substring("title", 2, 9).cast("int") % 7).collect()
    assert {r.id: r.names for r in found} == groups
    assert node_ids.id_collisions(names, F.xxhash64("title")).isEmpty()
