"""The full job: parse, profile, mine, link. Each stage takes pages and returns tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import tokens as tk
from pageloom.operators import articles, features, graph, models, pagerank, stats
from pageloom.sinks.published import Version, fingerprint
from pageloom.sinks.tables import move_folder, under, write_csv, write_model, write_tables
from pageloom.sources.mediawiki import parse_pages, read_pages, rejected_pages, write_ingested
from pageloom.storage import DENSE, durable


def ingest(spark: SparkSession, path: str, out: str | None = None, bad_records: str = "keep") -> DataFrame:
    """Parse a dump once and return the parsed pages as a column-pruned table scan.

    With ``out`` pages and rejected records come from one pass over the dump, written
    into folders by their state, which then become the tables ``pages`` and
    ``rejected_pages`` (of which ``record`` is the column that is filled).
    """
    if out is None:
        return durable(parse_pages(read_pages(spark, path, bad_records)), "pages", codec=DENSE)
    if bad_records == "fail":
        pages = parse_pages(read_pages(spark, path, bad_records))
        write_tables({"pages": pages, "rejected_pages": rejected_pages(spark, path).limit(0)}, out)
        return spark.read.schema(pages.schema).parquet(under(out, "pages"))
    schema = write_ingested(spark, path, lambda raw: parse_pages(raw, carry=["record"]), under(out, "ingested"))
    for state, name, columns in (("page", "pages", schema), ("rejected", "rejected_pages", "record string")):
        if not move_folder(spark, under(out, f"ingested/state={state}"), under(out, name)):
            spark.createDataFrame([], columns).write.parquet(under(out, name))
    return spark.read.schema(schema).parquet(under(out, "pages"))


def corpus_stats(pages: DataFrame, out: str | None = None, top_k: int = 25) -> dict[str, DataFrame]:
    """Every report over the pages; written under ``out`` if given.

    The text is read twice, for the page facts and for the tokens. All other
    reports read the facts.
    """
    facts = durable(stats.page_facts(pages), "page_facts")
    generated = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    tables = {
        "overview": stats.overview(facts).select(
            F.lit(generated).alias("generated_at"),
            F.lit(out).cast("string").alias("out_dir"),
            "*",
            F.array(*(F.lit(name) for name in pages.columns)).alias("columns"),
        )
    }
    if "ns" in pages.columns:
        tables["namespace_distribution"] = stats.namespace_distribution(facts)
    tables["text_length_summary_global"] = stats.text_length_global(facts)
    tables["text_length_summary_articles"] = stats.text_length_articles(facts)
    tables["link_density_summary"] = stats.link_density_summary(facts)
    if {"id", "title"} <= set(pages.columns):
        tables["top_most_linked"] = stats.top_most_linked(facts)
    tables["top_tokens"] = stats.top_tokens(pages, top_k)
    if out is not None:
        write_tables(tables, out)
    tables["overview_ratios"] = stats.overview_ratios(tables["overview"])
    return tables


def nlp(
    pages: DataFrame,
    k: int = 10,
    out: str | None = None,
    max_iter: int = models.MAX_ITER,
    separator: str = tk.LETTERS_ONLY,
) -> dict[str, DataFrame]:
    """Clusters and topics of the documents, from one shared feature space."""
    spark = pages.sparkSession
    docs = articles.nlp_docs(pages)
    space = features.build_feature_space(docs, separator=separator)

    cluster_model, clustered = models.train_clusters(space, k, max_iter=max_iter)
    clustered = durable(clustered, "cluster_assignments")
    cluster_names = durable(models.cluster_labels(cluster_model, spark), "cluster_labels")

    topic_model, topical = models.train_topics(space, k, max_iter=max_iter)
    topical = durable(topical, "topic_assignments")
    topic_names = durable(models.topic_labels(topic_model, spark), "topic_labels")

    tables = {
        "clusters/assignments": clustered,
        "clusters/labels": cluster_names,
        "clusters/assignments_labeled": models.with_labels(clustered, cluster_names, "cluster"),
        "topics/assignments": topical,
        "topics/labels": topic_names,
        "topics/assignments_labeled": models.with_labels(
            topical.select("id", "title", "topic"), topic_names, "topic"
        ),
    }
    if out is not None:
        write_tables(tables, out)
        write_model(cluster_model, under(out, "clusters/model"))
        write_model(topic_model, under(out, "topics/model"))
    tables["text_head"] = articles.text_head(docs)
    tables["clusters/sizes"] = models.group_sizes(clustered, cluster_names, "cluster")
    tables["clusters/top_terms"] = models.top_terms_report(cluster_names, "cluster")
    tables["topics/prevalence"] = models.group_sizes(topical, topic_names, "topic")
    tables["topics/top_terms"] = models.top_terms_report(topic_names, "topic")
    return tables


def page_graph(
    pages: DataFrame,
    out: str | None = None,
    max_iter: int = pagerank.MAX_ITER,
    top_n: int = 10,
    single_file: bool = False,
    every_mention: bool = False,
) -> dict[str, DataFrame]:
    """Vertices, edges and ranks of the page graph; ``every_mention`` weighs links by mentions in ``text_raw``."""
    vertices = durable(graph.graph_vertices(pages), "graph_vertices")
    edges = durable(graph.graph_edges(pages, every_mention), "graph_edges")
    if out is not None:
        write_csv(vertices, under(out, "graph/nodes_csv"), single_file)
        write_csv(edges, under(out, "graph/edges_csv"), single_file)
    ranked = pagerank.pagerank(vertices, edges, max_iter=max_iter)
    return {
        "vertices": vertices,
        "edges": edges,
        "counts": graph.graph_counts(vertices, edges),
        "pagerank": ranked,
        "top_pages": pagerank.top_by_rank(ranked, "page", top_n),
        "top_categories": pagerank.top_by_rank(ranked, "category", top_n),
    }


def run_pipeline(
    spark: SparkSession,
    path: str,
    out: str,
    k: int = 10,
    top_k: int = 25,
    max_iter: int = models.MAX_ITER,
    rank_iter: int = pagerank.MAX_ITER,
    top_n: int = 10,
    bad_records: str = "keep",
    separator: str = tk.LETTERS_ONLY,
) -> dict[str, dict[str, DataFrame]]:
    """Parse a dump and write every result under ``out``."""
    pages = ingest(spark, path, out, bad_records)
    return {
        "stats": corpus_stats(pages, out, top_k),
        "nlp": nlp(pages, k, out, max_iter, separator),
        "graph": page_graph(pages, out, rank_iter, top_n),
    }


def publish_pipeline(
    spark: SparkSession,
    path: str,
    out: str,
    k: int = 10,
    top_k: int = 25,
    max_iter: int = models.MAX_ITER,
    rank_iter: int = pagerank.MAX_ITER,
    top_n: int = 10,
    separator: str = tk.LETTERS_ONLY,
    keep: int = 2,
) -> str:
    """The full job as a version of its own, shown to readers by one rename at the end; the version's folder.

    The version is named by the input files and the parameters. A run that died is
    taken up again by calling this anew: stages that it finished are not repeated.
    Ranks and reports are written too, so that a reader needs nothing but the folder.
    """
    parameters = {"k": k, "top_k": top_k, "max_iter": max_iter, "rank_iter": rank_iter, "top_n": top_n, "separator": separator}
    version = Version(spark, out, fingerprint(spark, path, parameters))
    version.run("pages", lambda folder: ingest(spark, path, folder))
    pages = spark.read.parquet(under(version.folder, "pages")).drop("record")

    def graph_tables(folder: str) -> None:
        found = page_graph(pages, folder, rank_iter, top_n)
        write_tables({f"graph/{name}": found[name] for name in ("counts", "pagerank", "top_pages", "top_categories")}, folder)

    version.run("stats", lambda folder: corpus_stats(pages, folder, top_k))
    version.run("nlp", lambda folder: nlp(pages, k, folder, max_iter, separator))
    version.run("graph", graph_tables)
    version.publish(keep)
    return version.folder
