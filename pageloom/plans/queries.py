"""The registered queries. Each one runs over whole tables and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions import arrays, nesting, titles, wikitext
from pageloom.functions import tokens as tk
from pageloom.operators import articles, factored, features, graph, models, node_ids, pagerank, percentiles, redirects, stats
from pageloom.operators.skew import join_split
from pageloom.plans.pipeline import corpus_stats, page_graph, publish_pipeline
from pageloom.plans.relations import REPORTS, deep_pages, markup_pages, nested_pages, redirect_pages, shared_title_pages, spread, table, wiki_pages, wiki_texts
from pageloom.sinks.published import published_folder
from pageloom.sinks.tables import under, write_csv, write_model, write_tables
from pageloom.sources.mediawiki import parse_pages, project_pages, read_pages, rejected_pages, with_revision_time
from pageloom.storage import DENSE, durable, fresh_path

Query = Callable[[SparkSession, str], DataFrame]

_built: dict[tuple[str, str, str], Any] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], Any]) -> Any:
    """Stage results shared by the queries of one application, as the stages of the job share them."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def forget_stages() -> None:
    """Let the shared stages be built anew."""
    _built.clear()


def rounded(column: Column | str, name: str) -> Column:
    return F.round(column, 6).alias(name)


def _round_all(df: DataFrame) -> DataFrame:
    return df.select(*(rounded(name, name) if kind == "double" else F.col(name) for name, kind in df.dtypes))


# --- shared stages ------------------------------------------------------------


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "pages", lambda: durable(parse_pages(nested_pages(spark, sf_dir)), "pages", codec=DENSE))


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "facts", lambda: durable(stats.page_facts(parsed(spark, sf_dir)), "page_facts"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.nlp_docs(parsed(spark, sf_dir))


def space(spark: SparkSession, sf_dir: str) -> features.FeatureSpace:
    return _once(spark, sf_dir, "space", lambda: features.build_feature_space(docs(spark, sf_dir)))


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "vertices", lambda: durable(graph.graph_vertices(parsed(spark, sf_dir)), "graph_vertices")
    )


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "edges", lambda: durable(graph.graph_edges(parsed(spark, sf_dir)), "graph_edges"))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark,
        sf_dir,
        "ranked",
        lambda: durable(pagerank.pagerank(vertices(spark, sf_dir), edges(spark, sf_dir)), "ranked"),
    )


def _clusters(spark: SparkSession, sf_dir: str) -> tuple[Any, DataFrame, DataFrame]:
    def build():
        model, assigned = models.train_clusters(space(spark, sf_dir))
        names = durable(models.cluster_labels(model, spark), "cluster_labels")
        return model, durable(assigned, "cluster_assignments"), names

    return _once(spark, sf_dir, "clusters", build)


def _topics(spark: SparkSession, sf_dir: str) -> tuple[Any, DataFrame, DataFrame]:
    def build():
        model, assigned = models.train_topics(space(spark, sf_dir))
        names = durable(models.topic_labels(model, spark), "topic_labels")
        return model, durable(assigned, "topic_assignments"), names

    return _once(spark, sf_dir, "topics", build)


# --- sources and parsing --------------------------------------------------------


def xml_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the pages as an XML dump, scan it back, project the page columns."""
    path = fresh_path(spark, "dump")
    nested = nested_pages(spark, sf_dir)
    nested.write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(path)
    return project_pages(read_pages(spark, path))


_BROKEN = """CASE doc_id % 40 WHEN 7 THEN concat('<ns>zero</ns>', char(10)) WHEN 11 THEN '<ns>0</ns> & ' ELSE '<ns>0</ns>' END"""


def _broken_dump(spark: SparkSession, sf_dir: str) -> str:
    """A dump of the documents in which some pages have a wrong number or a bare ampersand."""
    path = fresh_path(spark, "broken_dump")
    record = f"""concat('<page><title>Doc ', CAST(doc_id AS STRING), '</title>', {_BROKEN}, '<id>', CAST(doc_id AS STRING),
      '</id><revision><id>1</id><text>', {_xml_text('text')}, '</text></revision></page>') AS value"""
    spread(table(spark, sf_dir, "documents")).selectExpr(record).write.text(path)
    return path


def _xml_text(column: str) -> str:
    return f"replace(replace(replace({column}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rejected_pages(spark, _broken_dump(spark, sf_dir))
    return found.select(F.regexp_extract("record", "<id>([0-9]+)</id>", 1).cast("bigint").alias("id"))


def kept_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of the same dump."""
    return project_pages(read_pages(spark, _broken_dump(spark, sf_dir))).select("id", "title", "ns", "text_raw")


def revision_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_revision_time(project_pages(nested_pages(spark, sf_dir))).select(
        "id", "timestamp", F.date_format("revision_time", "yyyy-MM-dd HH:mm:ss").alias("revision_time")
    )


def page_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_pages(nested_pages(spark, sf_dir))


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parse_pages(nested_pages(spark, sf_dir))
    joined = [
        F.array_join(name, "|").alias(name) for name in ("categories", "templates", "external_links", "links")
    ]
    plain = ("title", "ns", "id", "redirect", "revision_id", "timestamp", "text_raw", "text")
    return pages.select(*plain, *joined)


def sample_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.sample_page(parsed(spark, sf_dir)).select("id", "title", "ns", "text_length", "raw_head")


def _positions(df: DataFrame, key: str, values: Column) -> DataFrame:
    return df.select(F.col(key), F.posexplode(values).alias("pos", "value"))


def _extract(pages: Callable, values: Callable[[Column], Column]) -> Query:
    return lambda spark, sf_dir: _positions(pages(spark, sf_dir), "id", values(F.col("text_raw")))


def url_external_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """External links of a web page: its own address and those in its whole markup."""
    whole = F.concat("url", F.lit("\n"), "html")
    return _positions(spread(table(spark, sf_dir, "pages")), "page_id", wikitext.external_links(whole))


def clean_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = arrays.clean_array(F.split("text", r"\."))
    return _positions(table(spark, sf_dir, "documents"), "doc_id", lines)


def markup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("text_raw")
    return wiki_texts(spark, sf_dir).select(
        "id",
        wikitext.split_count(raw, wikitext.LINK_MARKUP).alias("links"),
        wikitext.split_count(raw, wikitext.CATEGORY_MARKUP).alias("categories"),
        wikitext.split_count(raw, wikitext.TEMPLATE_MARKUP).alias("templates"),
    )


def _clean(pages: Callable, compat: bool = False) -> Query:
    return lambda spark, sf_dir: pages(spark, sf_dir).select(
        "id", wikitext.clean_wikitext(F.col("text_raw"), compat).alias("text")
    )


def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages")).select(
        "page_id", wikitext.clean_wikitext(F.col("html")).alias("text")
    )


def clean_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deep_pages(spark, sf_dir).select("id", wikitext.clean_nested(F.col("text_raw")).alias("text"))


def without_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Templates of any depth out of the raw text, and nothing else."""
    return deep_pages(spark, sf_dir).select("id", nesting.without_nested(F.col("text_raw")).alias("text"))


# --- filters ---------------------------------------------------------------------


def article_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.article_filter(wiki_pages(spark, sf_dir)).select("id", "title", "ns")


def nlp_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs(spark, sf_dir)


def text_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles.text_head(docs(spark, sf_dir))


def non_empty_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sentence of a text that is no blank, in order."""
    sentence = F.posexplode(F.split("text", r"\.")).alias("pos", "sentence")
    found = table(spark, sf_dir, "documents").select("doc_id", sentence)
    return found.select("doc_id", "pos", titles.non_empty(F.col("sentence")).alias("title"))


def norm_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.concat(F.lit(" "), F.translate("text", ".", "_"))
    return table(spark, sf_dir, "documents").select("doc_id", titles.norm_title(named).alias("title_norm"))


# --- statistics ------------------------------------------------------------------


def _on_facts(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _round_all(report(facts(spark, sf_dir)))


def _on_pages(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: _round_all(report(wiki_pages(spark, sf_dir)))


def length_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(stats.length_summary(table(spark, sf_dir, "documents"), "documents", "n_chars"))


def _percentile_rows(spark: SparkSession, source: DataFrame, shares: dict[str, list[float]]) -> DataFrame:
    found = percentiles.exact_percentiles(source, shares)
    rows = [(c, share, float(value)) for c, values in found.items() for share, value in zip(shares[c], values)]
    return spark.createDataFrame(rows, "measure string, share double, value double")


def exact_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of a whole-number and of a real column of all pages."""
    counted = durable(facts(spark, sf_dir).select("text_len", (F.col("text_len") / 1000.0).alias("kchars")), "lengths")
    return _percentile_rows(spark, counted, {"text_len": [0.0, 0.01, 0.5, 0.9, 0.99, 1.0], "kchars": [0.25, 0.5, 0.9, 0.999]})


def exact_link_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = durable(stats.link_counts(facts(spark, sf_dir)).select("link_count", "links_per_kchar"), "densities")
    return _round_all(_percentile_rows(spark, counted, {"link_count": [0.5, 0.9], "links_per_kchar": [0.5, 0.9]}))


def link_counts_from_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts for pages without extracted arrays."""
    return _round_all(stats.link_counts(stats.page_facts(wiki_texts(spark, sf_dir))))


def top_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.top_tokens(parsed(spark, sf_dir))


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.token_counts(table(spark, sf_dir, "conversations"), F.col("text"), tk.english_stop_words())


# --- text features ---------------------------------------------------------------


def _term_column(name: str, glue: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = features.term_arrays(docs(spark, sf_dir))
        return found.select("id", F.size(name).alias("n"), F.array_join(name, glue).alias(name))

    return query


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return space(spark, sf_dir).vocabulary.terms


def vocabulary_sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vocabulary, with the terms that are surely too rare left out before the shuffle."""
    return features.build_vocabulary(docs(spark, sf_dir), sketch_buckets=1 << 20).terms


def idf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(features.idf_weights(space(spark, sf_dir).vocabulary))


def tfidf_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(features.tfidf_features(space(spark, sf_dir)))


def label_from_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = arrays.label_from_terms(F.split("text", " "))
    return table(spark, sf_dir, "documents").select("doc_id", label.alias("label"))


# --- vectors, groups and labels, on the embeddings -------------------------------


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.concat(F.lit("vec "), F.col("vec_id").cast("string")).alias("title"),
        F.col("embedding").cast("array<double>").alias("topic_distribution"),
        "label",
    )


def _vector_labels(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    present = table(spark, sf_dir, "embeddings").select(F.col("label").alias(key)).distinct()
    return present.withColumn(f"{key}_name", F.concat(F.lit("group "), F.col(key).cast("string")))


def vector_argmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = vector_to_array(array_to_vector("topic_distribution"))
    return _vectors(spark, sf_dir).select("id", arrays.argmax(vector).alias("position"))


def top_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(models.top_topics(_vectors(spark, sf_dir), _vector_labels(spark, sf_dir, "topic")))


def embedding_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = _vectors(spark, sf_dir).withColumnRenamed("label", "cluster")
    return models.group_sizes(assigned, _vector_labels(spark, sf_dir, "cluster"), "cluster")


def embedding_topic_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    dominant = _vectors(spark, sf_dir).select(arrays.argmax(F.col("topic_distribution")).alias("topic"))
    return models.group_sizes(dominant, _vector_labels(spark, sf_dir, "topic"), "topic")


def embedding_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    dominant = _vectors(spark, sf_dir).select(
        "id", "title", arrays.argmax(F.col("topic_distribution")).alias("topic")
    )
    return models.with_labels(dominant, _vector_labels(spark, sf_dir, "topic"), "topic")


# --- fitted models ----------------------------------------------------------------


def cluster_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir)[1]


def cluster_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clusters(spark, sf_dir)[2].orderBy("cluster")


def cluster_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, assigned, names = _clusters(spark, sf_dir)
    return models.group_sizes(assigned, names, "cluster")


def cluster_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.top_terms_report(_clusters(spark, sf_dir)[2], "cluster")


def cluster_assignments_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, assigned, names = _clusters(spark, sf_dir)
    return models.with_labels(assigned, names, "cluster")


def topic_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topics(spark, sf_dir)[1]


def topic_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topics(spark, sf_dir)[2].orderBy("topic")


def topic_prevalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, assigned, names = _topics(spark, sf_dir)
    return models.group_sizes(assigned, names, "topic")


def topic_top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.top_terms_report(_topics(spark, sf_dir)[2], "topic")


def topic_assignments_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, assigned, names = _topics(spark, sf_dir)
    return models.with_labels(assigned.select("id", "title", "topic"), names, "topic")


def article_top_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, assigned, names = _topics(spark, sf_dir)
    return models.top_topics(assigned, names)


def _saved(spark: SparkSession, fitted: tuple[Any, DataFrame, DataFrame]) -> tuple[str, str]:
    base = fresh_path(spark, "saved")
    write_model(fitted[0], f"{base}/model")
    fitted[2].write.parquet(f"{base}/labels")
    return f"{base}/model", f"{base}/labels"


def predict_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.predict_clusters(parsed(spark, sf_dir), *_saved(spark, _clusters(spark, sf_dir)))


def predict_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.predict_topics(parsed(spark, sf_dir), *_saved(spark, _topics(spark, sf_dir)))


# --- written results, read back --------------------------------------------------------


def _read_back(spark: SparkSession, folder: str, tables: dict[str, str]) -> DataFrame:
    """``name, rows, checksum`` of written tables; the checksum is the sum of an expression over whole numbers."""
    found = None
    for name, measure in tables.items():
        total = F.coalesce(F.sum(F.expr(measure)), F.lit(0)).cast("bigint")
        row = spark.read.parquet(under(folder, name)).agg(F.count("*").alias("rows"), total.alias("checksum"))
        row = row.select(F.lit(name).alias("name"), "rows", "checksum")
        found = row if found is None else found.unionByName(row)
    return found


def report_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every report of the statistics stage as a reader finds it under the output folder."""
    folder = fresh_path(spark, "reports")
    corpus_stats(parsed(spark, sf_dir), folder)
    return _read_back(spark, folder, REPORTS)


def _written_models(spark: SparkSession, sf_dir: str) -> str:
    """The outputs of both trained models, written once."""

    def build() -> str:
        folder = fresh_path(spark, "models")
        for key, (model, assigned, names) in (("cluster", _clusters(spark, sf_dir)), ("topic", _topics(spark, sf_dir))):
            labeled = models.with_labels(assigned.select("id", "title", key), names, key)
            write_tables({f"{key}s/assignments": assigned, f"{key}s/labels": names, f"{key}s/assignments_labeled": labeled}, folder)
            write_model(model, under(folder, f"{key}s/model"))
        return folder

    return _once(spark, sf_dir, "written_models", build)


def _known_group(key: str, groups: int = 10) -> Column:
    return (F.col(key) >= 0) & (F.col(key) < groups)


def cluster_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document once, in a cluster that exists and has a name."""
    read = spark.read.parquet(under(_written_models(spark, sf_dir), "clusters/assignments_labeled"))
    return read.select("id", "title", _known_group("cluster").alias("known"), (F.length("cluster_name") > 0).alias("named"))


def topic_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document once: its topic is the place of the largest weight, and the weights sum to 1 if it has a known term, else to 0."""
    read = spark.read.parquet(under(_written_models(spark, sf_dir), "topics/assignments"))
    weights = F.col("topic_distribution")
    total = F.aggregate(weights, F.lit(0.0), lambda a, b: a + b)
    largest = F.get(weights, F.col("topic")) == F.array_max(weights)
    return read.select("id", "title", F.size(weights).alias("topics"), largest.alias("largest"), F.round(total, 6).alias("total"))


def topic_outputs_labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = spark.read.parquet(under(_written_models(spark, sf_dir), "topics/assignments_labeled"))
    return read.select("id", "title", _known_group("topic").alias("known"), (F.length("topic_name") > 0).alias("named"))


def label_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each label of both models: its number, whether its name is made of its first terms, and whether all are of the vocabulary."""
    folder, terms = _written_models(spark, sf_dir), space(spark, sf_dir).vocabulary.terms.select("term")
    found = None
    for key in ("cluster", "topic"):
        names = spark.read.parquet(under(folder, f"{key}s/labels"))
        alien = names.select(F.explode("top_terms").alias("term")).join(terms, "term", "left_anti").agg(F.count("*").alias("alien"))
        made = arrays.label_from_terms(F.col("top_terms")) == F.col(f"{key}_name")
        rows = names.select(F.lit(key).alias("kind"), F.col(key).cast("bigint").alias("number"), made.alias("from_terms"), F.size("top_terms").alias("terms"))
        rows = rows.join(F.broadcast(alien))  # one row
        found = rows if found is None else found.unionByName(rows)
    return found


def group_size_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sizes of both groupings: they cover all documents, in falling order, under the names of the labels."""
    folder, found = _written_models(spark, sf_dir), None
    for key in ("cluster", "topic"):
        names = spark.read.parquet(under(folder, f"{key}s/labels"))
        sizes = models.group_sizes(spark.read.parquet(under(folder, f"{key}s/assignments")), names, key)
        row = sizes.agg(F.sum("count").alias("documents"), F.count_if(F.col(f"{key}_name").isNull()).alias("unnamed"))
        row = row.select(F.lit(key).alias("kind"), "*")
        found = row if found is None else found.unionByName(row)
    return found


def term_report_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The term reports hold the first terms of the labels, in the order of the numbers."""
    folder, found = _written_models(spark, sf_dir), None
    for key in ("cluster", "topic"):
        names = spark.read.parquet(under(folder, f"{key}s/labels"))
        report = models.top_terms_report(names, key).select(key, F.col("top_terms").alias("shown"))
        same = F.slice("top_terms", 1, models.REPORT_TERMS) == F.col("shown")
        rows = names.join(report, key).select(F.lit(key).alias("kind"), F.col(key).cast("bigint").alias("number"), same.alias("same"))
        found = rows if found is None else found.unionByName(rows)
    return found


def top_topic_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three ranked topics of each document with falling weights, the first of them its own."""
    _, assigned, names = _topics(spark, sf_dir)
    listed = models.top_topics(assigned, names).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("topic_rank", "topic_weight", "topic"))).alias("ranks"))
    falling = F.forall(F.zip_with("ranks", F.slice("ranks", 2, 3), lambda a, b: b.isNull() | (a["topic_weight"] >= b["topic_weight"])), lambda x: x)
    own = listed.join(assigned.select("id", "topic"), "id")
    return own.select("id", F.size("ranks").alias("ranks"), falling.alias("falling"), (F.col("ranks")[0]["topic"] == F.col("topic")).alias("own_first"))


def _predicted(predict: Callable, key: str) -> Query:
    """Saved models loaded again score every document as the training did."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _written_models(spark, sf_dir)
        scored = predict(parsed(spark, sf_dir), under(folder, f"{key}s/model"), under(folder, f"{key}s/labels"))
        before = spark.read.parquet(under(folder, f"{key}s/assignments_labeled")).select("id", F.col(key).alias("before"), F.col(f"{key}_name").alias("name_before"))
        same = (F.col(key) == F.col("before")) & (F.col(f"{key}_name") == F.col("name_before"))
        return scored.join(before, "id").select("id", "title", same.alias("same"))

    return query


def stage_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms by the saved text stages, not by the columns that training uses."""
    found = PipelineModel(features.text_stages()).transform(docs(spark, sf_dir))
    return found.select("id", F.size("terms").alias("n"), F.array_join("terms", "|").alias("terms"))


def graph_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph stage as a whole: rows of its tables, and the sum of the ranks."""
    found = page_graph(parsed(spark, sf_dir), fresh_path(spark, "graph"))
    parts = [found[name].agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name in ("vertices", "edges", "top_pages", "top_categories")]
    ranks = found["pagerank"].agg(F.lit("pagerank").alias("name"), F.round(F.sum("pagerank"), 3).cast("bigint").alias("rows"))
    return reduce(DataFrame.unionByName, parts, ranks)


def full_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job on a dump of the documents, published and read back from its version."""
    dump, out = fresh_path(spark, "dump"), fresh_path(spark, "published")
    nested_pages(spark, sf_dir).write.format("xml").option("rootTag", "mediawiki").option("rowTag", "page").save(dump)
    publish_pipeline(spark, dump, out)
    counted = {"pages": "id", "rejected_pages": "0", "clusters/assignments": "id", "topics/assignments_labeled": "id", "top_tokens": "count * length(token)"}
    return _read_back(spark, published_folder(spark, out), counted)


# --- graph ---------------------------------------------------------------------------


def page_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.page_vertices(parsed(spark, sf_dir))


def category_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.category_vertices(parsed(spark, sf_dir)).select("title", "kind", "title_norm")


def stable_node_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per category: its number of ids, and whether they are negative and its own."""
    named = graph.named_category_edges(parsed(spark, sf_dir)).groupBy("title", "dst_id").agg(F.count("*").alias("rows"))
    return named.groupBy("title").agg(
        F.count("dst_id").alias("ids"),
        F.min((F.col("dst_id") < 0).cast("int")).alias("negative"),
        F.sum("rows").alias("pages"),
    )


def link_title_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = parsed(spark, sf_dir)
    return graph.link_title_join(
        durable(graph.link_mentions(pages), "link_mentions"), durable(graph.page_vertices(pages), "page_vertices")
    )


def redirect_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redirects.redirect_ends(redirects.redirect_steps(redirect_pages(spark, sf_dir)))


def resolved_link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of links followed through their redirects."""
    return graph.link_edges(redirect_pages(spark, sf_dir), redirects=True)


def _grouped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    def build():
        pages = shared_title_pages(spark, sf_dir)
        groups = durable(factored.title_groups(pages), "title_groups")
        return durable(factored.grouped_vertices(pages, groups), "grouped_vertices"), durable(factored.grouped_links(pages, groups), "grouped_links")

    return _once(spark, sf_dir, "grouped", build)


def grouped_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links to titles that many pages share, one row for each page and title."""
    return _grouped(spark, sf_dir)[1].where("edge_type = 'link'")


def expanded_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same links written out to every page of their titles."""
    nodes, links = _grouped(spark, sf_dir)
    return factored.expanded(links.where("edge_type = 'link'"), nodes)


def grouped_pagerank(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = factored.grouped_pagerank(*_grouped(spark, sf_dir))
    return found.select(F.when(F.col("kind") == "page", F.col("id")).alias("page_id"), "title", "kind", rounded("pagerank", "pagerank"))


def dense_node_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct sentence numbered in order; no two share a number."""
    sentences = table(spark, sf_dir, "documents").select(F.explode(F.split("text", r"\.")).alias("title"))
    return node_ids.dense_ids(sentences)


def id_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that ids of two digits would merge."""
    named = table(spark, sf_dir, "documents").select(F.concat(F.lit("Doc "), "doc_id").alias("title"), "doc_id")
    return node_ids.id_collisions(named, F.pmod("doc_id", F.lit(97)))


def link_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.link_edges(parsed(spark, sf_dir))


def mention_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.link_edges(parsed(spark, sf_dir), links=wikitext.link_targets(F.col("text_raw")))


def category_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.named_category_edges(parsed(spark, sf_dir)).select("src_id", "title", "weight", "edge_type")


def graph_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_id = F.when(F.col("kind") == "page", F.col("id"))
    return graph.graph_vertices(parsed(spark, sf_dir)).select(page_id.alias("page_id"), "title", "kind")


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = vertices(spark, sf_dir).select(F.col("id").alias("dst_id"), F.col("title").alias("dst_title"))
    found = join_split(edges(spark, sf_dir), ends, "dst_id", F.col("src_id"))
    page_id = F.when(F.col("edge_type") == "link", F.col("dst_id"))
    return found.select("src_id", page_id.alias("dst_page_id"), "dst_title", "weight", "edge_type")


def graph_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.graph_counts(vertices(spark, sf_dir), edges(spark, sf_dir))


def nodes_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the vertices as CSV and read them back."""
    path = fresh_path(spark, "nodes_csv")
    write_csv(vertices(spark, sf_dir), path)
    read = spark.read.schema("id bigint, title string, kind string").option("header", True).csv(path)
    return read.select(F.when(F.col("kind") == "page", F.col("id")).alias("page_id"), "title", "kind")


def edges_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the edges as CSV and read them back."""
    path = fresh_path(spark, "edges_csv")
    write_csv(edges(spark, sf_dir), path)
    read = spark.read.schema("src_id bigint, dst_id bigint, weight bigint, edge_type string").option("header", True).csv(path)
    page_id = F.when(F.col("edge_type") == "link", F.col("dst_id"))
    return read.select("src_id", page_id.alias("dst_page_id"), "weight", "edge_type")


def pagerank_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    page_id = F.when(F.col("kind") == "page", F.col("id"))
    return ranked(spark, sf_dir).select(page_id.alias("page_id"), "title", "kind", rounded("pagerank", "pagerank"))


def pagerank_top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(pagerank.top_by_rank(ranked(spark, sf_dir), "page"))


def pagerank_top_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_all(pagerank.top_by_rank(ranked(spark, sf_dir), "category")).drop("id")


QUERIES: dict[str, Query] = {
    "xml_pages": xml_pages,
    "page_projection": page_projection,
    "rejected_pages": rejected,
    "kept_pages": kept_pages,
    "revision_time": revision_time,
    "parse_pages": parsed_pages,
    "sample_page": sample_page,
    "extract_categories": _extract(wiki_texts, wikitext.categories),
    "extract_templates": _extract(wiki_texts, wikitext.templates),
    "extract_external_links": _extract(wiki_texts, wikitext.external_links),
    "extract_links": _extract(wiki_texts, wikitext.links),
    "markup_categories": _extract(markup_pages, wikitext.categories),
    "markup_templates": _extract(markup_pages, wikitext.templates),
    "markup_external_links": _extract(markup_pages, wikitext.external_links),
    "markup_links": _extract(markup_pages, wikitext.links),
    "url_external_links": url_external_links,
    "clean_array": clean_array,
    "markup_counts": markup_counts,
    "clean_text": _clean(wiki_texts),
    "clean_text_compat": _clean(wiki_texts, compat=True),
    "clean_markup": _clean(markup_pages),
    "clean_markup_compat": _clean(markup_pages, compat=True),
    "clean_html": clean_html,
    "clean_nested": clean_nested,
    "without_templates": without_templates,
    "article_filter": article_filter,
    "nlp_docs": nlp_docs,
    "text_head": text_head,
    "non_empty_title": non_empty_title,
    "norm_title": norm_title,
    "page_counts": _on_pages(stats.page_counts),
    "title_stats": _on_pages(stats.title_stats),
    "duplicate_titles": _on_pages(stats.duplicate_titles),
    "namespace_distribution": _on_pages(stats.namespace_distribution),
    "top_namespaces": _on_pages(stats.top_namespaces),
    "text_length_global": _on_facts(stats.text_length_global),
    "text_length_articles": _on_facts(stats.text_length_articles),
    "length_summary": length_summary,
    "link_counts": _on_facts(stats.link_counts),
    "link_counts_from_markup": link_counts_from_markup,
    "exact_lengths": exact_lengths,
    "exact_link_density": exact_link_density,
    "link_density_summary": _on_facts(stats.link_density_summary),
    "top_most_linked": _on_facts(stats.top_most_linked),
    "top_tokens": top_tokens,
    "conversation_tokens": conversation_tokens,
    "overview": _on_facts(stats.overview),
    "overview_ratios": _on_facts(lambda rows: stats.overview_ratios(stats.overview(rows))),
    "tokens_nlp": _term_column("tokens_raw", " "),
    "tokens_clean": _term_column("tokens", " "),
    "bigrams": _term_column("bigrams", "|"),
    "terms": _term_column("terms", "|"),
    "vocabulary": vocabulary,
    "vocabulary_sketched": vocabulary_sketched,
    "idf_weights": idf_weights,
    "tfidf_features": tfidf_features,
    "label_from_terms": label_from_terms,
    "vector_argmax": vector_argmax,
    "top_topics": top_topics,
    "embedding_group_sizes": embedding_group_sizes,
    "embedding_topic_prevalence": embedding_topic_prevalence,
    "embedding_labels": embedding_labels,
    "cluster_assignments": cluster_assignments,
    "cluster_labels": cluster_labels,
    "cluster_sizes": cluster_sizes,
    "cluster_top_terms": cluster_top_terms,
    "cluster_assignments_labeled": cluster_assignments_labeled,
    "topic_assignments": topic_assignments,
    "topic_labels": topic_labels,
    "topic_prevalence": topic_prevalence,
    "topic_top_terms": topic_top_terms,
    "topic_assignments_labeled": topic_assignments_labeled,
    "article_top_topics": article_top_topics,
    "predict_clusters": predict_clusters,
    "predict_topics": predict_topics,
    "report_outputs": report_outputs,
    "cluster_outputs": cluster_outputs,
    "topic_outputs": topic_outputs,
    "topic_outputs_labeled": topic_outputs_labeled,
    "label_outputs": label_outputs,
    "group_size_outputs": group_size_outputs,
    "term_report_outputs": term_report_outputs,
    "top_topic_outputs": top_topic_outputs,
    "predicted_clusters_again": _predicted(models.predict_clusters, "cluster"),
    "predicted_topics_again": _predicted(models.predict_topics, "topic"),
    "stage_bundle": stage_bundle,
    "graph_outputs": graph_outputs,
    "full_job": full_job,
    "page_vertices": page_vertices,
    "category_vertices": category_vertices,
    "stable_node_id": stable_node_id,
    "link_title_join": link_title_join,
    "redirect_ends": redirect_ends,
    "resolved_link_edges": resolved_link_edges,
    "grouped_links": grouped_links,
    "expanded_links": expanded_links,
    "grouped_pagerank": grouped_pagerank,
    "dense_node_ids": dense_node_ids,
    "id_collisions": id_collisions,
    "link_edges": link_edges,
    "mention_edges": mention_edges,
    "category_edges": category_edges,
    "graph_vertices": graph_vertices,
    "graph_edges": graph_edges,
    "graph_counts": graph_counts,
    "nodes_csv": nodes_csv,
    "edges_csv": edges_csv,
    "pagerank": pagerank_all,
    "pagerank_top_pages": pagerank_top_pages,
    "pagerank_top_categories": pagerank_top_categories,
}
