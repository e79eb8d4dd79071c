"""Training, naming and scoring: invariants on the whole document set."""

from __future__ import annotations

import math
import time
from dataclasses import replace

import pytest
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from pageloom import storage
from pageloom.operators import articles, features, models
from pageloom.sinks.tables import write_model

K = 3


@pytest.fixture(scope="module")
def space(pages):
    return features.build_feature_space(articles.nlp_docs(pages))


@pytest.fixture(scope="module")
def clusters(space):
    return models.train_clusters(space, k=K, max_iter=3)


@pytest.fixture(scope="module")
def topics(space):
    return models.train_topics(space, k=K, max_iter=3)


def test_vocabulary_equals_the_vectorizer(space):
    docs = features.term_arrays(space.docs)
    fitted = CountVectorizer(inputCol="terms", outputCol="tf", vocabSize=50_000, minDF=20, maxDF=0.6).fit(docs)
    assert sorted(fitted.vocabulary) == sorted(space.vocabulary.words)
    assert space.vocabulary.n_docs == space.docs.count()
    counts = [r.total_count for r in space.vocabulary.terms.orderBy("term_index").collect()]
    assert counts == sorted(counts, reverse=True)


def test_vocabulary_limits(spark):
    texts = ["alpha beta"] * 6 + ["alpha gamma"] * 4 + ["delta"] * 10
    docs = spark.createDataFrame([(i, "t", text) for i, text in enumerate(texts)], "id int, title string, text string")
    terms = lambda **limits: features.build_vocabulary(docs, **limits).words
    assert terms(min_df=5, max_df=0.5) == ["alpha", "delta", "alpha beta", "beta"]
    assert terms(min_df=0.25, max_df=8) == ["alpha beta", "beta"]
    assert terms(min_df=1, max_df=1.0, vocab_size=2) == [] and terms(min_df=1, max_df=10, vocab_size=2) == ["alpha", "delta"]
    with pytest.raises(ValueError):
        terms(min_df=20, max_df=0.6)


def test_features_have_unit_length(space):
    norms = features.tfidf_features(space).groupBy("id").agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
    assert norms.where(F.abs(F.col("norm") - 1) > 1e-9).isEmpty()


def test_training_shuffles_its_layout_once(spark, space):
    """The fit passes over its input three times before it keeps it; the rows are dealt out for the first time only."""
    seen = spark.sparkContext.accumulator(0)
    passed = F.udf(lambda _: seen.add(1) or True, "boolean")
    models.train_clusters(replace(space, features=space.features.where(passed("id"))), k=2, max_iter=1)
    assert seen.value == space.docs.count()
    assert all(file.endswith(".zstd.parquet") for table in (space.counts, space.features) for file in table.inputFiles())


def test_shuffles_of_a_long_call_are_dropped_within_it(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    shuffles = lambda: {name for name in str(disk.getAllFiles().mkString("|")).split("|") if "/shuffle_" in name}
    before = shuffles()
    spark.range(1_000).repartition(3, "id").groupBy("id").count().collect()
    made, until = shuffles() - before, time.monotonic() + 30
    with storage.swept(spark, 0.2):
        while made & shuffles() and time.monotonic() < until:
            time.sleep(0.1)
        assert not made & shuffles()


def test_clusters(spark, space, clusters):
    model, assigned = clusters
    assert assigned.count() == space.docs.count() == assigned.select("id").distinct().count()
    assert assigned.where(~F.col("cluster").between(0, K - 1)).isEmpty()
    labels = {r.cluster: r for r in models.cluster_labels(model, spark).collect()}
    centres = model.stages[-1].clusterCenters()
    assert sorted(labels) == list(range(len(centres)))
    for index, centre in enumerate(centres):
        best = sorted(range(len(centre)), key=lambda i: (-centre[i], i))[:15]
        assert labels[index].top_terms == [space.vocabulary.words[i] for i in best]
        assert labels[index].cluster_name == " / ".join(labels[index].top_terms[:3])
    sizes = models.group_sizes(assigned, models.cluster_labels(model, spark), "cluster").collect()
    assert sum(r["count"] for r in sizes) == space.docs.count()
    assert [r["count"] for r in sizes] == sorted((r["count"] for r in sizes), reverse=True)


def test_topics(spark, space, topics):
    model, assigned = topics
    assert assigned.count() == space.docs.count()
    known = {r.id for r in space.counts.collect() if r.tf.numNonzeros()}
    for row in assigned.collect():  # a document without a vocabulary term has no topic weights
        assert math.isclose(sum(row.topic_distribution), float(row.id in known), rel_tol=1e-6)
        assert row.topic_distribution[row.topic] == max(row.topic_distribution)
    labels = {r.topic: r for r in models.topic_labels(model, spark).collect()}
    assert sorted(labels) == list(range(K))
    for row in model.stages[-1].describeTopics(15).collect():
        assert labels[row.topic].top_terms == [space.vocabulary.words[i] for i in row.termIndices]
        assert labels[row.topic].term_weights == list(row.termWeights)
    report = models.top_terms_report(models.topic_labels(model, spark), "topic").collect()
    assert [r.topic for r in report] == list(range(K)) and all(len(r.top_terms) == 12 for r in report)


def test_top_topics_match_a_sort(spark, topics):
    model, assigned = topics
    found = models.top_topics(assigned, models.topic_labels(model, spark), n=2).collect()
    ranked = {(r.id, r.topic_rank): (r.topic, r.topic_weight) for r in found}
    for row in assigned.collect():
        best = sorted(range(K), key=lambda t: (-row.topic_distribution[t], t))[:2]
        assert [ranked[(row.id, n + 1)][0] for n in range(2)] == best
    assert len(found) == 2 * assigned.count()


def test_saved_models_score_as_trained(spark, pages, clusters, topics, tmp_path):
    for key, (model, assigned), labels, predict in (
        ("cluster", clusters, models.cluster_labels, models.predict_clusters),
        ("topic", topics, models.topic_labels, models.predict_topics),
    ):
        path, names = f"{tmp_path}/{key}", f"{tmp_path}/{key}_labels"
        write_model(model, path)
        labels(model, spark).write.parquet(names)
        scored = predict(pages, path, names)
        both = scored.select("id", F.col(key).alias("scored"), f"{key}_name").join(assigned, "id")
        assert both.count() == assigned.count()
        assert both.where(F.col("scored") != F.col(key)).isEmpty()
        assert both.where(F.col(f"{key}_name").isNull()).isEmpty()
        assert f"{key}_name" not in predict(pages, path).columns


def test_labels_may_miss_groups(spark):
    assigned = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "id int, title string, cluster int")
    labels = spark.createDataFrame([(0, "zero")], "cluster long, cluster_name string")
    found = {r.id: r.cluster_name for r in models.with_labels(assigned, labels, "cluster").collect()}
    assert found == {1: "zero", 2: None}


def test_training_does_not_depend_on_the_input_layout(space):
    from dataclasses import replace

    dealt = [replace(space, counts=space.counts.repartition(n), features=space.features.repartition(n)) for n in (2, 7)]
    clustered = [models.train_clusters(s, k=K, max_iter=3)[1] for s in dealt]
    topical = [models.train_topics(s, k=K, max_iter=3)[1].select("id", "title", "topic") for s in dealt]
    for first, second in (clustered, topical):
        assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()


def test_vocabulary_cut_off_keeps_the_order_of_ties(spark):
    texts = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)) for n in range(1, 301)]
    docs = spark.createDataFrame([(i, "t", text) for i, text in enumerate(texts)], "id int, title string, text string")
    whole = features.build_vocabulary(docs, min_df=1, max_df=1000).words
    for size in (1, 7, 64, 200):
        assert features.build_vocabulary(docs, vocab_size=size, min_df=1, max_df=1000).words == whole[:size]


def test_unicode_tokens(spark):
    from pageloom.functions import tokens as tk

    docs = spark.createDataFrame([(1, "t", "élan élan города")], "id int, title string, text string")
    found = features.term_arrays(docs, [], tk.UNICODE_LETTERS).first()
    assert found.tokens == ["élan", "élan", "города"]


ODD_TEXTS = [
    "İstanbul élan Kelvin abc\x00def UPPER the of ab zz zzz abc abc", "", "a bc", "x" * 50, "über alles über ALLES alles", "ΣΑΣ abc abc the abc def",
    None, "abc", "abc def", "def", " abc  def\nabc\tdef ", "日本abc日本def",
]


def test_words_split_over_many_texts_equal_the_text_stages(spark, monkeypatch):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizerModel

    docs = spark.createDataFrame([(i, "t", text) for i, text in enumerate(ODD_TEXTS)], "id long, title string, text string").coalesce(1)
    texts = docs.where("text is not null")
    terms = features.term_arrays(texts).select("id", F.explode("terms").alias("term"))
    expected = {r.term: (r.n, r.df) for r in terms.groupBy("term").agg(F.count("*").alias("n"), F.countDistinct("id").alias("df")).collect()}
    words = sorted(expected, reverse=True)[1:]
    stages = [*features.text_stages(), CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="tf")]
    vectors = {r.id: r.tf for r in PipelineModel(stages).transform(texts).collect()}
    for at_once in (8_000_000, 16, 1):
        monkeypatch.setattr(features, "BYTES_AT_ONCE", at_once)
        found = {r.term: (r.total_count, r.doc_freq) for r in features.term_statistics(docs).collect()}
        assert found.pop(None)[1] == len(ODD_TEXTS) - 1 and found == expected
        assert {r.id: r.tf for r in features.count_vectors(texts, words).collect()} == vectors


def test_saved_text_stages_are_told_from_others(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizerModel

    texts = [(i, "t", text) for i, text in enumerate(ODD_TEXTS) if text is not None]
    docs = spark.createDataFrame(texts, "id long, title string, text string")
    for name, stages, own in (
        ("own", features.text_stages(), True),
        ("stop", features.text_stages(["ABC"]), True),
        ("long", features.text_stages(min_length=1), True),
        ("unicode", features.text_stages(separator=r"[^\p{L}]+"), True),
        ("cased", [features.text_stages()[0].copy().setToLowercase(False), *features.text_stages()[1:]], False),
    ):
        words = ["abc", "abc abc", "def", "alles", "über", "bc"]
        model = PipelineModel([*stages, CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="tf")])
        write_model(model, f"{tmp_path}/{name}")
        saved = models.load_model(f"{tmp_path}/{name}")
        assert models._own_text_stages(saved.stages) is own
        scored = {r.id: r.tf for r in models.score(docs, f"{tmp_path}/{name}").collect()}
        assert scored == {r.id: r.tf for r in model.transform(docs).collect()}


def test_clusters_train_on_their_own_number_of_partitions(spark, space, monkeypatch):
    seen = []

    class Watched(models.BisectingKMeans):
        def fit(self, dataset):
            seen.append(dataset.rdd.getNumPartitions())
            return super().fit(dataset)

    monkeypatch.setattr(models, "BisectingKMeans", Watched)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        models.train_clusters(space, k=K, max_iter=1, partitions=5)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen == [5]
