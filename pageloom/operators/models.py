"""Clusters and topics: training, naming, reporting and scoring with saved models."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.ml.clustering import LDA, BisectingKMeans, BisectingKMeansModel, LDAModel
from pyspark.ml.feature import CountVectorizerModel, NGram, RegexTokenizer, SQLTransformer, StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.functions.arrays import argmax, label_from_terms
from pageloom.operators.articles import nlp_docs
from pageloom.operators.features import FeatureSpace, count_vectors, text_stages, vocabulary_table
from pageloom.operators.skew import broadcast_if_small
from pageloom.storage import swept

LABEL_TERMS = 15
REPORT_TERMS = 12
SEED = 42
MAX_ITER = 40
TRAINING_PARTITIONS = 32


def fixed_layout(rows: DataFrame, partitions: int) -> DataFrame:
    """The same rows in the same partitions and order, however the input was dealt.

    Training draws and sums by partition, so the layout is part of the seed.
    """
    return rows.repartition(partitions, "id").sortWithinPartitions("id", "title")


def shuffled_once(rows: DataFrame) -> DataFrame:
    """The same rows in the same partitions and order, whose shuffle serves all jobs that read them.

    A frame is planned and shuffled anew for each job on it; an RDD finds what it has
    shuffled. It is not kept in memory: what reads it often keeps its own form of it.
    """
    spark, frame = rows.sparkSession, rows._jdf
    return DataFrame(spark._jsparkSession.createDataFrame(frame.javaRDD(), frame.schema()), spark)


def _stage(model: PipelineModel, kind: type) -> Model:
    return next(stage for stage in model.stages if isinstance(stage, kind))


def _terms_of(model: PipelineModel, spark) -> DataFrame:
    return vocabulary_table(spark, _stage(model, CountVectorizerModel).vocabulary)


def _labels_from_ranked(ranked: DataFrame, key: str, terms: DataFrame, extra: Callable[[Column], list[Column]]) -> DataFrame:
    """One row per group from its ranked term indices, a label's worth of them."""
    named = ranked.join(terms, "term_index")
    best_first = F.array_sort(F.collect_list(F.struct("rank", "term", "weight")))
    return (
        named.groupBy(key)
        .agg(best_first.alias("best"))
        .select(
            key,
            label_from_terms(F.col("best.term")).alias(f"{key}_name"),
            F.col("best.term").alias("top_terms"),
            *extra(F.col("best")),
        )
    )


# --- clusters ---------------------------------------------------------------


def train_clusters(
    space: FeatureSpace,
    k: int = 10,
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    partitions: int = TRAINING_PARTITIONS,
) -> tuple[PipelineModel, DataFrame]:
    """Bisecting k-means over TF-IDF features: the saved-ready model and ``id, title, cluster``.

    ``partitions`` fixes the training layout, on which the clusters depend; raise it with the data.
    """
    # Not a written table: its files would be dealt into more partitions as they grow, and each round sends a sum of
    # the vocabulary's size from every partition. The fit keeps the vectors itself.
    features = shuffled_once(fixed_layout(space.features, partitions).select("features"))
    with swept(space.features.sparkSession):
        clustering = BisectingKMeans(
            featuresCol="features",
            predictionCol="cluster",
            k=k,
            seed=seed,
            minDivisibleClusterSize=1.0,
            maxIter=max_iter,
        ).fit(features)
    model = PipelineModel([*space.count_stages, *space.weighting, clustering])
    return model, clustering.transform(space.features).select("id", "title", "cluster")


def cluster_labels(model: PipelineModel, spark, n: int = LABEL_TERMS) -> DataFrame:
    """``cluster, cluster_name, top_terms`` from the ``n`` heaviest terms of every centre.

    A centre is as long as the vocabulary, which its size limit bounds.
    """
    centres = _stage(model, BisectingKMeansModel).clusterCenters()
    ends = np.cumsum([0, *map(len, centres)])
    values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(centres)))
    table = spark.createDataFrame(pa.table({"cluster": pa.array(range(len(centres)), pa.int64()), "centre": values}))
    by_weight = Window.partitionBy("cluster").orderBy(F.desc("weight"), "term_index")
    ranked = (
        table.select("cluster", F.posexplode("centre").alias("term_index", "weight"))
        .withColumn("rank", F.row_number().over(by_weight))
        .where(F.col("rank") <= n)
    )
    return _labels_from_ranked(ranked, "cluster", _terms_of(model, spark), lambda best: [])


def group_sizes(assignments: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Documents per cluster or topic with its name, largest first."""
    return (
        assignments.groupBy(key)
        .agg(F.count("*").alias("count"))
        .join(labels.select(key, f"{key}_name"), key, "left")
        .orderBy(F.desc("count"), key)
        .select(key, f"{key}_name", "count")
    )


def with_labels(assignments: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Every assignment with the name of its cluster or topic, if it has one."""
    return assignments.join(broadcast_if_small(labels.select(key, f"{key}_name")), key, "left")


def top_terms_report(labels: DataFrame, key: str, n: int = REPORT_TERMS) -> DataFrame:
    return labels.select(key, f"{key}_name", F.slice("top_terms", 1, n).alias("top_terms")).orderBy(key)


# --- topics -----------------------------------------------------------------


def train_topics(
    space: FeatureSpace,
    k: int = 10,
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    partitions: int = TRAINING_PARTITIONS,
) -> tuple[PipelineModel, DataFrame]:
    """Online LDA over term counts: the saved-ready model and ``id, title, topic, topic_distribution``.

    ``partitions`` fixes the training layout, on which the topics depend; raise it with the data.
    """
    counts = fixed_layout(space.counts, partitions).select("tf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with swept(space.counts.sparkSession):
            lda = LDA(
                k=k,
                maxIter=max_iter,
                featuresCol="tf",
                seed=seed,
                optimizer="online",
                topicDistributionCol="topic_distribution",
            ).fit(counts)
    finally:
        counts.unpersist()
    model = PipelineModel([*space.count_stages, lda])
    return model, topic_assignments(lda.transform(space.counts))


def topic_assignments(scored: DataFrame) -> DataFrame:
    """Dominant topic and the distribution as a plain array."""
    distribution = scored.select("id", "title", vector_to_array("topic_distribution").alias("topic_distribution"))
    return distribution.select("id", "title", argmax(F.col("topic_distribution")).alias("topic"), "topic_distribution")


def topic_labels(model: PipelineModel, spark, n: int = LABEL_TERMS) -> DataFrame:
    """``topic, topic_name, top_terms, term_weights`` from the ``n`` heaviest terms of every topic."""
    described = _stage(model, LDAModel).describeTopics(n)
    entry = F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("rank", "entry")
    ranked = described.select(F.col("topic").cast("bigint").alias("topic"), entry).select(
        "topic", "rank", F.col("entry.termIndices").alias("term_index"), F.col("entry.termWeights").alias("weight")
    )
    return _labels_from_ranked(
        ranked, "topic", _terms_of(model, spark), lambda best: [best["weight"].alias("term_weights")]
    )


def top_topics(distributions: DataFrame, labels: DataFrame, n: int = 3) -> DataFrame:
    """The n heaviest topics of every document; the lower topic wins a tie.

    Each distribution is cut to its n heaviest inside the row, which cannot lose
    one of the n heaviest of the document, so the ranking by id sorts and
    shuffles n rows per distribution instead of all k.
    """
    weighted = F.transform(
        "topic_distribution",
        lambda weight, position: F.struct((-weight).alias("order"), position.alias("topic"), weight.alias("weight")),
    )
    heaviest = distributions.select("id", "title", F.inline(F.slice(F.array_sort(weighted), 1, n)))
    by_weight = Window.partitionBy("id").orderBy("order", "topic", "title")
    ranked = heaviest.withColumn("topic_rank", F.row_number().over(by_weight)).where(F.col("topic_rank") <= n)
    return with_labels(ranked, labels, "topic").select(
        F.col("id").cast("bigint").alias("id"),
        F.col("title").cast("string").alias("title"),
        F.col("topic").cast("int").alias("topic"),
        "topic_name",
        F.col("weight").cast("double").alias("topic_weight"),
        "topic_rank",
    )


# --- scoring with saved models ----------------------------------------------


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _saved_labels(pages: DataFrame, path: str, key: str) -> DataFrame:
    return pages.sparkSession.read.parquet(path).select(key, f"{key}_name")


def _own_text_stages(stages: list) -> bool:
    """Whether a saved model begins with the text stages of this package and a vectorizer of plain counts."""
    if [type(stage) for stage in stages[:5]] != [RegexTokenizer, StopWordsRemover, NGram, SQLTransformer, CountVectorizerModel]:
        return False
    named = lambda stage: {param.name: value for param, value in stage.extractParamMap().items()}
    tokenizer, remover, vectorizer = stages[0], stages[1], stages[4]
    expected = text_stages(remover.getStopWords(), tokenizer.getPattern(), tokenizer.getMinTokenLength())
    counts = (vectorizer.getInputCol(), vectorizer.getOutputCol(), vectorizer.getMinTF(), vectorizer.getBinary()) == ("terms", "tf", 1.0, False)
    return counts and all(named(own) == named(stage) for own, stage in zip(expected, stages[:4], strict=True))


def score(docs: DataFrame, model_path: str) -> DataFrame:
    """Documents under a saved model. Its own text stages are applied by ``count_vectors``, any others one by one."""
    model = load_model(model_path)
    if not _own_text_stages(model.stages):
        return model.transform(docs)
    tokenizer, remover, _, _, vectorizer, *rest = model.stages
    words = [word.lower() for word in remover.getStopWords()]
    counts = count_vectors(docs, vectorizer.vocabulary, words, tokenizer.getPattern(), tokenizer.getMinTokenLength())
    return PipelineModel(rest).transform(counts)


def predict_clusters(pages: DataFrame, model_path: str, labels_path: str | None = None) -> DataFrame:
    """Clusters of new parsed pages under a saved model."""
    scored = score(nlp_docs(pages), model_path)
    found = scored.select("id", "title", F.col("cluster").cast("int").alias("cluster"))
    return with_labels(found, _saved_labels(pages, labels_path, "cluster"), "cluster") if labels_path else found


def predict_topics(pages: DataFrame, model_path: str, labels_path: str | None = None) -> DataFrame:
    """Dominant topics of new parsed pages under a saved model."""
    found = topic_assignments(score(nlp_docs(pages), model_path))
    return with_labels(found, _saved_labels(pages, labels_path, "topic"), "topic") if labels_path else found
