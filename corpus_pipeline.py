"""Documents to packed training sequences: five operators of ``pageloom.llm`` in a row.

Each stage takes whole documents and hands on whole documents with all their columns; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from pageloom.llm import benchmark_leaks, bin_completion, cross_parsing, near_copies, subword_classifier
from pageloom.llm.queries import table, vocabulary
from pageloom.llm.texts import fresh_heaps, importable, keep_rows
from pageloom.storage import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in a learned language; ``und`` goes: null, empty, or without a letter.

    Where nothing is learned, because no row has a language, every text with a letter stays.
    """
    importable(spark)
    fresh_heaps(spark)
    model = cross_parsing.train(docs)
    if not model.languages:
        return keep_rows(docs, lambda texts: np.array([cross_parsing.has_letter(text) for text in texts], bool))
    shared = spark.sparkContext.broadcast(model)

    def keep(texts: list[str | None]) -> np.ndarray:
        return np.array([label != cross_parsing.UNDETERMINED for label in cross_parsing.predict(texts, shared.value)[0]], bool)

    return keep_rows(docs, keep)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.3 for the quality label; rows held out of the training keep out of it here too."""
    fresh_heaps(spark)
    model = subword_classifier.train(docs, table(spark, sf_dir, "labels"))
    shared = spark.sparkContext.broadcast((model, model.margins()))

    def keep(texts: list[str | None]) -> np.ndarray:
        own, margins = shared.value
        return own.score([t or "" for t in texts], margins) >= subword_classifier.THRESHOLD

    return keep_rows(docs, keep, limit=subword_classifier.SLICE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8): the least id, of its texts the one with the least hash."""
    importable(spark)
    fresh_heaps(spark)
    return near_copies.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    fresh_heaps(spark)
    return benchmark_leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids: one row for each piece of a document with its place."""
    importable(spark)
    fresh_heaps(spark)
    parts = bin_completion.pieces(docs, vocabulary("word_bpe_49k.json"), end_id=1)
    return bin_completion.packed(durable(parts, "pieces"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", pack),
]
#: No SQL: learned models, tokenizer ids and packing. The tests hold the result against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
