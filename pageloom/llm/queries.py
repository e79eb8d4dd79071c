"""The registered queries of this package: thin digests of its operators on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import benchmark_leaks, bin_completion, bit_scatter, block_names, cross_parsing, cross_polytope, frequency_trie, interpolated_lm, main_text, near_copies, piece_counts, subword_classifier, token_files
from pageloom.llm.oracle import ORACLE_SQL
from pageloom.llm.texts import importable
from pageloom.storage import durable, fresh_path


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "token_files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_files.read_tokens(spark, folder)


def op2_piece_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counter = piece_counts.from_sentencepiece(vocabulary("piece_bpe_32k.model"))
    return piece_counts.count_pieces(table(spark, sf_dir, "documents"), counter)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return subword_classifier.classify(docs, subword_classifier.train(docs, table(spark, sf_dir, "labels")))


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(table(spark, sf_dir, "pages"))


def op5_interpolated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interpolated_lm.score(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = bin_completion.pieces(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return bin_completion.packed(durable(parts, "pieces"))


def op7_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.neighbours(table(spark, sf_dir, "embeddings"))


def op8_minhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents"), shingle=2)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cross_parsing.identify(docs, cross_parsing.train(docs))


def op10_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of document and leaked item with the overlaps; the operator's score is left out, which SQL can't give."""
    found = benchmark_leaks.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    overlaps = [F.round(name, 6).alias(name) for name in ("overlap", "question_overlap", "answer_overlap")]
    return found.select("doc_id", "item_id", *overlaps)


def op11_block_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_names.exact_copies(table(spark, sf_dir, "documents"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency_trie.spelling_groups(frequency_trie.counted_words(table(spark, sf_dir, "documents")))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_scatter.whiten(table(spark, sf_dir, "embeddings"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_piece_counts": op2_piece_counts,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_main_text": op4_main_text,
    "op5_interpolated_lm": op5_interpolated_lm,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_cross_polytope": op7_cross_polytope,
    "op8_minhash_near_copies": op8_minhash_near_copies,
    "op9_language_id": op9_language_id,
    "op10_benchmark_leaks": op10_benchmark_leaks,
    "op11_block_names": op11_block_names,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_whitening": op13_whitening,
}
