"""Arrays, titles and tokens."""

from __future__ import annotations

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pageloom.functions import arrays, titles, tokens
from pageloom.operators.features import term_arrays, text_stages


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression(F.col("v")).alias("r")).first().r


def test_clean_array(spark):
    values = [" a ", "b", None, "", "  ", "a", " 12 "]
    assert one(spark, values, "array<string>", arrays.clean_array) == ["a", "b", "12"]


@pytest.mark.parametrize(
    "terms,label",
    [
        (["a_b", "c", "d", "e"], "a b / c / d"),
        (["_", " ", "x"], "x"),
        ([], "(unlabeled)"),
        (None, "(unlabeled)"),
        ([None, "y"], "y"),
    ],
)
def test_label_from_terms(spark, terms, label):
    assert one(spark, terms, "array<string>", arrays.label_from_terms) == label


def test_argmax_takes_the_first_of_equals(spark):
    assert one(spark, [0.2, 0.4, 0.4], "array<double>", arrays.argmax) == 1


@pytest.mark.parametrize(
    "title,norm",
    [("  New_York__City ", "new york city"), ("A \t B", "a b"), ("_Foo", " foo"), (None, None), ("", "")],
)
def test_norm_title(spark, title, norm):
    assert one(spark, title, "string", titles.norm_title) == norm


@pytest.mark.parametrize("text,kept", [(" a ", "a"), ("   ", None), ("", None), (None, None)])
def test_non_empty(spark, text, kept):
    assert one(spark, text, "string", titles.non_empty) == kept


def test_node_ids_are_negative_hashes(spark):
    names = spark.range(5000).select(F.concat(F.lit("Category:"), F.col("id").cast("string")).alias("t"))
    ids = names.select(
        titles.stable_node_id("category", F.col("t")).alias("id"),
        F.xxhash64(F.concat(F.lit("category:"), F.col("t"))).alias("hash"),
    )
    row = ids.agg(
        F.count_distinct("id").alias("ids"),
        F.max("id").alias("largest"),
        F.count_if(F.col("id") != -F.abs("hash")).alias("off"),
    ).first()
    assert row.ids == 5000 and row.largest < 0 and row.off == 0


def test_tokens_are_ascii_unless_asked(spark):
    text = "Café naïve Über_x ABC ab"
    assert one(spark, text, "string", tokens.tokens) == ["caf", "ber", "abc"]
    assert one(spark, text, "string", lambda t: tokens.tokens(t, tokens.WORDS)) == ["caf", "ber_x", "abc"]
    assert one(spark, text, "string", lambda t: tokens.tokens(t, tokens.UNICODE_LETTERS)) == [
        "café", "naïve", "über", "abc",
    ]


def test_stop_words(spark):
    words = tokens.extended_stop_words()
    assert words == sorted(set(words)) and {"the", "census", "thumb"} <= set(words)
    kept = one(spark, ["the", "cat", "cat", "film"], "array<string>", lambda t: tokens.without_stop_words(t, words))
    assert kept == ["cat", "cat"]


@pytest.mark.parametrize("given,pairs", [(["a", "b", "c"], ["a b", "b c"]), (["a"], []), ([], [])])
def test_bigrams(spark, given, pairs):
    assert one(spark, given, "array<string>", tokens.bigrams) == pairs


def test_native_arrays_equal_the_saved_stages(spark, pages):
    docs = pages.select("id", "text")
    columns = ["id", "tokens_raw", "tokens", "bigrams", "terms"]
    native = term_arrays(docs).select(columns)
    staged = PipelineModel(text_stages()).transform(docs).select(columns)
    assert native.exceptAll(staged).isEmpty() and staged.exceptAll(native).isEmpty()
    assert native.count() == docs.count()
