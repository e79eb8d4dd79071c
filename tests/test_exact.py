"""Exact percentiles, nested markup and the sketch-pruned vocabulary against plain Python."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from pageloom.functions.nesting import LINK, MEDIA, TEMPLATE, without_nested
from pageloom.functions.wikitext import clean_nested
from pageloom.operators import features, sketches
from pageloom.operators.percentiles import discrete_rank, exact_percentiles

SHARES = [0.0, 0.1, 0.25, 0.5, 0.9, 0.99, 1.0]


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_percentiles_are_those_of_the_sorted_column(spark, accuracy):
    rng = random.Random(accuracy)
    rows = [(rng.choice([1, 2, 2, 2, 3, 10**12, -5, None]), rng.choice([float("nan"), None, 0.0, -0.0, -1.5, 1e300, 1e-300, rng.random()])) for _ in range(900)]
    df = spark.createDataFrame(rows, "a long, b double").repartition(3)
    found = exact_percentiles(df, {"a": SHARES, "b": SHARES}, accuracy)
    for place, name in enumerate("ab"):
        values = sorted(r[place] for r in rows if r[place] is not None and r[place] == r[place])
        assert found[name] == [values[discrete_rank(len(values), share) - 1] for share in SHARES]


def test_percentiles_of_distinct_values_take_few_passes(spark):
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("v")).cache()
    values = sorted(i * 7919 % 200_003 for i in range(200_000))
    found = exact_percentiles(df, {"v": [0.5, 0.999]}, accuracy=500)["v"]
    assert found == [values[discrete_rank(200_000, s) - 1] for s in (0.5, 0.999)]
    df.unpersist()


def test_percentiles_of_nothing(spark):
    empty = spark.createDataFrame([(None, float("nan"))], "a long, b double")
    assert exact_percentiles(empty, {"a": [0.5], "b": [0.5]}) == {"a": [None], "b": [None]}


def plain(text, pair=TEMPLATE, begins=None):
    opening, closing = pair
    parts = re.findall("(?s)(" + re.escape(opening) + "|" + re.escape(closing) + "|[^" + "".join(sorted({"\\" + m[0] for m in pair})) + "]+|.)", text)
    stack, pairs = [], []
    for i, part in enumerate(parts):
        if part == opening:
            stack.append(i)
        elif part == closing and stack:
            pairs.append((stack.pop(), i))
    drop = [False] * len(parts)
    for first, last in pairs:
        if begins is None or re.match(begins, parts[first + 1], re.I):
            drop[first : last + 1] = [True] * (last + 1 - first)
    return "".join(p for p, d in zip(parts, drop) if not d)


@pytest.mark.parametrize("pair,begins", [(TEMPLATE, None), (LINK, None), (LINK, r"\s*(?:category|file|image):")])
def test_nested_pairs_of_any_depth(spark, pair, begins):
    rng = random.Random(len(pair[0]) + bool(begins))
    opening, closing = pair
    alphabet = [opening, closing, opening[0], closing[0], "x", " File:a", "file:", "\n"]
    texts = ["", "a", opening * 20 + "x" + closing * 20 + "y", f"a{opening}b{opening}c{closing}d", f"a{closing}{opening}b{closing}c{opening}", None]
    texts += ["".join(rng.choices(alphabet, k=rng.randrange(50))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    found = {r.i: r.o for r in df.select("i", without_nested(F.col("t"), pair, MEDIA if begins else None).alias("o")).collect()}
    assert all(found[i] == (None if t is None else plain(t, pair, begins)) for i, t in enumerate(texts))


def test_very_many_delimiters(spark):
    text = "{{a {{b}} " * 5_000 + "}} x " * 5_000
    assert spark.createDataFrame([(text,)], "t string").select(without_nested(F.col("t"))).first()[0] == plain(text)


def test_nested_cleaning(spark):
    text = "{{Box|{{a|{{b}}}}}} One [[File:x.jpg|see [[Beta]] and [[Image:q|[[z]]]] y]]two [[Alpha|three]] {{open"
    assert spark.createDataFrame([(text,)], "t string").select(clean_nested(F.col("t"))).first()[0] == "One two three {{open"
    assert spark.createDataFrame([(None,)], "t string").select(clean_nested(F.col("t"))).first()[0] == ""


def test_the_sketch_loses_no_frequent_value(spark):
    rng = random.Random(3)
    rows = [(i, [f"w{int(rng.paretovariate(0.7))}" for _ in range(30)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, terms array<string>").repartition(4)
    counts = {}
    for _, terms in rows:
        for term in set(terms):
            counts[term] = counts.get(term, 0) + 1
    words = spark.createDataFrame([(w,) for w in counts], "w string")
    for buckets in (64, 1 << 12, 1 << 16):
        keep = sketches.frequent_enough(df, "terms", 20, buckets)
        passed = {r.w for r in words.where(keep(F.col("w"))).collect()}
        assert {w for w, n in counts.items() if n >= 20} <= passed
    assert len(passed) < 1.1 * sum(n >= 20 for n in counts.values()) + 5  # the widest sketch lets next to no rare one through


def test_the_pruned_vocabulary_is_the_same(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), F.lit("t").alias("title"), "text")
    plain_, pruned = (features.build_vocabulary(docs, min_df=5, sketch_buckets=n) for n in (0, 1 << 18))
    assert plain_.words == pruned.words and plain_.n_docs == pruned.n_docs
    assert sorted(map(tuple, plain_.terms.collect())) == sorted(map(tuple, pruned.terms.collect()))
    assert features.build_vocabulary(docs, min_df=0.01, sketch_buckets=64).words == features.build_vocabulary(docs, min_df=0.01).words


def test_terms_are_counted_by_runs_of_documents(spark, monkeypatch):
    texts = [("abc def,abc,def",), ("",), (None,), ("abc def ghi,jkl mno,abc,def ghi",), ("the",), ("zebra",), ("zebra,zebra,zebra,zebra",)]
    docs = spark.createDataFrame(texts, "text string").coalesce(1)
    for at_once in (1, 3, 2_000_000):
        monkeypatch.setattr(features, "TOKENS_AT_ONCE", at_once)
        for separator in (",", "[^a-z]+"):  # with a comma a token can look like a bigram
            terms = features.term_arrays(docs, separator=separator).where("terms IS NOT NULL").select("terms")
            total = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("total_count"))
            seen = terms.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("doc_freq"))
            expected = {tuple(row) for row in total.join(seen, "term").collect()} | {(None, 0, 6)}
            assert {tuple(row) for row in features.term_statistics(docs, separator).collect()} == expected
        counts = features.partial_term_counts(docs.limit(4), ",").where("term IS NOT NULL")
    # One row of each term and run, not one of each occurrence.
    assert counts.count() == counts.select("term").distinct().count()
    keep = sketches.frequent_enough(counts, "term", 2, 1 << 12, counts="doc_freq")
    assert {row.term for row in counts.where(keep(F.col("term"))).collect()} == {row.term for row in counts.where("doc_freq >= 2").collect()}
