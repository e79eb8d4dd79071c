"""Terms, vocabulary, IDF and TF-IDF features of documents."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    IDFModel,
    NGram,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions import tokens as tk
from pageloom.operators.sketches import frequent_enough
from pageloom.operators.skew import broadcast_if_small
from pageloom.storage import DENSE, durable

VOCAB_SIZE = 50_000
MIN_DF = 20
MAX_DF = 0.6
MIN_DOC_FREQ = 10
# Tokens that a task counts at once, which bounds its memory.
TOKENS_AT_ONCE = 2_000_000
# Bytes of text that a task splits at once.
BYTES_AT_ONCE = 8_000_000

# Parquet holds an ML vector as this struct; a sparse one fills indices and values.
SPARSE_VECTOR = "struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"


def term_arrays(docs: DataFrame, stop_words: list[str] | None = None, separator: str = tk.LETTERS_ONLY) -> DataFrame:
    """Documents with ``tokens_raw, tokens, bigrams, terms`` as native array columns.

    ``tokens.UNICODE_LETTERS`` as ``separator`` keeps letters of every script.
    """
    words = tk.extended_stop_words() if stop_words is None else stop_words
    return (
        docs.withColumn("tokens_raw", tk.tokens(F.col("text"), separator))
        .withColumn("tokens", tk.without_stop_words(F.col("tokens_raw"), words))
        .withColumn("bigrams", tk.bigrams(F.col("tokens")))
        .withColumn("terms", F.concat("tokens", "bigrams"))
    )


def text_stages(stop_words: list[str] | None = None, separator: str = tk.LETTERS_ONLY, min_length: int = tk.MIN_TOKEN_LENGTH) -> list:
    """The same arrays as ML stages, to be saved inside a model."""
    words = tk.extended_stop_words() if stop_words is None else stop_words
    return [
        RegexTokenizer(
            inputCol="text",
            outputCol="tokens_raw",
            pattern=separator,
            toLowercase=True,
            minTokenLength=min_length,
        ),
        StopWordsRemover(inputCol="tokens_raw", outputCol="tokens", stopWords=words),
        NGram(n=2, inputCol="tokens", outputCol="bigrams"),
        SQLTransformer(statement="SELECT *, concat(tokens, bigrams) AS terms FROM __THIS__"),
    ]


def _letter_tokenizer(stop_words: list[str], least: int, at_once: int) -> Callable[[pa.Array], Iterator[pa.ListArray]]:
    """Tokens of lower-cased texts, split at all but a to z, over the bytes of many texts at once.

    Gives runs of texts with about ``at_once`` bytes. Workers get it whole, without this package.
    """

    def cut(texts: pa.StringArray) -> pa.ListArray:
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[ends[0] : ends[-1]] if held is not None else np.empty(0, np.uint8)
        ends = ends.astype(np.int64) - ends[0]
        letter = (data - np.uint8(97)) < 26  # bytes of other characters are never letters
        opens, closes = letter.copy(), letter.copy()
        opens[1:] &= ~letter[:-1]
        closes[:-1] &= ~letter[1:]
        inner = ends[(ends > 0) & (ends < len(data))]
        opens[inner] = letter[inner]
        closes[inner - 1] = letter[inner - 1]
        starts = np.flatnonzero(opens)
        sizes = np.flatnonzero(closes) + 1 - starts
        long = sizes >= least
        body = data[letter][np.repeat(long, sizes)]
        starts, sizes = starts[long], sizes[long]
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        words = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(bounds), pa.py_buffer(body))
        kept = ~pc.is_in(words, value_set=pa.array(stop_words, pa.string())).to_numpy(zero_copy_only=False)
        upto = np.concatenate([[0], np.cumsum(kept)])[np.searchsorted(starts, ends)]
        return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), words.filter(pa.array(kept)))

    def run(texts: pa.Array) -> Iterator[pa.ListArray]:
        texts = texts.cast(pa.string())
        upto, start = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)), 0
        while start < len(texts):
            before = int(upto[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(upto, before + at_once, side="right")))
            yield cut(texts.slice(start, end - start))
            start = end

    return run


def _term_counter(
    at_once: int, tokenize: Callable[[pa.Array], Iterator[pa.ListArray]] | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of every run of documents with about ``at_once`` tokens. Workers get it whole, without this package.

    The column holds lists of tokens, or texts that ``tokenize`` turns into them.
    """

    def counted(tokens: pa.ListArray) -> pa.RecordBatch:
        lengths = tokens.value_lengths().to_numpy(zero_copy_only=False)
        encoded = tokens.flatten().dictionary_encode()
        words, codes = encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        inside = doc[:-1] == doc[1:]
        known = max(len(words), 1)
        pairs, pair = np.unique((codes[:-1] * known + codes[1:])[inside], return_inverse=True)
        bigrams = pc.binary_join_element_wise(words.take(pa.array(pairs // known)), words.take(pa.array(pairs % known)), " ")
        # One number for each string, should a token look like a bigram.
        named = pa.concat_arrays([words, bigrams]).dictionary_encode()
        number = named.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        term = np.concatenate([number[codes], number[len(words) + pair]])
        terms = len(named.dictionary)
        once = np.unique(np.concatenate([doc, doc[:-1][inside]]) * max(terms, 1) + term) % max(terms, 1)
        return pa.RecordBatch.from_pydict(
            {
                "term": pa.concat_arrays([named.dictionary, pa.nulls(1, pa.string())]),
                "total_count": np.append(np.bincount(term, minlength=terms), 0).astype(np.int64),
                "doc_freq": np.append(np.bincount(once, minlength=terms), len(lengths)).astype(np.int64),
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        given = (batch.column(0).drop_null() for batch in batches)
        for tokens in given if tokenize is None else chain.from_iterable(map(tokenize, given)):
            ends, start = np.cumsum(tokens.value_lengths().to_numpy(zero_copy_only=False)), 0
            while start < len(tokens):
                before = int(ends[start - 1]) if start else 0
                end = max(start + 1, int(np.searchsorted(ends, before + at_once, side="right")))
                held.append(tokens.slice(start, end - start))
                size, start = size + int(ends[end - 1]) - before, end
                if size >= at_once:
                    yield counted(pa.concat_arrays(held))
                    held, size = [], 0
        if held:
            yield counted(pa.concat_arrays(held))

    return run


def partial_term_counts(docs: DataFrame, separator: str = tk.LETTERS_ONLY) -> DataFrame:
    """``term, total_count, doc_freq`` of runs of documents, made inside the tasks; a null term counts the documents."""
    schema, words = "term string, total_count bigint, doc_freq bigint", tk.extended_stop_words()
    if separator == tk.LETTERS_ONLY:
        tokenize = _letter_tokenizer(words, tk.MIN_TOKEN_LENGTH, BYTES_AT_ONCE)
        return docs.select(F.lower("text").alias("text")).mapInArrow(_term_counter(TOKENS_AT_ONCE, tokenize), schema)
    tokens = tk.without_stop_words(tk.tokens(F.col("text"), separator), words)
    return docs.select(tokens.alias("tokens")).mapInArrow(_term_counter(TOKENS_AT_ONCE), schema)


def _vector_counter(
    terms: list[str], tokenize: Callable[[pa.Array], Iterator[pa.ListArray]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of ``terms`` in texts, the last column, as sparse vectors. Workers get it whole, without this package.

    A term with a blank is a pair of words. Words are numbered, and pairs looked up by both numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [term.split(" ") for term in terms]
        number = {word: i for i, word in enumerate(dict.fromkeys(word for part in parts for word in part))}
        known, words = len(number), pa.array(list(number), pa.string())
        alone = np.full(known + 1, -1, np.int64)  # the last place is that of any other word
        pairs = np.array([number[p[0]] * known + number[p[-1]] if len(p) == 2 else -1 for p in parts], np.int64)
        single = np.flatnonzero(pairs < 0)
        alone[[number[parts[i][0]] for i in single]] = single
        order = np.argsort(pairs, kind="stable")
        pairs = np.append(pairs[order], np.iinfo(np.int64).max)
        order = np.append(order, 0)

        def vectors(tokens: pa.ListArray) -> pa.StructArray:
            n, lengths = len(tokens), tokens.value_lengths().to_numpy(zero_copy_only=False)
            word = pc.fill_null(pc.index_in(tokens.flatten(), value_set=words), known).to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(n), lengths)
            first, second = word[:-1], word[1:]
            both = np.flatnonzero((first < known) & (second < known) & (doc[:-1] == doc[1:]))
            pair = first[both] * known + second[both]
            place = np.searchsorted(pairs, pair)
            hit = pairs[place] == pair
            term = np.concatenate([alone[word], order[place[hit]]])
            doc = np.concatenate([doc, doc[both[hit]]])
            found, count = np.unique(doc[term >= 0] * len(terms) + term[term >= 0], return_counts=True)
            ends = pa.array(np.searchsorted(found, np.arange(n + 1) * len(terms)).astype(np.int32))
            return pa.StructArray.from_arrays(
                [
                    pa.array(np.zeros(n, np.int8)),
                    pa.array(np.full(n, len(terms), np.int32)),
                    pa.ListArray.from_arrays(ends, pa.array((found % len(terms)).astype(np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(count.astype(np.float64))),
                ],
                names=["type", "size", "indices", "values"],
            )

        for batch in batches:
            start = 0
            for tokens in tokenize(batch.column(batch.num_columns - 1)):
                own = batch.slice(start, len(tokens)).columns[:-1]
                yield pa.RecordBatch.from_arrays([*own, vectors(tokens)], names=[*batch.schema.names[:-1], "tf"])
                start += len(tokens)

    return run


def count_vectors(
    docs: DataFrame,
    terms: list[str],
    stop_words: list[str] | None = None,
    separator: str = tk.LETTERS_ONLY,
    min_length: int = tk.MIN_TOKEN_LENGTH,
) -> DataFrame:
    """``id, title, tf`` as the text stages and a vectorizer of ``terms`` give them, in a written table.

    Words of the letters a to z are counted over many texts at once; other separators go through the stages.
    """
    words = tk.extended_stop_words() if stop_words is None else stop_words
    named = [term.split(" ") for term in terms]
    if separator != tk.LETTERS_ONLY or min_length < 1 or any(len(part) > 2 for part in named):
        vectorizer = CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="tf")
        stages = [*text_stages(words, separator, min_length), vectorizer]
        return durable(PipelineModel(stages).transform(docs).select("id", "title", "tf"), "term_counts", codec=DENSE)
    texts = docs.select("id", "title", F.lower("text").alias("text"))
    keys = T.StructType(texts.schema.fields[:2])
    plain = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in keys)
    counted = texts.mapInArrow(_vector_counter(terms, _letter_tokenizer(words, min_length, BYTES_AT_ONCE)), f"{plain}, tf {SPARSE_VECTOR}")
    return durable(counted, "term_counts", T.StructType([*keys.fields, T.StructField("tf", VectorUDT())]), DENSE)


def term_statistics(
    docs: DataFrame,
    separator: str = tk.LETTERS_ONLY,
    keep: Callable[[Column], Column] | None = None,
    partial: DataFrame | None = None,
) -> DataFrame:
    """``term, total_count, doc_freq`` of every term, and a null term that counts the documents.

    Terms are counted by runs of documents first, over numbers instead of strings,
    so a row is made of a term and run, not of each occurrence; nothing is grouped
    by document, and the only shuffle carries counts already summed per task.
    Terms that ``keep`` turns down are left out before it. ``partial`` is a written
    table of the counts by runs, if there is one.
    """
    counted = partial_term_counts(docs, separator) if partial is None else partial
    if keep is not None:
        counted = counted.where(F.col("term").isNull() | keep(F.col("term")))
    return counted.groupBy("term").agg(F.sum("total_count").alias("total_count"), F.sum("doc_freq").alias("doc_freq"))


@dataclass(frozen=True)
class Vocabulary:
    """Terms kept as features, and the number of documents they come from.

    ``terms`` has at most ``vocab_size`` rows, which is what makes broadcasting it safe.
    """

    terms: DataFrame  # term_index, term, total_count, doc_freq
    words: list[str]  # the same terms in index order: the parameter of the vectorizer
    n_docs: int


def build_vocabulary(
    docs: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    separator: str = tk.LETTERS_ONLY,
    sketch_buckets: int = 0,
) -> Vocabulary:
    """The most frequent terms within the document-frequency limits; ties go to the smaller term.

    Limits below 1 are shares of the documents, others are document counts. With
    ``sketch_buckets`` a sketch of that many counters leaves out terms that are
    surely below a ``min_df`` count before anything is shuffled; the vocabulary is
    the same. It pays while the distinct terms of all documents together are fewer
    than ``min_df`` times the buckets.
    """
    spark = docs.sparkSession
    keep = partial = None
    if sketch_buckets and min_df >= 1:
        partial = durable(partial_term_counts(docs, separator), "partial_term_counts")  # read for the sketch and for the sums
        terms = partial.where(F.col("term").isNotNull())
        keep = frequent_enough(terms, "term", math.ceil(min_df), sketch_buckets, counts="doc_freq")
    counted = term_statistics(docs, separator, keep, partial)
    if min_df >= 1:
        counted = counted.where(F.col("term").isNull() | (F.col("doc_freq") >= min_df))
    counted = durable(counted, "term_statistics")

    total = counted.where(F.col("term").isNull()).select("doc_freq").first()
    n_docs = total.doc_freq if total else 0
    least = min_df if min_df >= 1 else min_df * n_docs
    most = max_df if max_df >= 1 else max_df * n_docs
    if least > most:
        raise ValueError(f"min_df {min_df} and max_df {max_df} leave no term for {n_docs} documents")
    fit = counted.where(F.col("term").isNotNull() & F.col("doc_freq").between(least, most))
    kept = _most_frequent(fit, vocab_size).orderBy(F.desc("total_count"), "term").limit(vocab_size).toArrow()
    indexed = kept.add_column(0, "term_index", pa.array(range(kept.num_rows), pa.int32()))
    return Vocabulary(spark.createDataFrame(indexed), kept["term"].to_pylist(), n_docs)


def _most_frequent(terms: DataFrame, size: int) -> DataFrame:
    """The terms that a top ``size`` by count can hold: those above a cut-off that a histogram of the counts gives.

    Counts are told apart to a 64th of a power of two, so the histogram has a
    few thousand rows at most. What is left is the top and the rest of its last
    step, not ``size`` rows from each partition.
    """
    power = F.floor(F.log2("total_count"))
    step = (F.floor(F.col("total_count") / F.pow(F.lit(2.0), power) * 64) + power * 64).cast("bigint")
    stepped = terms.withColumn("step", step)
    rows = stepped.groupBy("step").agg(F.count("*").alias("rows")).orderBy(F.desc("step")).collect()
    passed = 0
    for row in rows:
        passed += row["rows"]
        if passed >= size:
            return stepped.where(F.col("step") >= row["step"]).drop("step")
    return terms


def idf_weights(vocabulary: Vocabulary, min_doc_freq: int = MIN_DOC_FREQ) -> DataFrame:
    """Inverse document frequency per term, 0 for terms in fewer than ``min_doc_freq`` documents."""
    weight = F.log((F.lit(vocabulary.n_docs) + 1) / (F.col("doc_freq") + 1))
    return vocabulary.terms.select(
        "term", "doc_freq", F.when(F.col("doc_freq") >= min_doc_freq, weight).otherwise(0.0).alias("idf")
    )


@dataclass(frozen=True)
class FeatureSpace:
    """Documents vectorized once, shared by every model trained on them."""

    docs: DataFrame  # id, title, text
    vocabulary: Vocabulary
    count_stages: list  # text -> tf
    counts: DataFrame  # id, title, tf; a written table
    weighting: list  # tf -> tfidf -> features
    features: DataFrame  # id, title, features; a written table


def build_feature_space(
    docs: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_df: float = MIN_DF,
    max_df: float = MAX_DF,
    separator: str = tk.LETTERS_ONLY,
    min_doc_freq: int = MIN_DOC_FREQ,
) -> FeatureSpace:
    """Vocabulary, term-count vectors and weighted vectors of the documents.

    The vectors are written as tables, because training passes over them many
    times and tokenizing the texts again on each pass would dominate.
    """
    vocabulary = build_vocabulary(docs, vocab_size, min_df, max_df, separator)
    if not vocabulary.words:
        raise ValueError("the vocabulary is empty: too few documents for min_df")
    vectorizer = CountVectorizerModel.from_vocabulary(vocabulary.words, inputCol="terms", outputCol="tf")
    stages = [*text_stages(separator=separator), vectorizer]
    counts = count_vectors(docs, vocabulary.words, separator=separator)
    weighting = fit_weighting(counts, min_doc_freq)
    weighted = PipelineModel(weighting).transform(counts).select("id", "title", "features")
    return FeatureSpace(docs, vocabulary, stages, counts, weighting, durable(weighted, "features", codec=DENSE))


def fit_weighting(counts: DataFrame, min_doc_freq: int = MIN_DOC_FREQ) -> list:
    """IDF and L2 normalization: tf -> tfidf -> features."""
    idf: IDFModel = IDF(inputCol="tf", outputCol="tfidf", minDocFreq=min_doc_freq).fit(counts)
    return [idf, Normalizer(inputCol="tfidf", outputCol="features", p=2.0)]


def vector_entries(table: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """The non-zero entries of a sparse vector column of a written table, one row each.

    Spark reads vectors as rows only through dense arrays of the vocabulary's
    size; the table's files are read as the struct they hold instead.
    """
    fields = ", ".join(f"{name} {table.schema[name].dataType.simpleString()}" for name in keys)
    plain = table.sparkSession.read.schema(f"{fields}, {column} {SPARSE_VECTOR}").parquet(*table.inputFiles())
    pairs = F.arrays_zip(f"{column}.indices", f"{column}.values")
    entry = plain.select(*keys, F.explode(pairs).alias("entry"))
    return entry.select(*keys, F.col("entry.indices").alias("term_index"), F.col("entry.values").alias("weight"))


def tfidf_features(space: FeatureSpace) -> DataFrame:
    """Normalized TF-IDF weights as ``id, term, weight`` rows, from the written vectors."""
    terms = space.vocabulary.terms.select("term_index", "term")
    return (
        vector_entries(space.features, "features", ["id"])
        .where(F.col("weight") != 0)
        .join(broadcast_if_small(terms), "term_index")
        .select("id", "term", "weight")
    )


def vocabulary_table(spark: SparkSession, words: list[str]) -> DataFrame:
    """``term_index, term`` of a fitted vectorizer."""
    return spark.createDataFrame(pa.table({"term_index": pa.array(range(len(words)), pa.int32()), "term": words}))
