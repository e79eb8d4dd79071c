"""Block names, spelling groups and the bit-sliced whitening against brute force, odd rows included."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import bit_scatter, block_names, frequency_trie
from pageloom.llm.texts import importable, lower_ascii

DOCS = "doc_id long, text string, kept string, name long"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


# --- exact copies ------------------------------------------------------------


def brute_copies(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower_ascii(text or "")].append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        digest = hashlib.sha256(text.encode()).hexdigest()
        ids = sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True)
        for place, doc_id in enumerate(ids):
            out[(doc_id, ids[0], len(ids), place == 0, digest)] += 1
    return out


def copies(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3)
    found = block_names.exact_copies(docs, **options)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return Counter(tuple(r) for r in found.collect())


@pytest.mark.parametrize("block_bytes", [3, 8, 4096])
def test_copies_equal_a_plain_grouping(spark, block_bytes):
    rng = random.Random(block_bytes)
    texts = ["", None, "a", "A", "Ä", "ä", "ab", "abc", "abcd", "ABCDE", "abcabc", "abcabcabc", "x" * 200, "x" * 199, "X" * 200 + "y", "é" * 40]
    texts += ["".join(rng.choices("abAB", k=rng.randrange(1, 30))) for _ in range(60)]
    rows = [(i, rng.choice(texts)) for i in range(300)]
    rows += [(None, "a"), (None, "a"), (None, "only nulls"), (None, "ONLY NULLS"), (7, "b"), (7, "b"), (7, "c")]
    assert copies(spark, rows, block_bytes=block_bytes) == brute_copies(rows)


def test_texts_that_share_blocks_stay_apart(spark):
    """Same blocks in another order, another number, or with another end."""
    a, b = "a" * 4, "b" * 4
    rows = list(enumerate([a + b, b + a, a + a + b, a + b + a, a, a + a, a + a + a, a + a + a + a, a + b, a + "b", a + "b" * 5]))
    assert copies(spark, rows, block_bytes=4) == brute_copies(rows)


def test_a_very_long_text_and_a_hot_one(spark):
    long = "lorem ipsum " * 100_000
    rows = [(1, long), (2, long.upper()), (3, long + "x"), (4, "x" + long)] + [(10 + i, "hot") for i in range(400)]
    assert copies(spark, rows) == brute_copies(rows)


def test_no_documents_no_copies(spark):
    assert copies(spark, []) == Counter()


def test_names_are_dense_and_of_one_key_each(spark):
    keys = [b"b", b"a", b"", b"ab", b"\xff", b"a", b"b"]
    rows = spark.createDataFrame([(i % 2, i, bytearray(k)) for i, k in enumerate(keys)], "slice long, place int, key binary")
    found = {r.place: r.name for r in block_names.sorted_names(rows).collect()}
    assert len({(found[i], k) for i, k in enumerate(keys)}) == len(set(keys)) == len(set(found.values()))
    assert sorted(set(found.values())) == list(range(len(set(keys))))


# --- spelling groups ---------------------------------------------------------


def brute_words(rows, shortest=7, least=2, loses=31):
    import re

    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            word = run[:at] + run[at + 1 :] if h % loses == 0 else run
            if len(word) >= shortest:
                seen[word] += 1
    return {w: n for w, n in seen.items() if n >= least}


def plain_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, ratio=10):
    near = defaultdict(list)
    for a, b in combinations(counts, 2):
        if plain_edit(a, b):
            near[a].append(b)
            near[b].append(a)
    form = {}
    for word in counts:
        best = min(near[word], key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= ratio * counts[word] else None
    out = set()
    for word, n in counts.items():
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, n, len(near[word]), counts[form[word]] if form[word] else None))
    return out


def grouped(spark, counts, **options):
    words = spark.createDataFrame([(w, n, "x") for w, n in counts.items()], "word string, n long, near string").repartition(3)
    rows = frequency_trie.spelling_groups(words, **options).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(rows) == len(counts)
    return {tuple(r) for r in rows}


def some_words(seed, n=300, letters="abcdéÿ"):
    rng = random.Random(seed)
    words = {"".join(rng.choices(letters, k=rng.randrange(1, 9))): 0 for _ in range(n)}
    for word in list(words)[: n // 3]:
        at = rng.randrange(len(word))
        words[word[:at] + rng.choice(letters) + word[at + rng.randrange(2) :]] = 0
    return {w: 10 ** rng.randrange(4) + rng.randrange(3) for w in words if w}


@pytest.mark.parametrize("options", [{}, {"groups": 3, "most_words": 40}, {"groups": 2, "most_words": 5}, {"groups": 1}, {"groups": 30, "most_words": 1000}])
def test_groups_equal_brute_force(spark, options):
    counts = some_words(len(options) + options.get("groups", 0))
    assert grouped(spark, counts, **options) == brute_groups(counts)


def test_long_words_ties_chains_and_odd_letters(spark):
    long = "ab" * 300
    counts = {long: 5, long + "c": 50, "x" + long: 50, long[:-1] + "z": 3}
    counts |= {"chain": 1, "chainx": 10, "chainxy": 100, "chainxyz": 1000, "chainxyzz": 10_000}
    counts |= {"tieda": 1, "tiedb": 10, "tiedc": 10, "w" * 48: 1, "w" * 49: 10, "w" * 50: 100, "\U0001f600ab": 1, "\U0001f600b": 10, "šab": 1, "šbb": 20}
    found = grouped(spark, counts)
    assert found == brute_groups(counts)
    assert ("chain", "chainx", "chainxyzz", 1, 1, 10) in found


def test_words_are_counted_as_stated(spark):
    rng = random.Random(5)
    vocabulary = ["Straßenbau", "ÄPFELKUCHEN", "abcdefg", "abcdef", "großartig×x", "ABCDEFGHIJ", "wordword", "x" * 70]
    rows = [(i, " ".join(rng.choices(vocabulary, k=40)) + ".1") for i in range(120)] + [(None, "wordword wordword"), (5, None), (6, ""), (7, "123"), (5, "abcdefg")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS)
    found = {r.word: r.n for r in frequency_trie.counted_words(docs).collect()}
    assert found == brute_words(rows)
    assert any(len(w) == 69 for w in found)


def test_no_words_no_groups(spark):
    assert grouped(spark, {}) == set()
    assert frequency_trie.spelling_groups(spark.createDataFrame([(None, 3)], "word string, n long")).isEmpty()


def test_one_edit_and_the_matrices_agree():
    rng = random.Random(1)
    words = ["".join(rng.choices("ab", k=rng.randrange(1, 7))) for _ in range(80)] + ["a" * 47, "a" * 48, "a" * 49, "a" * 50, "a" * 47 + "b"]
    letters = frequency_trie._Letters(words)
    i, j = (x.ravel() for x in np.indices((len(words), len(words))))
    found = frequency_trie._near(letters, i, letters, j)
    assert found.tolist() == [plain_edit(words[a], words[b]) for a, b in zip(i, j)]
    assert all(frequency_trie.one_edit(words[a], words[b]) == plain_edit(words[a], words[b]) for a, b in zip(i, j))


# --- whitening ---------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, n string"


def test_cross_products_are_exact():
    rng = np.random.default_rng(0)
    for low, high, rows in ((0, 2, 1), (-5, 5, 64), (-1000, 1000, 65), (-(1 << 40), 1 << 40, 200), (-(1 << 61), 1 << 61, 10)):
        points = rng.integers(low, high, (rows, 5))
        points[:, 2] = 7  # constant
        wide = np.hstack([points, np.ones((rows, 1), np.int64)]).astype(object)
        assert (bit_scatter.cross_products(points) == wide.T @ wide).all()


def brute_whitening(rows, components=16):
    points = {}
    for key, vector in rows:
        if vector and all(v is not None and np.isfinite(v) for v in vector):
            points[key] = tuple(int(np.floor(64 * float(np.float32(v)))) + 1_000_000 for v in vector)
    fit = np.array(sorted(set(points.values())), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums).astype(float) / n
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    best = np.argsort(-values)[:components]
    return points, n, sums, values[best], axes[:, best], np.trace(covariance)


@pytest.mark.parametrize("width,rows", [(5, 60), (24, 400)])
def test_whitening_equals_a_dense_one(spark, width, rows):
    rng = np.random.default_rng(width)
    data = (rng.normal(size=(rows, width)) @ rng.normal(size=(width, width)) * 0.2).astype(np.float32)
    table = [(i, [float(v) for v in data[i % (rows - 5)]]) for i in range(rows)]
    table += [(9001, None), (9002, [None] * width), (9003, [float("nan")] * width), (9004, [float("inf")] * width), (9005, []), (9006, [1.0])]
    found = bit_scatter.whiten(spark.createDataFrame([(k, v, "x") for k, v in table], VECTORS).repartition(3)).collect()
    points, n, sums, values, axes, trace = brute_whitening([r for r in table if r[0] != 9006])
    count = min(16, width)
    assert len(found) == len(points) * count
    assert {r.vec_id for r in found} == set(points)
    white = np.zeros((rows, count))
    for r in found:
        assert r.n == n and r.deviation == sum((n * x - s) ** 2 for x, s in zip(points[r.vec_id], sums))
        assert abs(r.explained - values[r.component - 1] / trace) < 1e-9 and r.identity_error < 1e-9
        white[r.vec_id, r.component - 1] = r.whitened
    plain = np.array([[(n * x - s) / n for x, s in zip(points[i], sums)] for i in range(rows)]) @ axes / np.sqrt(values)
    signs = np.sign((white * plain).sum(axis=0))
    assert np.abs(white - plain * signs).max() < 1e-6


def test_directions_without_variance_are_null(spark):
    rows = [(i, [float(i % 4), 2.0 * (i % 4), 3.0], "x") for i in range(9)]
    found = bit_scatter.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(found) == 27 and {r.n for r in found} == {4}
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert all(r.explained == (1.0 if r.component == 1 else 0.0) for r in found if r.component != 1) and all(abs(r.explained - 1) < 1e-9 for r in found if r.component == 1)
    one = bit_scatter.whiten(spark.createDataFrame([(1, [0.5, 0.25], "x"), (1, [0.5, 0.25], "x"), (None, [0.5, 0.25], "x")], VECTORS)).collect()
    assert len(one) == 6 and all(r.whitened is None and r.deviation == 0 and r.n == 1 for r in one)


def test_far_entries_overflow_to_null(spark):
    rows = [(1, [3e38, 0.0], "x"), (2, [-3e38, 1.0], "x"), (3, [0.0, 2.0], "x")]
    found = bit_scatter.whiten(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(found) == 6 and {r.deviation for r in found if r.vec_id != 3} == {None}
    assert all(np.isfinite(r.whitened) for r in found if r.component == 1)


def test_nothing_to_whiten(spark):
    assert bit_scatter.whiten(spark.createDataFrame([(1, None, "x")], VECTORS)).isEmpty()
    assert bit_scatter.whiten(spark.createDataFrame([], VECTORS)).isEmpty()


def test_the_registered_whitening(spark, sf_dir):
    from pageloom.llm.queries import QUERIES

    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = QUERIES["op13_whitening"](spark, sf_dir)
    points, n, sums, values, _, trace = brute_whitening([tuple(r) for r in rows])
    per = {r.component: r for r in found.groupBy("component").agg(F.max("explained").alias("explained"), F.max("n").alias("n"), F.count("*").alias("rows")).collect()}
    assert all(r.rows == len(points) and r.n == n and abs(r.explained - values[c - 1] / trace) < 1e-6 for c, r in per.items()) and len(per) == 16
