"""The pipeline stage by stage, each held against what it has to decide."""

from __future__ import annotations

import importlib

import pyarrow.parquet as pq
import pytest
from test_llm_operators import EDGE_SCHEMA, LONG, brute_components, brute_leaks, check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from pageloom.llm.queries import vocabulary
from pageloom.llm.texts import fold
from pageloom.storage import durable


def texts_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"test_{name}")
        out[name] = docs
    return out


def test_stages_keep_the_columns(stages):
    *first, _ = stages
    assert all(stages[name].columns == stages["documents"].columns for name in first)


def test_language_keeps_clean_documents(stages):
    assert texts_of(stages["language_id"]) == texts_of(stages["documents"])


def test_quality_drops_junk(stages, sf_dir):
    before, after = texts_of(stages["language_id"]), texts_of(stages["quality_classifier"])
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{sf_dir}/labels.parquet").to_pylist()}
    good = [k in after for k in before if labels.get(k) == 1]
    bad = [k in after for k in before if labels.get(k) == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_one_of_each_group_stays(stages):
    before, after = texts_of(stages["quality_classifier"]), texts_of(stages["minhash_near_dedup"])
    assert set(after) == {least for _, least in brute_components(before, 5).values()}


def test_leaking_documents_go(stages, sf_dir):
    before, after = texts_of(stages["minhash_near_dedup"]), texts_of(stages["benchmark_decontamination"])
    items = {r["item_id"]: r["text"] for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()}
    assert set(before) - set(after) == {k for k, _ in brute_leaks(before, items)}


def test_all_that_is_left_is_packed(spark, stages, sf_dir):
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    left = texts_of(stages["benchmark_decontamination"])
    check_packing(stages["best_fit_packing"].collect(), {k: [*library.encode(t, add_special_tokens=False).ids, 1] for k, t in left.items()})
    assert corpus_pipeline.run(spark, sf_dir).count() == stages["best_fit_packing"].count()


def test_odd_rows_run_through(spark, sf_dir):
    learned, other = [i for i in range(4, 60) if fold(i, 3) != 1][:2]
    rows = [("a", 1, None), ("b", 2, ""), ("c", None, "It is as it was of old."), ("d", 3, "12 34"), ("e", learned, LONG), ("f", learned, LONG), ("g", other, "And the other one.")]
    docs = spark.createDataFrame([(n, i, t, "en", 1, "s", "k", "t") for n, i, t in rows], EDGE_SCHEMA)
    kept = corpus_pipeline.language_id(spark, docs, sf_dir)
    assert sorted(r.node for r in kept.collect()) == ["c", "e", "f", "g"]
    single = corpus_pipeline.near_dedup(spark, kept, sf_dir)
    assert sorted(r.node for r in single.collect())[0] == "c" and single.count() == 3
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).isEmpty()


def test_the_contract_lists_all(spark):
    contract = importlib.import_module("__spark_entry__")
    names = contract.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))


def test_one_row_of_each_group_stays_however_ids_repeat(spark):
    one, other = "alpha beta gamma delta epsilon zeta eta theta", "iota kappa lambda mu nu xi omicron pi rho"
    near = " ".join([one] * 4) + " end"

    def left(rows):
        docs = spark.createDataFrame([(str(n), i, t, "en", 1, "s", "k", "t") for n, (i, t) in enumerate(rows)], EDGE_SCHEMA)
        return sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect())

    assert left([(1, one), (2, one), (2, other)]) == [(1, one), (2, other)]
    assert left([(1, one), (1, other), (2, other), (0, one)]) == [(0, one), (1, other)]
    assert left([(3, one), (3, one), (3, one)]) == [(3, one)]
    assert left([(4, near), (4, near + " x")]) in ([(4, near)], [(4, near + " x")])  # near copies under one id
    assert len(left([(5, " "), (6, " ")])) == 2  # without words
    assert left([(None, one), (None, one), (7, one)]) == [(-1, one), (-1, one), (7, one)]


def test_nothing_learned_keeps_what_has_letters(spark):
    docs = spark.createDataFrame([("a", 1, "Some text.", None, 1, "s", "k", "t"), ("b", 2, "123", None, 1, "s", "k", "t"), ("c", 3, None, None, 1, "s", "k", "t")], EDGE_SCHEMA)
    assert [r.node for r in corpus_pipeline.language_id(spark, docs, "").collect()] == ["a"]
