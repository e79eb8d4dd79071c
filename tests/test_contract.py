"""The contract needs no installation details, and intermediate tables can be dropped."""

from __future__ import annotations

import pyspark
from pyspark.ml.feature import StopWordsRemover

import __spark_entry__ as contract
from pageloom import storage
from pageloom.functions import tokens


def test_stop_words_are_those_of_spark(spark):
    assert tokens.english_stop_words() == StopWordsRemover.loadDefaultStopWords("english")


def test_twins_need_no_installation(monkeypatch, tmp_path):
    monkeypatch.setattr(pyspark, "__file__", str(tmp_path / "__init__.py"))
    assert len(contract.oracle_sql()) >= 68


def test_release_drops_the_tables(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(storage, "shared_folder", lambda session: str(tmp_path))
    kept = storage.durable(spark.range(5), "numbers")
    assert kept.count() == 5 and any((tmp_path / "tables").rglob("*.parquet"))
    storage.release(spark)
    assert not any((tmp_path / "tables").rglob("*.parquet"))
