"""Result sets that readers see whole: the old one or the new one, never a part of either.

A set is written into a version folder of its own under ``versions``. A small file,
``current``, names the version that readers take; it is replaced by one rename once
everything else is written. A job that fails on the way leaves the old set readable,
and its own folder tells the next run which stages it finished.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from pageloom.sinks.tables import under

_CURRENT, _VERSIONS, _DONE = "current", "versions", "_finished"


def _files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The Hadoop file system of a path, and the path in its terms."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _write(spark: SparkSession, path: str, text: str) -> None:
    files, place = _files(spark, path)
    stream = files.create(place, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _read(spark: SparkSession, path: str) -> str | None:
    files, place = _files(spark, path)
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def fingerprint(spark: SparkSession, path: str, parameters: dict[str, Any]) -> str:
    """A name for an input and the parameters of a job: it changes with any file's name, length or time and with any parameter."""
    files, place = _files(spark, path)
    found = [f for top in files.globStatus(place) or [] for f in _under(files, top)]
    listed = sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found)
    return hashlib.sha256(json.dumps([listed, parameters], sort_keys=True).encode()).hexdigest()[:20]


def _under(files: Any, status: Any) -> list[Any]:
    if not status.isDirectory():
        return [status]
    inner = files.listFiles(status.getPath(), True)
    found = []
    while inner.hasNext():
        found.append(inner.next())
    return found


class Version:
    """One set of results on its way: a folder for its tables, and notes of the stages that are finished."""

    def __init__(self, spark: SparkSession, out: str, name: str) -> None:
        self.spark, self.out, self.name = spark, out, name
        self.folder = under(under(out, _VERSIONS), name)

    def finished(self, stage: str) -> bool:
        files, place = _files(self.spark, under(self.folder, f"{_DONE}/{stage}"))
        return bool(files.exists(place))

    def run(self, stage: str, work: Callable[[str], Any]) -> None:
        """``work(folder)``, unless an earlier run of the same version finished it. Work that fails leaves no note."""
        if not self.finished(stage):
            work(self.folder)
            _write(self.spark, under(self.folder, f"{_DONE}/{stage}"), stage)

    def publish(self, keep: int = 2) -> None:
        """Show this version to readers by one rename; only the last ``keep`` published versions stay."""
        history = [v for v in published_versions(self.spark, self.out) if v != self.name]
        kept = [*history[-(keep - 1) :], self.name] if keep > 1 else [self.name]
        fresh = under(self.out, f"{_CURRENT}-{self.name}")
        _write(self.spark, fresh, json.dumps(kept))
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        _, source = _files(self.spark, fresh)
        files, target = _files(self.spark, under(self.out, _CURRENT))
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), self.spark._jsc.hadoopConfiguration())
        context.rename(source, target, options)
        for old in history:
            if old not in kept:
                files, place = _files(self.spark, under(under(self.out, _VERSIONS), old))
                files.delete(place, True)


def published_versions(spark: SparkSession, out: str) -> list[str]:
    """The versions that are kept, the current one last; empty before the first."""
    found = _read(spark, under(out, _CURRENT))
    return json.loads(found) if found else []


def published_folder(spark: SparkSession, out: str) -> str:
    """The folder of the current version."""
    versions = published_versions(spark, out)
    if not versions:
        raise FileNotFoundError(f"nothing is published under {out}")
    return under(under(out, _VERSIONS), versions[-1])


def read_published(spark: SparkSession, out: str, name: str) -> DataFrame:
    return spark.read.parquet(under(published_folder(spark, out), name))
