"""Helpers shared by the text operators: bounded slices of Arrow batches and word arrays."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.storage import durable

SLICE_BYTES = 2 << 20
Kept = TypeVar("Kept")
#: Fixed value of the contracts: a word is a run of anything but these characters.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SEPARATORS = str.maketrans(dict.fromkeys("\t\n\x0b\x0c\r", " "))
_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(ord("A"), ord("Z") + 1)})


#: Batches go to a worker whole and are held twice on the way; one need not be much larger than a slice.
BATCH_SETTING, DEFAULT_BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20
#: How workers' C heaps behave: arrays from 4 MB on go back to the system when they are freed, and two threads share a heap.
HEAP = {"MALLOC_MMAP_THRESHOLD_": str(4 << 20), "MALLOC_TRIM_THRESHOLD_": str(16 << 20), "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if their own path lacks it, and keep them small."""
    root, known = str(Path(__file__).parents[2]), spark.sparkContext.environment
    for name, value in HEAP.items():
        known.setdefault(name, value)
    if spark.conf.get(BATCH_SETTING, DEFAULT_BATCH) == DEFAULT_BATCH:  # a size of the caller's own stays
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*filter(None, paths), root])


def fresh_heaps(spark: SparkSession) -> None:
    """Let the executors and the driver collect their garbage and give back what their heaps don't need, between two stages.

    A JVM keeps the heap that its greediest stage asked for, so stages in a row add
    up with the workers' memory. A few tasks for each core reach every executor.
    """
    fresh_driver(spark)
    tasks = 2 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).selectExpr("reflect('java.lang.System', 'gc') AS done").write.format("noop").mode("overwrite").save()


def fresh_driver(spark: SparkSession) -> None:
    """Let the driver's two processes collect their garbage and give back what they don't need.

    Every job leaves plans, task metrics and broadcast blocks behind, and the JVM asks for more heap
    sooner than it collects them all. Frames that Python still holds keep theirs, so Python goes first.
    """
    give_back()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """``durable``, for operators of many jobs: the next one finds the driver without this one's garbage."""
    table = durable(df, name)
    fresh_driver(df.sparkSession)
    return table


def id_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """The two columns every text operator needs, under fixed names; further columns are left behind."""
    return docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *more)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a slice holds about ``limit`` bytes of text, or one row that is longer."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


_KEPT: dict[str, object] = {}


def kept(name: str, make: Callable[[], Kept]) -> Kept:
    """What a worker remembers between tasks under a name; one thing at a time, so that operators in a row don't add up."""
    if name not in _KEPT:
        _KEPT.clear()
        give_back()
        _KEPT[name] = make()
    return _KEPT[name]


def give_back() -> None:
    """Return what is free in this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def map_texts(
    docs: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, column: str = "text", limit: int = SLICE_BYTES
) -> DataFrame:
    """``work`` on every bounded slice of the rows, inside the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, limit):
            out = work(part)
            if out is not None and out.num_rows:
                yield out
        give_back()

    return docs.mapInArrow(run, schema)


def keep_rows(
    docs: DataFrame, decide: Callable[[list[str | None]], np.ndarray], text: str = "text", limit: int = SLICE_BYTES
) -> DataFrame:
    """The rows whose text ``decide`` says to keep, with all their columns; no shuffle, no join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, limit):
            kept = part.filter(pa.array(decide(part.column(text).to_pylist()), pa.bool_()))
            if kept.num_rows:
                yield kept
        give_back()

    return docs.mapInArrow(run, docs.schema)


def lower_ascii(text: str) -> str:
    """A-Z in lower case and nothing else changed."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def words_of(text: str) -> list[str]:
    """Lower-cased words of a text; separators are the space and the five ASCII controls after it in the contract.

    ``str.split`` would also cut at other Unicode blanks, so a text that holds one
    of those is cut at the given separators only.
    """
    lowered = lower_ascii(text)
    found = lowered.split()
    if lowered.isascii() and not _ASCII_BLANKS.search(lowered):
        return found
    plain = [word for word in lowered.translate(_SEPARATORS).split(" ") if word]
    return plain if len(plain) != len(found) else found if plain == found else plain


_ASCII_BLANKS = re.compile(r"[\x1c-\x1f]")


def fold(key: int | None, parts: int) -> int:
    """crc32 of the key's decimal text modulo ``parts``; a null key counts as the text ``null``."""
    return zlib.crc32(str("null" if key is None else key).encode()) % parts


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes:
    """64-bit hashes of words, remembered up to a bound; one C-level lookup per repeated word."""

    def __init__(self, limit: int = 150_000) -> None:
        self.limit, self.known = limit, {}

    def __call__(self, words: list[str]) -> np.ndarray:
        import xxhash

        missing = set(words).difference(self.known)
        if len(self.known) + len(missing) > self.limit:
            self.known = {}
            missing = set(words)
        digest = xxhash.xxh3_64_intdigest
        self.known.update((w, digest(w.encode("utf-8", "surrogatepass"))) for w in missing)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
