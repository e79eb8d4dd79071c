"""Approximate nearest neighbours by cross-polytope hashing.

A vector's direction is turned by ``TABLES`` pseudo-random rotations (three rounds of random signs and a fast Hadamard
transform) and falls, in each table, to the nearest of the signed axes. A query probes the axes nearest to it in every
table, ``SHARE`` of all of them and at least ``PROBES``; the vectors found there are ranked by their exact inner product
with it. A query that has met fewer vectors than it is to return goes on to all other axes of the first table, which
hold every vector once: so it gets all candidates where there are few, and as many as asked for wherever there are.

Equal vectors are one class with their smallest ids, so a vector with very many copies is hashed and searched once. A
bucket with more than ``ROWS_A_PART`` classes is split, and a query visits every part of it.

Vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows without an id. Only
vectors of one length are compared. A row that repeats counts once; rows of one id are never each other's neighbours.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.operators.skew import broadcast_if_small
from pageloom.storage import durable

TABLES, PROBES, SHARE = 6, 28, 0.26
ROWS_A_PART = 20_000
#: Vectors hashed at a time; each is copied once for every probe.
HASHED_ROWS = 512
EVERY = 20
NEAREST = 20


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of every row; the length must be a power of two."""
    n, step = rows.shape[1], 1
    out = rows.copy()
    while step < n:
        parts = out.reshape(len(out), n // (2 * step), 2, step)
        out = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], 2).reshape(len(out), n)
        step *= 2
    return out / np.sqrt(n)


def rotated(vectors: np.ndarray, table: int) -> np.ndarray:
    """Unit vectors, padded to a power of two, after the table's pseudo-rotation."""
    width = 1 << max(0, (vectors.shape[1] - 1).bit_length())
    rng = np.random.default_rng([table, width])
    largest = np.abs(vectors).max(1, keepdims=True)
    scaled = vectors / largest
    out = np.zeros((len(vectors), width))
    out[:, : vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    for _ in range(3):
        out = hadamard(out * rng.choice([-1.0, 1.0], width))
    return out


def nearest_axes(turned: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row: axis ``i`` is ``2 i``, its opposite ``2 i + 1``."""
    both = np.stack([turned, -turned], 2).reshape(len(turned), -1)
    probes = min(probes, both.shape[1])
    if probes == both.shape[1]:
        return np.tile(np.arange(probes), (len(turned), 1))
    return np.argpartition(-both, probes - 1, axis=1)[:, :probes]


def valid(rows: DataFrame) -> DataFrame:
    """``vec_id, vector``: the rows that take part, each once."""
    vector = F.col("embedding").cast("array<double>")
    named = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (x > low) & (x < high))
    return named.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & fine & F.exists("vector", lambda x: x != 0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """``name, vector, ids``: distinct vectors with their ``keep`` smallest ids.

    Ids are thinned out in three steps, so that no task ever holds those of a very common vector.
    """

    def thinned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids: dict[tuple, list[int]] = {}
            for key, vector in zip(batch.column("vec_id").to_pylist(), batch.column("vector").to_pylist(), strict=True):
                ids.setdefault(tuple(vector), []).append(key)
            smallest = [sorted(set(v))[:keep] for v in ids.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([list(k) for k in ids], pa.list_(pa.float64())), pa.array(smallest, pa.list_(pa.int64()))], names=["vector", "ids"]
            )

    smallest = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids")
    parts = rows.mapInArrow(thinned, "vector array<double>, ids array<bigint>")
    parts = parts.groupBy("vector", F.pmod(F.xxhash64("ids"), F.lit(64)).alias("part")).agg(smallest)
    return parts.groupBy("vector").agg(smallest).select(F.xxhash64("vector").alias("name"), "vector", "ids")


def axes_of(width: int) -> int:
    """Signed axes of vectors of a width, which is padded to a power of two."""
    return 2 << max(0, (width - 1).bit_length())


def _hashed(rows: DataFrame, probes: int | None, tables: int) -> DataFrame:
    """``rows`` once for each table and probed axis, with ``width, tab, axis``; by default as many axes as the width asks for."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema) + ", width int, tab int, axis int"

    def hashed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        vectors = batch.column("vector").to_pylist()
        by_width: dict[int, list[int]] = {}
        for i, v in enumerate(vectors):
            by_width.setdefault(len(v), []).append(i)
        for width, places in by_width.items():
            data = np.array([vectors[i] for i in places], np.float64)
            own = batch.take(pa.array(places))
            for table in range(tables):
                axes = nearest_axes(rotated(data, table), probes or max(PROBES, math.ceil(SHARE * axes_of(width))))
                out = own.take(pa.array(np.repeat(np.arange(len(places)), axes.shape[1])))
                n = out.num_rows
                extra = [np.full(n, width, np.int32), np.full(n, table, np.int32), axes.ravel().astype(np.int32)]
                yield pa.RecordBatch.from_arrays([*out.columns, *map(pa.array, extra)], names=[*out.schema.names, "width", "tab", "axis"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, HASHED_ROWS):
                yield from hashed(batch.slice(at, HASHED_ROWS))

    return rows.mapInArrow(run, schema)


def neighbours(
    rows: DataFrame, every: int = EVERY, nearest: int = NEAREST, tables: int = TABLES, probes: int | None = None, part_rows: int = ROWS_A_PART
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose id is divisible by ``every`` its nearest others found.

    Largest inner product first, ties to the smaller id. A query has ``nearest``
    rows, or one for each other id of its width if those are fewer; none, if there
    is no other.
    """
    keep = nearest + 1  # one more, for the query's own row
    clean = valid(rows)
    index = durable(classes(clean, keep), "vector_classes")
    asking = clean.where(F.col("vec_id") % every == 0).select("vec_id", F.xxhash64("vector").alias("name")).distinct()
    asking = durable(asking, "queries")
    wanted = index.join(asking.select("name").distinct(), "name", "left_semi").select("name", "vector")

    bucket = ["width", "tab", "axis"]
    hashed = durable(_hashed(index, 1, tables), "hashed")
    # One row for each bucket: tables times twice the padded width.
    parts = hashed.groupBy(*bucket).agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
    parts = broadcast_if_small(durable(parts, "parts"))
    dealt = hashed.join(parts, bucket).withColumn("part", F.pmod(F.col("name"), F.col("parts")).cast("int")).drop("parts")
    names = ["name", "vec_id", "score"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if left.num_rows and right.num_rows:
            ids = right.column("ids").to_pylist()
            first = np.array([i[0] for i in ids])
            order = np.argsort(first, kind="stable")
            ids = [ids[i] for i in order]
            found = np.array(right.column("vector").to_pylist(), np.float64)[order]
            sizes = np.array([len(i) for i in ids])
            asked = np.array(left.column("vector").to_pylist(), np.float64)
            asker = left.column("name").to_numpy()
            for at in range(0, len(asked), 512):
                scores = asked[at : at + 512] @ found.T
                best = np.argsort(-scores, axis=1, kind="stable")[:, :keep]
                for q, chosen in enumerate(best):
                    mine = np.concatenate([ids[c] for c in chosen])
                    own = np.repeat(scores[q, chosen], sizes[chosen])
                    top = np.lexsort((mine, -own))[:keep]
                    out.append((np.full(len(top), asker[at + q]), mine[top], own[top]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table([pa.array(c) for c in columns], names=names)

    keys = [*bucket, "part"]

    def met(probing: DataFrame, dealt: DataFrame) -> DataFrame:
        at = probing.join(parts, bucket).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        return at.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(rank, "name bigint, vec_id bigint, score double")

    def best_of(found: DataFrame) -> DataFrame:
        # Found in several tables: one row each, then the best of every query vector.
        single = found.groupBy("name", "vec_id").agg(F.max("score").alias("score"))
        place = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("score"), "vec_id"))
        return single.withColumn("place", place).where(F.col("place") <= keep).drop("place")

    best = durable(best_of(met(_hashed(wanted, probes, tables), dealt)), "met")
    # A query always meets its own class, so all ids of its width are as many as it can meet.
    there = index.groupBy(F.size("vector").alias("width")).agg(F.sum(F.size("ids")).alias("ids"))
    counts = best.groupBy("name").agg(F.count("*").alias("ids_met"))
    sized = wanted.select("name", F.size("vector").alias("width")).join(counts, "name", "left")
    short = sized.join(F.broadcast(there), "width").where(F.coalesce("ids_met", F.lit(0)) < F.least(F.lit(keep), "ids"))  # a row for each width
    short = durable(short.select("name"), "short")
    if not short.isEmpty():
        again = wanted.join(broadcast_if_small(short), "name", "left_semi")
        widest = axes_of(there.agg(F.max("width")).first()[0])
        rest = met(_hashed(again, widest, 1), dealt.where("tab = 0"))
        best = best_of(best.unionByName(rest))
    lists = best.groupBy("name").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v")))).alias("near"))
    near = F.expr(f"slice(filter(near, x -> x.v <> query_id), 1, {nearest})")
    asked = asking.select(F.col("vec_id").alias("query_id"), "name").join(lists, "name").select("query_id", F.posexplode(near).alias("place", "x"))
    return asked.select("query_id", (F.col("place") + 1).alias("rank"), F.col("x.v").alias("vec_id"), (-F.col("x.s")).alias("score"))
