"""Exact duplicates by deterministic block naming.

Texts are cut into blocks of a fixed number of bytes. The blocks are sorted and
numbered in order, so equal blocks, and only those, share an integer name.
Then the names of adjacent pairs are named in the same way, level by level,
until one name is left of each text: texts are equal when they end on the same
level with the same name. Names come from comparing whole blocks, so no two collide.

On Spark: the rows are dealt with in slices. A slice sends each of its distinct
blocks (later pairs) once to the sort, whatever number of its texts hold it,
and gets the names back. A text that very many rows share is one row of each
slice there; the rows themselves never meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.texts import id_and_text, slices
from pageloom.storage import durable

BLOCK_BYTES = 4096
#: Bytes of UTF-8 with A-Z lowered; no byte of a longer character lies in that range.
_LOWERED = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Stands for the missing partner of the last name of an odd row of names.
NOTHING = -1

_STATE = "slice long, sizes array<int>, places array<int>, levels array<int>, names array<long>, keys array<binary>"
_CUT = f"{_STATE}, ids array<long>, digests array<string>"


def exact_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row for each row of ``docs``.

    Texts are equal when they are identical after lower-casing A-Z; null counts as
    empty. Of equal texts the row with the largest id stays; ids that are null come
    after all others. Exactly one row of a group stays, even if its id or the whole
    row repeats. ``group_size`` counts rows. An empty table gives an empty result,
    further columns are left behind, and a text of any length takes one level of
    names more for each doubling.
    """
    cut = durable(id_and_text(docs, key, text).mapInArrow(lambda batches: _cut(batches, block_bytes), _CUT), "blocks")
    return _judged(cut, _identities(cut.select(*_names(_STATE))))


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list holding all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _cut(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[pa.RecordBatch]:
    """A row for each slice: the blocks of its texts as places in a list of distinct blocks."""
    number = TaskContext.get().partitionId() << 32
    for part in slices(batches):
        ids = part.column("doc_id")
        keys: dict[bytes, int] = {}
        sizes, places, digests = [], [], []
        for raw in part.column("text").cast(pa.binary()).to_pylist():
            raw = (raw or b"").translate(_LOWERED)
            starts = range(0, max(len(raw), 1), block_bytes)
            places += [keys.setdefault(raw[at : at + block_bytes], len(keys)) for at in starts]
            sizes.append(len(starts))
            digests.append(hashlib.sha256(raw).hexdigest())
        open_ = np.full(len(sizes), NOTHING)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                _lists(np.array(sizes), pa.int32()),
                _lists(np.array(places), pa.int32()),
                _lists(open_, pa.int32()),
                _lists(open_, pa.int64()),
                pa.array([list(keys)], pa.list_(pa.binary())),
                pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                pa.array([digests], pa.list_(pa.string())),
            ],
            _names(_CUT),
        )
        number += 1


def _identities(state: DataFrame) -> DataFrame:
    """``slice, levels, names``: the last level and the name of each text of a slice."""
    done, level = [], 0
    while True:
        waiting = state.where(F.size("keys") > 0)
        if level and waiting.isEmpty():
            break
        names = sorted_names(waiting.select("slice", F.posexplode("keys").alias("place", "key")))
        waiting = waiting.drop("keys")
        state = durable(waiting.groupBy("slice").cogroup(names.groupBy("slice")).applyInArrow(_pairing(level), _STATE), "named")
        done.append(state.where(F.size("keys") == 0).select("slice", "levels", "names"))
        level += 1
    return reduce(DataFrame.unionByName, done)


def sorted_names(keys: DataFrame) -> DataFrame:
    """``slice, place, name`` of rows ``slice, place, key``: a number from 0 on for each distinct key.

    Equal keys meet in one partition and are sorted there as whole byte strings. A
    partition counts its distinct keys and starts where those before it end, so
    only one number a partition is collected. Keys are dealt out by hash and not by
    range: a range would need samples of whole blocks in the driver, and blocks that
    begin alike would crowd one range.
    """
    ordered = keys.repartition(F.col("key")).sortWithinPartitions("key")
    ranked = durable(ordered.mapInArrow(_ranks, "part int, slice long, place int, rank long"), "ranks")
    counts = ranked.groupBy("part").agg((F.max("rank") + 1).alias("keys")).orderBy("part").toArrow()
    ends = np.cumsum(counts["keys"].to_numpy())
    before = pa.table({"part": counts["part"], "before": pa.array(ends - counts["keys"].to_numpy(), pa.int64())})
    starts = keys.sparkSession.createDataFrame(before)
    # At most one row for each shuffle partition is broadcast.
    return ranked.join(F.broadcast(starts), "part").select("slice", "place", (F.col("rank") + F.col("before")).alias("name"))


def _ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, last, rank = TaskContext.get().partitionId(), None, -1
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column("key")
        fresh = np.ones(len(keys), bool)
        fresh[0] = keys[0].as_py() != last
        fresh[1:] = pc.not_equal(keys.slice(1), keys.slice(0, len(keys) - 1)).to_numpy(zero_copy_only=False)
        ranks = rank + np.cumsum(fresh)
        last, rank = keys[-1].as_py(), int(ranks[-1])
        parts = pa.array(np.full(len(keys), part), pa.int32())
        yield pa.RecordBatch.from_arrays([parts, batch.column("slice"), batch.column("place"), pa.array(ranks, pa.int64())], ["part", "slice", "place", "rank"])


def _pairing(level: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda own, given: _pair(own, given, level)


def _pair(own: pa.Table, given: pa.Table, level: int) -> pa.Table:
    """A slice after its keys have got their names: texts with one name are done, of the others adjacent names are paired."""
    state = own.to_batches()[0]
    sizes, places, levels, names = (state.column(c).flatten().to_numpy(zero_copy_only=False).copy() for c in ("sizes", "places", "levels", "names"))
    named = np.empty(given.num_rows, np.int64)
    named[given["place"].to_numpy()] = given["name"].to_numpy()
    current = named[places]
    starts = np.cumsum(sizes) - sizes
    last = sizes == 1
    levels[last], names[last] = level, current[starts[last]]

    long = sizes > 1
    halves = np.where(long, (sizes + 1) // 2, 0)
    here = np.repeat(long, sizes)
    within = np.arange(len(current)) - np.repeat(starts, sizes)
    pairs = np.full(2 * int(halves.sum()), NOTHING, np.int64)
    pairs[(np.repeat(2 * (np.cumsum(halves) - halves), sizes) + within)[here]] = current[here]
    distinct, at = np.unique(pairs.reshape(-1, 2), axis=0, return_inverse=True)
    # The sign bit is flipped for byte order to be the order of the numbers.
    packed = (distinct.astype(np.int64) ^ np.int64(-(1 << 63))).astype(">i8").tobytes()
    keys = [packed[i : i + 16] for i in range(0, len(packed), 16)]
    return pa.table(
        [
            state.column("slice"),
            _lists(halves, pa.int32()),
            _lists(at.ravel(), pa.int32()),
            _lists(levels, pa.int32()),
            _lists(names, pa.int64()),
            pa.array([keys], pa.list_(pa.binary())),
        ],
        _names(_STATE),
    )


def _judged(cut: DataFrame, identities: DataFrame) -> DataFrame:
    """The row that stays of each identity, found among one row for each slice, and told to the rows slice by slice."""
    rows = cut.select("slice", "ids", "digests").join(identities, "slice")
    each = rows.select("slice", F.posexplode(F.arrays_zip("ids", "digests", "levels", "names")).alias("at", "row"))
    named = durable(
        each.select("slice", "at", F.col("row.ids").alias("doc_id"), F.col("row.digests").alias("text_sha256"), F.col("row.levels").alias("level"), F.col("row.names").alias("name")),
        "identities",
    )
    row = F.struct("doc_id", "slice", "at")
    local = named.groupBy("slice", "level", "name").agg(F.max(row).alias("best"), F.count("*").alias("n"))
    groups = local.groupBy("level", "name").agg(F.max("best").alias("stays"), F.sum("n").alias("group_size"))
    told = local.select("slice", "level", "name").join(groups, ["level", "name"])
    return named.join(told, ["slice", "level", "name"]).select(
        "doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", row.eqNullSafe(F.col("stays")).alias("kept"), "text_sha256"
    )
