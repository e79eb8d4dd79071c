"""Near copies by many universal-hash minima, banding, signature verification and exact confirmation.

1. Every document's set of word shingles gives ``BANDS * ROWS`` minima of multiply-add hashes and from them one key for
   each band. Documents with equal sets form a class and are one node from here on.
2. Nodes that share a band key are candidates. Each key's nodes are tied to its least one, and alternating large-star
   and small-star rounds gather them. A link (similarity 0.8) is missed by all 42 bands of 6 rows with probability
   3e-6, and a gathering holds every link that any key shows.
3. Within a gathering nodes are compared by their signatures, and what can be similar is confirmed on the full sets.
   Pairs already connected are skipped, so a group of n copies costs n confirmations. A gathering of more than
   ``CHUNK`` nodes is dealt into chunks, and every pair of chunks is a task's worth of its own.
4. Confirmed links give the components.

Nulls: a null or wordless text has an empty set and is linked with nothing; a null id keeps a null component and links
nothing. Rows with one id and several texts are judged row by row. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.components import components
from pageloom.llm.texts import WordHashes, id_and_text, kept, map_texts, mix, slices, words_of, written
from pageloom.operators.skew import broadcast_if_small, join_split

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 42, 6
CHUNK = 4096
#: Rows of a band key beyond which its nodes are shared out over several tasks.
KEY_ROWS = 100_000
#: A column that no table has.
KEY = "__row_key"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20)
_A = _rng.integers(1, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, np.uint64).astype(np.uint32)
#: A pair at the limit shows fewer equal minima than this with probability 3e-7 (five standard deviations).
LEAST_EQUAL = int(BANDS * ROWS * 0.8 - 5 * (BANDS * ROWS * 0.16) ** 0.5)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles; with fewer words, of the whole sequence as one."""
    words = words_of(text) if text else []
    if not words:
        return np.empty(0, np.uint64)
    hashes = kept("word hashes", WordHashes)(words)
    width = min(size, len(words))
    found = np.full(len(words) - width + 1, 0 if width == size else width + 1, np.uint64)
    for k in range(width):
        found = found * _STEP + hashes[k : len(hashes) - width + 1 + k]
    return np.unique(mix(found))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum of each hash over the set; the set must not be empty."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        hashed = np.multiply.outer(_A, short[at : at + 2048])
        hashed += _B[:, None]
        np.minimum(least, hashed.min(1), out=least)
    return least


def band_keys(minima: np.ndarray) -> np.ndarray:
    rows = minima.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = mix(key * _STEP + rows[:, r])
    return key.view(np.int64)


def node_of(shingles: np.ndarray) -> int:
    """One 64-bit name for a whole set; sets with the same name are taken as equal."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).view(np.int64))


def signed(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, row_key, n_shingles, node, keys`` of each row: node and keys are null for an empty set.

    ``row_key`` is a hash of the text, which tells rows of one id apart.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t, shingle) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("row_key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([node_of(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([band_keys(signature(s)) if len(s) else None for s in sets], pa.list_(pa.int64())),
            ],
            names=["doc_id", "row_key", "n_shingles", "node", "keys"],
        )

    return map_texts(id_and_text(docs, "doc_id", "text", row_key()), work, "doc_id bigint, row_key bigint, n_shingles bigint, node bigint, keys array<bigint>")


def row_key() -> Column:
    """Tells texts of one id apart; null and empty texts are the same here as everywhere."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("row_key")


def nodes_of(table: DataFrame) -> DataFrame:
    """``node, doc_id, keys``: each distinct set once, with one bearer. Copies of a text are one row from here on.

    Equal sets have equal keys, so any bearer's will do.
    """
    known = table.where("node is not null and doc_id is not null")
    return known.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("keys").alias("keys"))


def candidates(nodes: DataFrame) -> DataFrame:
    """Edges ``node, least`` between nodes that share a band key, a star for each key.

    A key that very many nodes share is one row of each task while its least node is
    sought; the join back is split by the rows it makes.
    """
    keyed = written(nodes.select("node", F.explode("keys").alias("key")), "band_keys")
    shared = keyed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least <> most")
    found = join_split(keyed, written(shared.select("key", "least"), "shared_keys"), "key", F.col("node"), KEY_ROWS)
    return found.where("node <> least").select("node", "least").distinct()


def similar(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """100 * intersection >= percent * union, on sorted distinct arrays."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    common = int((large[at] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def forest(sets: list[np.ndarray], side: np.ndarray | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Confirmed links that connect what is similar; pairs of one side only are left to other chunks if sides are given."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order]
    marks = np.stack([signature(sets[i]) for i in order]) if n > 2 else None
    sides = None if side is None else side[order]
    group = np.arange(n)
    links: list[tuple[int, int]] = []
    for i in range(n):
        # Larger sets up to the size that can still be similar.
        stop = int(np.searchsorted(ordered, 100 * int(ordered[i]) // percent, side="right"))
        near = np.arange(i + 1, stop)
        near = near[group[near] != group[i]]
        if sides is not None and len(near):
            near = near[sides[near] != sides[i]]
        if marks is not None and len(near) > 1:
            least = LEAST_EQUAL * percent // PERCENT if percent < PERCENT else LEAST_EQUAL
            kept = [near[at : at + 2048][(marks[near[at : at + 2048]] == marks[i]).sum(1) >= least] for at in range(0, len(near), 2048)]
            near = np.concatenate(kept)
        for j in near.tolist():
            if group[j] != group[i] and similar(sets[order[i]], sets[order[j]], percent):
                links.append((int(order[i]), int(order[j])))
                group[group == group[j]] = group[i]
    return links


def confirmed(docs: DataFrame, members: DataFrame, shingle: int, percent: int, chunk: int = CHUNK) -> DataFrame:
    """Links ``a, b`` between nodes of a gathering. ``members``: ``node, gathering, doc_id`` of one bearer of each set."""
    counts = members.groupBy("gathering").agg(F.count("*").alias("rows"))
    chunks = F.ceil(F.col("rows") / chunk).cast("int")
    dealt = members.join(counts, "gathering").withColumn("chunks", chunks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    dealt = dealt.withColumn("other", other).select(
        F.col("doc_id").alias("bearer"),
        "node",
        F.xxhash64("gathering", F.least("own", "other"), F.greatest("own", "other")).alias("task"),
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"),
        (F.col("chunks") > 1).alias("split"),
    )
    texts = id_and_text(docs).where("text is not null")
    rows = texts.join(broadcast_if_small(dealt), texts["doc_id"] == dealt["bearer"]).select("task", "node", "side", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held, sides = None, {}, {}

        def links() -> pa.RecordBatch:
            names = sorted(held)
            sets = [held[n] for n in names]
            own = np.array([sides[n] for n in names])
            found = forest(sets, own if (own >= 0).any() else None, percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([names[i] for i, _ in found], pa.int64()), pa.array([names[j] for _, j in found], pa.int64())],
                names=["a", "b"],
            )

        for batch in slices(batches):
            for row in batch.to_pylist():
                if row["task"] != task:
                    if len(held) > 1:
                        yield links()
                    task, held, sides = row["task"], {}, {}
                if row["node"] not in held:
                    shingles = shingle_set(row["text"], shingle)
                    if len(shingles) and node_of(shingles) == row["node"]:  # not another text under the same id
                        held[row["node"]], sides[row["node"]] = shingles, row["side"]
        if len(held) > 1:
            yield links()

    return rows.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a bigint, b bigint")


def judged(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, row_key, n_shingles, root`` of each row; rows of one component share ``root``, which is null for rows linked with nothing."""
    if not 80 <= percent <= 100:
        raise ValueError("the bands are laid out for similarities of 0.8 and more")
    table = written(signed(docs, shingle), "signed")
    nodes = written(nodes_of(table), "nodes")
    gathered = written(components(candidates(nodes), "node", "least"), "gathered")
    members = gathered.withColumnRenamed("root", "gathering").join(nodes.select("node", "doc_id"), "node")
    links = written(components(confirmed(docs, written(members, "members"), shingle, percent), "a", "b"), "rooted")
    plain = table.select("doc_id", "row_key", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"))
    # Nodes that are linked with another: a node of very many copies is split by the join or not joined at all.
    return plain.join(broadcast_if_small(links), "node", "left").select("doc_id", "row_key", "n_shingles", F.coalesce("root", "node").alias("root"))


def near_copies(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document; the least id of a component is kept."""
    rows = written(judged(docs, shingle, percent), "judged")
    least = written(rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("rows")), "least")
    # A component of one row is its own; only the others are told their least id.
    several = least.where("rows > 1").select("root", "component_id")
    told = rows.join(broadcast_if_small(several), "root", "left")
    component = F.coalesce("component_id", "doc_id")
    return told.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def representatives(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each component the row with the least id, then the least text hash.

    Rows without words and rows without an id all stay, as they are linked with
    nothing. A row that repeats as a whole stays once, if its component stays with it.
    """
    rows = written(judged(docs, shingle, percent), "judged").where("root is not null")
    row = F.struct("doc_id", "row_key")
    groups = written(rows.groupBy("root").agg(F.min(row).alias("stays"), F.count("*").alias("rows")).where("rows > 1"), "groups")
    seen = rows.select("root", row.alias("row")).distinct()
    gone = seen.join(broadcast_if_small(groups), "root").where(F.col("row") != F.col("stays"))
    gone = written(gone.select(F.col("row.doc_id").alias("gone_id"), F.col("row.row_key").alias("gone_key")), "gone")
    again = written(rows.groupBy("doc_id", "row_key").agg(F.count("*").alias("rows")).where("rows > 1").select(F.col("doc_id").alias("again_id"), F.col("row_key").alias("again_key")), "again")

    keyed = docs.withColumn(KEY, row_key())
    own = F.col("doc_id").cast("bigint")
    left = keyed.join(broadcast_if_small(gone), (own == F.col("gone_id")) & (F.col(KEY) == F.col("gone_key")), "left_anti")
    if again.isEmpty():
        return left.drop(KEY)
    repeats = (own == F.col("again_id")) & (F.col(KEY) == F.col("again_key"))
    single = left.join(broadcast_if_small(again), repeats, "left_anti")
    several = left.join(broadcast_if_small(again), repeats, "left_semi").dropDuplicates(["doc_id", KEY])
    return single.unionByName(several).drop(KEY)
