"""Token-id files: whole texts as tokenizer ids, range-coded under one frequency table.

``write_tokens`` leaves three tables in a folder:

``blocks``  one row for each independent coded block of whole documents: ``part`` (files in ascending key order),
            ``first`` (the place of its first document in the part), ``start`` (ids of the part before the block),
            ``n_tokens``, ``keys`` and ``lengths`` (little-endian int64 and uint32 of its documents), ``null_keys``
            (a byte each), ``table_crc`` (of the table it is coded under), ``payload`` (the coded ids with checkpoints
            and checksums, see ``range_coder``).
``table``   the frequency of every id, shared by all blocks.
``parts``   ids in each part, from which ids before a document follow.

Null texts count as empty and give the end id alone; null keys come first. Repeated rows are documents of their own;
ties of the key are ordered by a hash of the text, so that one key of very many rows is spread over several parts. An empty table gives empty tables. No other column of the input is touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.llm.chunk_ids import encoder
from pageloom.llm.range_coder import FrequencyTable, decode, encode
from pageloom.llm.texts import id_and_text, slices
from pageloom.storage import fresh_path

BLOCK_TOKENS = 1 << 18


def token_rows(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``part, place, before, doc_id, n_tokens, ids`` in ascending ``doc_id`` order over and within the parts."""
    schema = "part int, place bigint, before bigint, doc_id bigint, n_tokens bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, before, tool = TaskContext.get().partitionId(), 0, 0, encoder(tokenizer)
        kind = "<u2" if tool.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        for batch in slices(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            ids, sizes = tool.encode(texts)
            stops = np.cumsum(sizes)
            full = np.insert(ids, stops, end_id).astype(kind)
            sizes = sizes + 1
            stops = np.cumsum(sizes)
            starts = stops - sizes
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.arange(place, place + n)),
                    pa.array(before + starts),
                    batch.column("doc_id"),
                    pa.array(sizes),
                    pa.array([full[a:b].tobytes() for a, b in zip(starts, stops, strict=True)], pa.binary()),
                ],
                names=["part", "place", "before", "doc_id", "n_tokens", "ids"],
            )
            place, before = place + n, before + int(stops[-1])

    place = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = id_and_text(docs).repartitionByRange(*place)
    return ordered.sortWithinPartitions(*place, "text").mapInArrow(run, schema)


def _width(tokenizer: str) -> tuple[int, str]:
    size = encoder(tokenizer).tokenizer.get_vocab_size()
    return size, "<u2" if size <= 1 << 16 else "<u4"


def id_counts(rows: DataFrame, vocabulary: int, kind: str) -> DataFrame:
    """``id, n`` over all rows; a task sends each id once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for part in slices(iter([batch]), "ids"):
                joined = b"".join(part.column("ids").to_pylist())
                total += np.bincount(np.frombuffer(joined, kind), minlength=vocabulary)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return rows.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def coded_blocks(rows: DataFrame, table: FrequencyTable, kind: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Rows of consecutive documents as coded blocks of at least ``block_tokens`` ids, or what a task has left."""
    shared = rows.sparkSession.sparkContext.broadcast(table.freq)
    schema = "part int, first bigint, start bigint, n_tokens bigint, keys binary, null_keys binary, lengths binary, table_crc bigint, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freqs = FrequencyTable.of(shared.value)
        held: list[dict] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(r["ids"] for r in held), kind)
            return pa.RecordBatch.from_pylist(
                [
                    {
                        "part": held[0]["part"],
                        "first": held[0]["place"],
                        "start": held[0]["before"],
                        "n_tokens": len(ids),
                        "keys": np.array([r["doc_id"] or 0 for r in held], "<i8").tobytes(),
                        "null_keys": bytes(r["doc_id"] is None for r in held),
                        "lengths": np.array([r["n_tokens"] for r in held], "<u4").tobytes(),
                        "table_crc": freqs.crc(),
                        "payload": encode(ids, freqs),
                    }
                ],
                schema=out,
            )

        out = pa.schema(
            [("part", pa.int32()), ("first", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())]
            + [(name, pa.binary()) for name in ("keys", "null_keys", "lengths")]
            + [("table_crc", pa.int64()), ("payload", pa.binary())]
        )
        for batch in slices(batches, "ids"):
            for row in batch.to_pylist():
                follows = not held or (row["part"] == held[-1]["part"] and row["place"] == held[-1]["place"] + 1)
                if held and (size >= block_tokens or not follows):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += row["n_tokens"]
        if held:
            yield block()

    return rows.mapInArrow(run, schema)


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> None:
    """Encode every text and write the files into ``folder``, which must not exist."""
    spark = docs.sparkSession
    vocabulary, kind = _width(tokenizer)
    at = fresh_path(spark, "token_ids")
    token_rows(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(at)
    rows = spark.read.parquet(at)
    counts = np.zeros(vocabulary, np.int64)
    for row in id_counts(rows, vocabulary, kind).collect():  # at most one row for each id of the vocabulary
        counts[row["id"]] = row["n"]
    table = FrequencyTable(counts)
    stored = pa.table({"id": np.arange(vocabulary), "freq": table.freq.astype(np.int64)})
    spark.createDataFrame(stored).coalesce(1).write.parquet(f"{folder}/table")
    coded_blocks(rows, table, kind).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    blocks.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).write.parquet(f"{folder}/parts")


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, decoded from the files; ``ids`` too if asked for."""
    freq = spark.read.parquet(f"{folder}/table").orderBy("id").toPandas()["freq"].to_numpy(np.uint32)
    shared = spark.sparkContext.broadcast(freq)
    schema = "part int, doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = FrequencyTable.of(shared.value)
        known = table.crc()
        for batch in slices(batches, "payload"):
            for row in batch.to_pylist():
                if row["table_crc"] != known:
                    raise ValueError("the block is coded under another frequency table")
                ids = decode(row["payload"], table)
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                stops = np.cumsum(lengths)
                starts = stops - lengths
                raw = memoryview(ids.astype("<u4").tobytes())
                columns = {
                    "part": pa.array(np.full(len(lengths), row["part"], np.int32)),
                    "doc_id": pa.array(
                        np.frombuffer(row["keys"], "<i8"), mask=np.frombuffer(row["null_keys"], np.uint8).astype(bool)
                    ),
                    "start": pa.array(row["start"] + starts),
                    "n_tokens": pa.array(lengths),
                    "ids_crc32": pa.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, stops, strict=True)], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([ids[a:b].astype(np.int32) for a, b in zip(starts, stops, strict=True)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    found = spark.read.parquet(f"{folder}/blocks").mapInArrow(run, schema)
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = spark.read.parquet(f"{folder}/parts").select("part", F.coalesce(before, F.lit(0)).alias("ids_before"))
    # One row for each written part: as many as the ordering shuffle has partitions.
    return found.join(F.broadcast(parts), "part").withColumn("start", F.col("start") + F.col("ids_before")).drop("part", "ids_before")
