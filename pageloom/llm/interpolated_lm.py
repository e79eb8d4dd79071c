"""Bigram language model by deleted interpolation.

    p(w | h) = l2[b] c(h w) / c(h) + l1[b] c(w) / N + l0[b] / (V + 1),    b = bucket of c(h)

The mixture weights of each context-frequency bucket are learned by expectation-maximisation on counts held out of the
others: one training document in ten, by the crc32 of its id, is the deleted part, and what the other training documents
count is the retained part. Scores use the counts of all training documents. Neither hangs on how the rows are dealt.

How counts meet texts: a block sends each distinct word and word pair once, as sorted 64-bit hashes cut at fixed bounds
into buckets. A bucket's task adds up what all blocks sent and answers each block with the totals in the order of its
own list. So a frequent word costs one entry for each block, never a row for each occurrence, no task holds more than a
slice of the hash space, and no count passes through the driver but N, V and the histogram of the held-out part.

Null texts count as empty: one end token. Repeated rows are documents of their own. Without training documents every
count is 0 and both scores come from the uniform part; without a deleted document the weights stay equal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.texts import WordHashes, fold, id_and_text, kept, mix, slices, words_of
from pageloom.storage import durable

FOLDS, HELD_OUT = 10, 0
BLOCK_BYTES = 6 << 20
LEAST_BLOCKS = 64
#: Training documents in this share (one in ``DELETED``) give the held-out counts of the mixture weights.
DELETED = 10
KEYS_A_BUCKET = 600_000
CONTEXT_BUCKETS = 24
ITERATIONS = 60
ADDED = 0.1
_END = np.uint64(0x1D8E4E27C47D124F)
_BEGIN = np.uint64(0xEB44ACCAB455D165)
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def packed(values: np.ndarray) -> bytes:
    """Integers as compressed byte planes: high planes of small numbers vanish."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, len(raw) // size).T).view(kind).ravel()


TRAINS, GIVES_WEIGHTS = 1, 2


def part_of(key: int | None) -> int:
    """What a document is for: 0 held out by contract, ``TRAINS``, or ``TRAINS | GIVES_WEIGHTS`` for the deleted part."""
    place = fold(key, FOLDS * DELETED)
    if place % FOLDS == HELD_OUT:
        return 0
    return TRAINS | GIVES_WEIGHTS if place // FOLDS == 0 else TRAINS


def blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """``block, n_keys, keys, null_keys, parts, lengths, words, stream``: documents as numbers of distinct words."""
    kinds = pa.schema(
        [("block", pa.int64()), ("n_keys", pa.int64())]
        + [(n, pa.binary()) for n in ("keys", "null_keys", "parts", "lengths", "words", "stream")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = kept("word hashes", WordHashes), TaskContext.get().partitionId() << 32
        for batch in slices(batches, limit=block_bytes):
            split = [words_of(t) if t else [] for t in batch.column("text").to_pylist()]
            keys = batch.column("doc_id").to_pylist()
            distinct, stream = np.unique(hashes([w for words in split for w in words]), return_inverse=True)
            row = {
                "block": number,
                "n_keys": len(distinct) + len(stream),
                "keys": np.array([k or 0 for k in keys], "<i8").tobytes(),
                "null_keys": bytes(k is None for k in keys),
                "parts": bytes(map(part_of, keys)),
                "lengths": packed(np.array([len(w) for w in split], np.uint32)),
                "words": packed(np.diff(distinct, prepend=np.uint64(0))),
                "stream": packed(stream.astype(np.uint32)),
            }
            number += 1
            yield pa.RecordBatch.from_pylist([row], kinds)

    schema = "block bigint, n_keys bigint, keys binary, null_keys binary, parts binary, lengths binary, words binary, stream binary"
    return id_and_text(docs).mapInArrow(run, schema)


@dataclass
class Block:
    """A block with its tokens as places in the sorted hashes of its words and pairs."""

    keys: list[int | None]
    train: np.ndarray
    deleted: np.ndarray
    document: np.ndarray
    words: np.ndarray
    word: np.ndarray
    before: np.ndarray
    starts: np.ndarray
    pairs: np.ndarray
    pair: np.ndarray

    @classmethod
    def of(cls, row: dict, only: int = 0) -> Block:
        """The block of a row; with ``only`` that of its documents in this part, and of their words alone."""
        lengths = unpacked(row["lengths"], np.uint32).astype(np.int64)
        known = np.cumsum(unpacked(row["words"], np.uint64), dtype=np.uint64)
        stream = unpacked(row["stream"], np.uint32).astype(np.int64)
        ids, nulls, parts = np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["null_keys"], np.uint8), np.frombuffer(row["parts"], np.uint8)
        if only:
            chosen = (parts & only) > 0
            stream = stream[np.repeat(chosen, lengths)]
            lengths, ids, nulls, parts = lengths[chosen], ids[chosen], nulls[chosen], parts[chosen]
            used, stream = np.unique(stream, return_inverse=True)
            known = known[used]
        n_words = len(known)
        words = np.concatenate([known, np.array([_END], np.uint64)])
        document = np.repeat(np.arange(len(lengths)), lengths + 1)
        ends = np.cumsum(lengths + 1) - 1
        word = np.full(len(document), n_words, np.int64)
        inner = np.ones(len(document), bool)
        inner[ends] = False
        word[inner] = stream
        starts = np.zeros(len(document), bool)
        starts[ends - lengths] = True
        before = np.concatenate([[n_words], word[:-1]])
        before[starts] = n_words  # a begin occurs as often as an end
        code = np.where(starts, n_words + 1, before) * (n_words + 2) + word
        codes, pair = np.unique(code, return_inverse=True)
        head = np.concatenate([words, np.array([_BEGIN], np.uint64)])
        pairs = mix(head[codes // (n_words + 2)] * _FIRST + mix(words[codes % (n_words + 2)] * _SECOND))
        # Both lists in the order of their hashes.
        by_word, by_pair = np.argsort(words, kind="stable"), np.argsort(pairs, kind="stable")
        place_word, place_pair = np.empty_like(by_word), np.empty_like(by_pair)
        place_word[by_word], place_pair[by_pair] = np.arange(len(words)), np.arange(len(pairs))
        keys = [None if null else k for k, null in zip(ids.tolist(), nulls.tolist(), strict=True)]
        train, deleted = (parts & TRAINS) > 0, (parts & GIVES_WEIGHTS) > 0
        return cls(keys, train, deleted, document, words[by_word], place_word[word], place_word[before], starts, pairs[by_pair], place_pair[pair])

    def lists(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Sorted hashes with their counts in the block's training documents and in the deleted ones, for words and for pairs."""
        counted, gone = self.train[self.document], self.deleted[self.document]
        return [
            (hashes, np.bincount(place[counted], minlength=len(hashes)), np.bincount(place[gone], minlength=len(hashes)))
            for hashes, place in ((self.words, self.word), (self.pairs, self.pair))
        ]


def _bounds(buckets: int) -> np.ndarray:
    """First hash of every bucket but the first."""
    return np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)


def requests(table: DataFrame, buckets: int) -> DataFrame:
    """``block, length, bucket, hashes, counts, gone``: each block's lists, cut into buckets of the hash space."""
    names = ["block", "length", "bucket", "hashes", "counts", "gone"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _bounds(buckets)
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                rows = []
                for length, (hashes, counts, gone) in enumerate(Block.of(row).lists(), 1):
                    cuts = [0, *np.searchsorted(hashes, bounds).tolist(), len(hashes)]
                    for bucket, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        if b > a:
                            steps = np.diff(hashes[a:b], prepend=np.uint64(0))
                            own = (packed(x[a:b].astype(np.uint32)) for x in (counts, gone))
                            rows.append((row["block"], length, bucket, packed(steps), *own))
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return table.mapInArrow(run, "block bigint, length int, bucket int, hashes binary, counts binary, gone binary")


def answers(asked: DataFrame) -> DataFrame:
    """``block, length, bucket, totals, retained, n, distinct, n_retained``.

    ``totals`` follow the asking list, ``retained`` those of its entries that occur in the block's deleted documents.
    The last three are the bucket's own facts, on the first of its rows only.
    """
    schema = "block bigint, length int, bucket int, totals binary, retained binary, n bigint, distinct bigint, n_retained bigint"
    names = ["block", "length", "bucket", "totals", "retained", "n", "distinct", "n_retained"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def count(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        parts = [np.cumsum(unpacked(r["hashes"], np.uint64), dtype=np.uint64) for r in rows]
        own = np.concatenate([unpacked(r["counts"], np.uint32) for r in rows]).astype(np.float64)
        gone = np.concatenate([unpacked(r["gone"], np.uint32) for r in rows])
        hashes, where = np.unique(np.concatenate(parts), return_inverse=True)
        totals = np.bincount(where, own, len(hashes)).astype(np.int64)
        retained = totals - np.bincount(where, gone, len(hashes)).astype(np.int64)
        out, at = [], 0
        for i, (r, size) in enumerate(zip(rows, map(len, parts), strict=True)):
            mine, asks = where[at : at + size], gone[at : at + size] > 0
            at += size
            facts = (int(totals.sum()), int((totals > 0).sum()), int(retained.sum())) if i == 0 else (0, 0, 0)
            out.append((r["block"], r["length"], r["bucket"], packed(totals[mine]), packed(retained[mine[asks]]), *facts))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return asked.groupBy("length", "bucket").applyInArrow(count, schema)


def _joined(right: pa.Table, column: str) -> list[np.ndarray]:
    """A block's counts for words and for pairs, put together from the buckets in order."""
    rows = sorted(right.select(["length", "bucket", column]).to_pylist(), key=lambda r: (r["length"], r["bucket"]))
    return [np.concatenate([unpacked(r[column], np.int64) for r in rows if r["length"] == length]) for length in (1, 2)]


def context_bucket(counts: np.ndarray) -> np.ndarray:
    """0 for an unseen context, then one bucket for each doubling."""
    return np.minimum(np.ceil(np.log2(np.maximum(counts, 0) + 1.0)).astype(np.int64), CONTEXT_BUCKETS - 1)


def _parts(block: Block, words: np.ndarray, pairs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every token: count, context bucket, and the two maximum-likelihood estimates."""
    count, context, both = words[block.word], words[block.before], pairs[block.pair]
    return count, context_bucket(context), both / np.maximum(context, 1), count / max(n, 1)


def held_out_histogram(table: DataFrame, replies: DataFrame, n_retained: int) -> DataFrame:
    """``bucket, two, one, n, sum_two, sum_one``: held-out tokens by context bucket and by steps of both estimates."""
    schema = "bucket bigint, two bigint, one bigint, n bigint, sum_two double, sum_one double"

    def step(p: np.ndarray) -> np.ndarray:
        return np.where(p > 0, np.round(-8 * np.log2(np.maximum(p, 1e-30))).astype(np.int64), -1)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[np.ndarray] = []
        if left.num_rows and right.num_rows:
            # The entries that occur in deleted documents, in the order of their hashes, are what was answered.
            block = Block.of(left.to_pylist()[0], GIVES_WEIGHTS)
            if len(block.keys):
                _, bucket, two, one = _parts(block, *_joined(right, "retained"), n_retained)
                code = (bucket << 40) + ((step(two) + 1) << 20) + step(one) + 1
                codes, where = np.unique(code, return_inverse=True)
                found = [codes, np.bincount(where, minlength=len(codes)), np.bincount(where, two), np.bincount(where, one)]
        codes, n, s2, s1 = found or [np.empty(0, np.int64)] * 4
        columns = [codes >> 40, ((codes >> 20) & 0xFFFFF) - 1, (codes & 0xFFFFF) - 1, n.astype(np.int64), s2.astype(float), s1.astype(float)]
        return pa.table([pa.array(c) for c in columns], names=["bucket", "two", "one", "n", "sum_two", "sum_one"])

    grouped = table.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(count, schema)
    sums = [F.sum(c).alias(c) for c in ("n", "sum_two", "sum_one")]
    return grouped.groupBy("bucket", "two", "one").agg(*sums)


def mixture_weights(histogram: list[tuple[int, int, float, float]], distinct: int, iterations: int = ITERATIONS) -> np.ndarray:
    """Weights (pair, word, uniform) of each context bucket by expectation-maximisation.

    Rows: bucket, tokens, mean pair estimate, mean word estimate. A bucket without held-out tokens takes the weights
    learned over all of them; an unseen context has no pair estimate, so its weight goes to the other two.
    """
    weights = np.full((CONTEXT_BUCKETS, 3), 1 / 3)
    uniform = 1.0 / (distinct + 1)

    def learned(rows: list[tuple[int, int, float, float]], start: np.ndarray) -> np.ndarray:
        n = np.array([r[1] for r in rows], float)
        p = np.array([[r[2], r[3], uniform] for r in rows])
        mix_ = start
        for _ in range(iterations):
            share = p * mix_
            share /= share.sum(1, keepdims=True)
            mix_ = (share * n[:, None]).sum(0) / n.sum()
            mix_ = np.maximum(mix_, [0, 0, 1e-9])
            mix_ /= mix_.sum()
        return mix_

    if histogram:
        weights[:] = learned(histogram, weights[0])
        for b in {r[0] for r in histogram}:
            weights[b] = learned([r for r in histogram if r[0] == b], np.full(3, 1 / 3))
    weights[0, 0] = 0.0
    weights[0] = weights[0] / weights[0].sum() if weights[0].sum() else [0, 0, 1]
    return weights


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every document."""
    sizes = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    table = durable(blocks(docs, min(block_bytes, max(1, sizes // LEAST_BLOCKS))), "lm_blocks")
    keys = table.agg(F.sum("n_keys")).first()[0] or 0
    replies = durable(answers(requests(table, max(8, -(-keys // KEYS_A_BUCKET)))), "lm_answers")
    facts = replies.where("length = 1").agg(F.sum("n"), F.sum("distinct"), F.sum("n_retained")).first()
    n, distinct, n_retained = (int(x or 0) for x in facts)
    rows = held_out_histogram(table, replies, n_retained).collect()  # bounded by buckets and steps, not by the corpus
    weights = mixture_weights([(r["bucket"], r["n"], r["sum_two"] / r["n"], r["sum_one"] / r["n"]) for r in rows], distinct)
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        block = Block.of(left.to_pylist()[0])
        count, bucket, two, one = _parts(block, *_joined(right, "totals"), n)
        mixture = weights[bucket]
        p = mixture[:, 0] * two + mixture[:, 1] * one + mixture[:, 2] / (distinct + 1)
        base = np.log10((count + ADDED) / (n + ADDED * (distinct + 1)))
        size = len(block.keys)
        return pa.table(
            {
                "doc_id": pa.array(block.keys, pa.int64()),
                "held_out": pa.array(~block.train),
                "n_tokens": pa.array(np.bincount(block.document, minlength=size)),
                "n_known": pa.array(np.bincount(block.document, count > 0, size).astype(np.int64)),
                "train_tokens": pa.array(np.full(size, n, np.int64)),
                "base_score": pa.array(np.bincount(block.document, base, size)),
                "score": pa.array(np.bincount(block.document, np.log10(p), size)),
            }
        )

    return table.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(scored, schema)
