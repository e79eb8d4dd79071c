"""Supervised subword embeddings for document quality.

A document is the average of learned vectors of its features: every word, every run of ``NGRAMS`` bytes inside a
blank-padded word, and every word pair of one word twice, each hashed to one of ``BUCKETS`` rows (all such pairs to the
same). ``PADDING`` features without a vector count along, so that a few odd words don't decide a short text. A linear
layer and a softmax over the two labels follow. Both layers are trained together by stochastic gradient descent in numpy
on a bounded, balanced sample of labelled rows, each read whole. Texts are read in pieces cut between words, so that a
text of any length takes the memory of a piece; a word longer than a piece counts as several.

With a linear output the difference of the two scores is an average of one number for each bucket, so scoring gathers
one number for each feature of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pageloom.llm.cross_parsing import crc_fold
from pageloom.llm.texts import fold, id_and_text, kept, map_texts

NGRAMS = (3, 4)
BUCKETS = 1 << 16
DIMENSIONS = 12
EPOCHS = 6
RATE = 0.5
BATCH = 16
#: Bound of the labelled sample: rows of each label.
SAMPLE_ROWS = 1_200
#: Bytes of text whose features are made at a time.
PIECE = 1 << 18
THRESHOLD = 0.3
PADDING = 40
#: Text to a slice: its feature arrays take some sixty times as much.
SLICE = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PRIME = np.uint32(0x01000193)
_AGAIN = 0x5BD1E995
_BLANKS = b" \t\n\x0b\x0c\r"


def pieces(text: bytes, size: int = PIECE) -> list[bytes]:
    """A text cut behind the last blank of each ``size`` bytes, or after them if there is none."""
    out, at = [], 0
    while len(text) - at > size:
        cut = max(text.rfind(bytes([b]), at, at + size) for b in _BLANKS) + 1
        cut = cut if cut > at else at + size
        out.append(text[at:cut])
        at = cut
    return [*out, text[at:]]


def feature_parts(texts: list[str], size: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of features and the texts they belong to, for about ``size`` bytes of text at a time, all of them together once."""
    held, owners, total = [], [], 0
    for place, text in enumerate(texts):
        last = b""
        for piece in pieces(text.encode("utf-8", "surrogatepass"), size):
            if last[-1:].isspace() and piece.split(None, 1)[:1] == last.rsplit(None, 1)[-1:]:
                yield np.array([_bucket(np.array([_AGAIN], np.uint32))[0]]), np.array([place])  # a pair that the cut parted
            last = piece if piece.strip(_BLANKS) else last
            held.append(piece)
            owners.append(place)
            total += len(piece)
            if total >= size:
                buckets, own = features(held)
                yield buckets, np.array(owners)[own]
                held, owners, total = [], [], 0
    if held:
        buckets, own = features(held)
        yield buckets, np.array(owners)[own]


def _bucket(hashed: np.ndarray) -> np.ndarray:
    hashed = hashed ^ (hashed >> np.uint32(15))
    hashed = hashed * np.uint32(0x2C1B3C6D)
    return ((hashed ^ (hashed >> np.uint32(13))) & np.uint32(BUCKETS - 1)).astype(np.int32)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the texts, and the text that each belongs to."""
    raw = [b" " + t + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.cumsum([len(r) for r in raw])
    blank = _BLANK[data]
    data32 = np.where(blank, 32, data).astype(np.uint32)
    owner = np.repeat(np.arange(len(raw), dtype=np.int32), np.diff(ends, prepend=0))
    buckets, owners = [], []

    def keep(hashed: np.ndarray, at: np.ndarray) -> None:
        buckets.append(_bucket(hashed))
        owners.append(owner[at])

    # Runs that hold no blank but at their ends, and not blanks alone.
    inner_blank = np.concatenate([[0], np.cumsum(blank)])
    for n in NGRAMS:
        if len(data) < n:
            continue
        at = np.arange(len(data) - n + 1)
        blanks = inner_blank[at + n - 1] - inner_blank[at + 1] if n > 2 else np.zeros(len(at), np.int64)
        at = at[(blanks == 0) & ~(blank[at] & blank[at + n - 1])]
        hashed = np.full(len(at), 0x811C9DC5 + n, np.uint32)
        for k in range(n):
            hashed = (hashed ^ data32[at + k]) * _PRIME
        keep(hashed, at)
    # A word's hash: its bytes, each weighed by the powers of an odd number from the word's first byte on.
    edge = np.flatnonzero(np.diff(blank.astype(np.int8)))
    first, stop = edge[::2] + 1, edge[1::2] + 1
    if len(first):
        place = np.arange(len(data)) - np.repeat(np.concatenate([[0], first]), np.diff(np.concatenate([[0], first, [len(data)]])))
        powers = np.cumprod(np.full(int((stop - first).max()), 0x9E3779B1, np.uint32), dtype=np.uint32)
        weighed = np.where(blank, np.uint32(0), (data32 + np.uint32(1)) * powers[np.minimum(place, len(powers) - 1)])
        sums = np.concatenate([[0], np.cumsum(weighed, dtype=np.uint32)]).astype(np.uint32)
        words = sums[stop] - sums[first] + (stop - first).astype(np.uint32)
        keep(words, first)
        again = first[1:][(words[1:] == words[:-1]) & (owner[first[1:]] == owner[first[:-1]])]
        keep(np.full(len(again), _AGAIN, np.uint32), again)
    if not buckets:
        return np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(buckets), np.concatenate(owners)


@dataclass
class Classifier:
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray

    def margins(self) -> np.ndarray:
        """What one feature of each bucket adds to the score difference, before averaging."""
        return (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float32)

    def score(self, texts: list[str], margins: np.ndarray | None = None) -> np.ndarray:
        """Probability of label 1. A text without features has nothing but the bias."""
        kept("quality", dict)  # another operator's memory goes first
        margins = self.margins() if margins is None else margins
        sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
        for buckets, owners in feature_parts(texts):
            sums += np.bincount(owners, margins[buckets], len(texts))
            counts += np.bincount(owners, minlength=len(texts))
        logit = sums / (counts + PADDING) + float(self.bias[1] - self.bias[0])
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that a whole text has features in, and how many."""
    times = np.zeros(BUCKETS, np.int64)
    for buckets, _ in feature_parts([text]):
        times += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(times)
    return used, times[used]


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> Classifier:
    """Train on the texts' bags by stochastic gradient descent with a falling rate; both labels weigh the same in total."""
    labels = np.asarray(labels, np.int64)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    output = np.zeros((DIMENSIONS, 2), np.float32)
    bias = np.zeros(2, np.float32)
    counts = np.bincount(labels, minlength=2)
    if counts.min() == 0:  # one label or none: its prior is all there is to learn
        bias[:] = np.log(counts + 1.0)
        return Classifier(vectors, output, bias)
    weight = (len(labels) / (2.0 * counts))[labels].astype(np.float32)
    rows = [(used, (times / (times.sum() + PADDING)).astype(np.float32)) for used, times in bags]
    steps, done = epochs * -(-len(rows) // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            chosen = order[start : start + BATCH]
            lr = rate * (1 - done / steps)
            done += 1
            sizes = [len(rows[i][0]) for i in chosen]
            used = np.concatenate([rows[i][0] for i in chosen])
            share = np.concatenate([rows[i][1] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), sizes)
            hidden = np.zeros((len(chosen), DIMENSIONS), np.float32)
            gathered = vectors[used] * share[:, None]
            for d in range(DIMENSIONS):
                hidden[:, d] = np.bincount(owner, gathered[:, d], len(chosen))
            logits = hidden @ output + bias
            logits -= logits.max(1, keepdims=True)
            p = np.exp(logits)
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            p *= weight[chosen, None]
            back = p @ output.T
            output -= lr * hidden.T @ p
            bias -= lr * 0.1 * p.sum(0)
            # The average makes each feature's gradient tiny, so vectors take a larger step.
            steps_back = (lr * 20) * share[:, None] * back[owner]
            for d in range(DIMENSIONS):
                vectors[:, d] -= np.bincount(used, steps_back[:, d], BUCKETS)
    return Classifier(vectors, output, bias)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
    folds: int = 5,
    held_out: int = 0,
) -> Classifier:
    """A classifier from labelled rows outside the held-out fold.

    Of each label at most ``sample_rows`` rows are learned, those with the
    smallest hashes, whole. Of several texts under one id the smallest is learned.
    Rows without a label of 0 or 1, or without text, teach nothing. Features are made
    in the tasks; the driver takes their numbers, at most one for each bucket and row.
    """
    marked = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (crc_fold(F.col("doc_id"), folds) != held_out))
        .dropDuplicates(["doc_id", "y"])
        .withColumn("h", F.xxhash64("doc_id"))
    )
    unit = 1 << 30
    rows = F.broadcast(marked.groupBy("y").count())  # two rows at most
    near = marked.join(rows, "y").where(F.pmod("h", F.lit(unit)) * F.col("count") < F.lit(2.0 * unit * sample_rows))
    # At most four times ``sample_rows`` rows are expected here, whatever the size of the tables.
    whole = id_and_text(docs).where("text is not null").join(F.broadcast(near.select("doc_id", "y", "h")), "doc_id")
    single = whole.groupBy("doc_id", "y", "h").agg(F.min("text").alias("text"))
    order = Window.partitionBy("y").orderBy("h", "doc_id")
    chosen = single.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_rows)

    def bags(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [bag(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array([x.astype("<u4").tobytes() for x in part], pa.binary()) for part in zip(*found, strict=True)]
        return pa.RecordBatch.from_arrays([batch.column("y"), batch.column("place"), *columns], ["y", "place", "used", "times"])

    made = map_texts(chosen.select("y", "place", "text"), bags, "y int, place int, used binary, times binary", limit=SLICE)
    taken = sorted(made.collect(), key=lambda r: (r["y"], r["place"]))
    return fit([tuple(np.frombuffer(r[c], "<u4").astype(np.int64) for c in ("used", "times")) for r in taken], np.array([r["y"] for r in taken], np.int64))


def classify(docs: DataFrame, model: Classifier, threshold: float = THRESHOLD, folds: int = 5, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document.

    Null and empty texts get the score of a text without features. Repeated rows
    give repeated rows; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, model.margins()))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, margins = shared.value
        score = own.score([t or "" for t in batch.column("text").to_pylist()], margins)
        held = [fold(k, folds) == held_out for k in batch.column("doc_id").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(held, pa.bool_()), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            names=["doc_id", "held_out", "score", "predicted"],
        )

    return map_texts(id_and_text(docs), work, "doc_id bigint, held_out boolean, score double, predicted int", limit=SLICE)
