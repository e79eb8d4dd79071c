"""Token counts of a unigram tokenizer without tokens: best score and piece count by a count-only Viterbi pass.

An Aho-Corasick automaton finds every vocabulary piece that ends at a position; dynamic programming keeps, for each
position, the best score and how many pieces reach it, and nothing to trace back. Rules as the tokenizers library's
unigram model has them: pieces are tried by ascending start, and a later one wins only if it is strictly better, so
that of equal paths the one with the longest last piece stays; a character without a piece of its own is unknown and
scores 10 less than the least piece; unknown neighbours are one token, or their UTF-8 bytes with byte fallback.

Blanks become U+2581, one is put before the text, and the text is cut before each. Chunks repeat, so a worker
remembers their score and count. A null or empty text has no token. Repeated rows give repeated rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pageloom.llm.texts import id_and_text, kept, map_texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 400_000


class _Chunks(dict):
    """Place of a chunk's results; new chunks are measured as they come up."""

    def __init__(self, counter: Counter) -> None:
        self.counter, self.scores, self.counts = counter, [], []

    def __missing__(self, chunk: str) -> int:
        place = self[chunk] = len(self)
        # A chunk that starts with a line end was cut there and has no blank before it.
        score, count = self.counter.measure(chunk if self.counter._cut and chunk[:1] == "\n" else MARK + chunk)
        self.scores.append(score)
        self.counts.append(count)
        return place


@dataclass
class Counter:
    """``pieces``: vocabulary with scores, the unknown piece left out. ``byte_fallback``: all 256 byte pieces are in it."""

    pieces: dict[str, float]
    byte_fallback: bool = True
    _automaton: object = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return {"pieces": self.pieces, "byte_fallback": self.byte_fallback, "_automaton": None}

    def automaton(self) -> object:
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for piece, score in self.pieces.items():
                self._automaton.add_word(piece, (len(piece), score))
            self._automaton.make_automaton()
            self._unknown = min(self.pieces.values()) - UNKNOWN_PENALTY
            # No piece runs over a line end, and unknown bytes add up: a text may be cut there.
            self._cut = self.byte_fallback and not any("\n" in p for p in self.pieces)
        return self._automaton

    def measure(self, chunk: str) -> tuple[float, int]:
        """Best score and piece count of one chunk."""
        n = len(chunk)
        best, count = [0.0] + [None] * n, [0] * (n + 1)
        open_unknown = [False] * (n + 1)
        matches: list[list] = [[] for _ in range(n)]
        for end, found in self.automaton().iter(chunk):  # longest first for each end, that is, by ascending start
            matches[end].append(found)
        for end in range(n):
            top, pieces, single = None, 0, False
            for length, score in matches[end]:
                start = end + 1 - length
                single |= length == 1
                total = best[start] + score
                if top is None or total > top:
                    top, pieces = total, count[start] + 1
            unknown = False
            if not single:
                total = best[end] + self._unknown
                if top is None or total > top:
                    top, unknown = total, True
                    if self.byte_fallback:
                        pieces = count[end] + len(chunk[end].encode("utf-8", "surrogatepass"))
                    else:
                        pieces = count[end] + (not open_unknown[end])
            best[end + 1], count[end + 1], open_unknown[end + 1] = top, pieces, unknown
        return best[n], count[n]

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Best score and number of tokens of each text."""
        self.automaton()
        memory = kept("pieces of chunks", dict)
        if memory.get("of") is not self or len(memory["chunks"]) > REMEMBERED:
            memory.update(of=self, chunks=_Chunks(self))
        chunks = memory["chunks"]
        place = chunks.__getitem__
        split = [self._split(t) if t else [] for t in texts]
        places = np.fromiter(chain.from_iterable(map(place, words) for words in split), np.int64, sum(map(len, split)))
        owner = np.repeat(np.arange(len(texts)), [len(w) for w in split])
        scores, counts = np.array(chunks.scores), np.array(chunks.counts, np.int64)
        if not len(places):
            return np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        return np.bincount(owner, scores[places], len(texts)), np.bincount(owner, counts[places], len(texts)).astype(np.int64)

    def _split(self, text: str) -> list[str]:
        text = text.replace(MARK, " ")
        words = (text.replace("\n", " \n") if self._cut else text).split(" ")
        return words[1:] if text[0] == " " else words


def from_sentencepiece(path: str) -> Counter:
    """The pieces and scores of a SentencePiece file, read as a unigram vocabulary."""
    import sentencepiece

    file = sentencepiece.SentencePieceProcessor(model_file=path)
    size = file.get_piece_size()
    kept = [i for i in range(size) if not file.is_control(i) and not file.is_unknown(i) and not file.is_unused(i)]
    pieces = {file.id_to_piece(i): float(file.get_score(i)) for i in kept}
    return Counter(pieces, byte_fallback=sum(file.is_byte(i) for i in kept) == 256)


def count_pieces(docs: DataFrame, counter: Counter) -> DataFrame:
    """``doc_id, n_tokens, best_score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(counter)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores, counts = shared.value.count(batch.column("text").to_pylist())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts), pa.array(scores)], names=["doc_id", "n_tokens", "best_score"])

    return map_texts(id_and_text(docs), work, "doc_id bigint, n_tokens bigint, best_score double")
