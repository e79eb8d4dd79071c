"""Benchmark decontamination by a BM25 index of the test items and block-max WAND.

An item leaks if the document, taken whole, holds 80 % of its shingles of five terms, or 80 % of its question's and of
its answer's, wherever they stand. Every document asks the inverted index with its passages: the terms of all stretches
that some item has a shingle of. A document without any such stretch has nothing to ask, since terms outside of shingles
count for no leak. Block-max WAND returns every item at or above a threshold. Impacts are divided by the score that an
item has with itself, so one threshold serves all items; it is lowered to the least score that a leak of any item can
have. What is returned, and nothing else, is verified on the shingles themselves, over the whole document.

Terms are lower-cased runs of letters and digits. The question is an item's first line, the answer is the rest. A part
of fewer than five terms is one shingle; an item without terms matches nothing. Items are indexed in shards of bounded
size, one pass over the documents each, so that the broadcast index is bounded whatever the size of the test set.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.texts import id_and_text, keep_rows, kept, map_texts, mix
from pageloom.storage import durable

TERM = re.compile(r"[^\W_]+")
K1, B = 1.2, 0.75
#: Share of an item's own score; less where the shingles that a leak may lack hold more than the rest of it.
RETRIEVE = 0.5
OVERLAP = 0.8
SHINGLE = 5
BLOCK = 16
SHARD_CHARS = 20_000_000
REMEMBERED = 150_000
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def terms_of(text: str) -> list[str]:
    return TERM.findall(text.lower())


def shingles(terms: list[int], size: int = SHINGLE) -> set[tuple[int, ...]]:
    return {tuple(terms[i : i + size]) for i in range(len(terms) - size + 1)} or ({tuple(terms)} if terms else set())


def held(wanted: set[tuple[int, ...]], found: set[tuple[int, ...]]) -> float:
    """Share of the wanted shingles that are among those found; 1 if none is wanted."""
    return len(wanted & found) / len(wanted) if wanted else 1.0


def covered(wanted: set[tuple[int, ...]], terms: list[int]) -> float:
    """Share of the wanted shingles that occur in the terms; 1 if none is wanted."""
    found: set[tuple[int, ...]] = set()
    for size in {len(w) for w in wanted}:
        found |= {tuple(terms[i : i + size]) for i in range(len(terms) - size + 1)}
    return held(wanted, found)


def gram_hashes(terms: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` terms from every place on."""
    count = max(0, len(terms) - size + 1)
    out = np.full(count, size, np.uint64)
    for i in range(size):
        out = mix(out * _FACTOR + terms[i : i + count].astype(np.uint64))
    return out


class _Words(dict):
    """Term number of a chunk between blanks; -1 for a chunk without terms, below that the place of its several terms."""

    def __init__(self, numbers: dict[str, int]) -> None:
        self.numbers, self.several = numbers, []

    def __missing__(self, chunk: str) -> int:
        terms = [chunk.lower()] if chunk.isalpha() else terms_of(chunk)
        if len(terms) == 1:
            code = self.numbers.get(terms[0], 0)
        elif not terms:
            code = -1
        else:
            self.several.append([self.numbers.get(t, 0) for t in terms])
            code = -1 - len(self.several)
        self[chunk] = code
        return code

    def terms(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Term numbers of all texts in a row, and where each text's end."""
        code = self.__getitem__
        split = [t.split() if t else [] for t in texts]
        codes = np.fromiter(chain.from_iterable(map(code, words) for words in split), np.int64, sum(map(len, split)))
        size = np.ones(len(codes), np.int64)
        size[codes == -1] = 0
        odd = np.flatnonzero(codes < -1)
        size[odd] = [len(self.several[-2 - c]) for c in codes[odd].tolist()]
        upto = np.concatenate([[0], np.cumsum(size)])
        out = np.zeros(int(upto[-1]), np.int64)
        single = codes >= 0
        out[upto[:-1][single]] = codes[single]
        for at, c in zip(upto[odd].tolist(), codes[odd].tolist(), strict=True):
            own = self.several[-2 - c]
            out[at : at + len(own)] = own
        return out, upto[np.cumsum([len(w) for w in split], dtype=np.int64)] if split else upto[:0]


@dataclass
class Index:
    """Postings by term number (from 1; 0 is any other term), items in ascending place."""

    item_ids: list[int | None]
    numbers: dict[str, int]
    parts: list[tuple[list[int], list[int]]]
    starts: np.ndarray
    items: np.ndarray
    impacts: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple[int | None, str | None]]) -> Index:
        numbers: dict[str, int] = {}
        ids, parts, counted = [], [], []
        for key, text in rows:
            question, _, answer = (text or "").strip().partition("\n")
            q, a = ([numbers.setdefault(t, len(numbers) + 1) for t in terms_of(part)] for part in (question, answer))
            if q or a:
                ids.append(key)
                parts.append((q, a))
                counted.append(np.unique(np.array(q + a, np.int64), return_counts=True))
        lengths = np.array([len(q) + len(a) for q, a in parts], np.float64)
        n_terms = len(numbers) + 1
        term = np.concatenate([t for t, _ in counted]) if counted else np.empty(0, np.int64)
        tf = np.concatenate([c for _, c in counted]) if counted else np.empty(0, np.int64)
        item = np.repeat(np.arange(len(ids)), [len(t) for t, _ in counted])
        df = np.bincount(term, minlength=n_terms)
        idf = np.log1p((len(ids) - df + 0.5) / (df + 0.5))
        scale = K1 * (1 - B + B * lengths / lengths.mean()) if len(ids) else lengths
        impact = idf[term] * tf * (K1 + 1) / (tf + scale[item])
        own = np.bincount(item, impact, len(ids))
        impact = impact / own[item]
        order = np.lexsort((item, term))
        starts = np.concatenate([[0], np.cumsum(df)])
        return cls(ids, numbers, parts, starts, item[order], impact[order])

    def grams(self) -> dict[int, np.ndarray]:
        """For every size of shingle the sorted hashes of all items' shingles and of their questions' and answers'."""
        if getattr(self, "_grams", None) is None:
            by_size: dict[int, list[np.ndarray]] = {}
            for q, a in self.parts:
                for terms in (q + a, q, a):
                    if terms:
                        size = min(SHINGLE, len(terms))
                        by_size.setdefault(size, []).append(gram_hashes(np.array(terms, np.int64), size))
            self._grams = {size: np.unique(np.concatenate(found)) for size, found in by_size.items()}
        return self._grams

    def least(self, overlap: float = OVERLAP) -> float:
        """The least score of a leak of any item: what is left without the shingles that a leak may lack.

        A term goes only with all shingles that hold it, so a shingle takes its share of each of its terms at most.
        """
        known = getattr(self, "_least", None) or {}
        if overlap not in known:
            term = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
            order = np.argsort(self.items, kind="stable")
            ends = np.cumsum(np.bincount(self.items, minlength=len(self.parts)))
            least = 1.0

            def loss(terms: list[int], impacts: dict[int, float]) -> float:
                wanted = [set(s) for s in shingles(terms)]
                holders = Counter(chain.from_iterable(wanted))
                lost = sorted((sum(impacts[t] / holders[t] for t in s) for s in wanted), reverse=True)
                return sum(lost[: int(len(wanted) * (1 - overlap) + 1e-9)])

            for i, (q, a) in enumerate(self.parts):
                own = order[ends[i] - len(set(q + a)) : ends[i]]
                mine = dict(zip(term[own].tolist(), self.impacts[own].tolist(), strict=True))
                least = min(least, 1 - max(loss(q + a, mine), loss(q, mine) + loss(a, mine)))
            known[overlap] = least
            self._least = known
        return known[overlap]

    def words(self) -> _Words:
        memory = kept("terms of chunks", dict)
        if memory.get("of") is not self or len(memory["words"]) > REMEMBERED:
            memory.update(of=self, words=_Words(self.numbers))
        return memory["words"]

    def postings(self) -> list[tuple[list[int], list[float], list[float], float]]:
        """For every term its items, impacts, the largest impact of each block, and the largest of all."""
        if getattr(self, "_postings", None) is None:
            self._postings = []
            for a, b in zip(self.starts[:-1].tolist(), self.starts[1:].tolist(), strict=True):
                items, impacts = self.items[a:b].tolist(), self.impacts[a:b].tolist()
                blocks = [max(impacts[i : i + BLOCK]) for i in range(0, len(impacts), BLOCK)]
                self._postings.append((items, impacts, blocks, max(blocks, default=0.0)))
        return self._postings

    def __getstate__(self) -> dict:
        names = ("item_ids", "numbers", "parts", "starts", "items", "impacts", "_least")
        return {n: getattr(self, n, None) for n in names}


def wand(index: Index, query: list[int], threshold: float = RETRIEVE) -> list[tuple[int, float]]:
    """All items whose impacts over the query's distinct terms add up to the threshold, by block-max WAND."""
    postings = index.postings()
    need = threshold - 1e-9
    # A cursor: the item it stands at, its place, and the term's lists.
    cursors = [[postings[t][0][0], 0, *postings[t]] for t in dict.fromkeys(query) if t and postings[t][0]]
    found: list[tuple[int, float]] = []

    def move(cursor: list, item: int) -> bool:
        """To the first posting of at least ``item``; whether there is one."""
        at = bisect_left(cursor[2], item, cursor[1])
        if at == len(cursor[2]):
            return False
        cursor[0], cursor[1] = cursor[2][at], at
        return True

    cursors.sort(key=_item)
    while True:
        bound, pivot = 0.0, -1
        for i, cursor in enumerate(cursors):
            bound += cursor[5]
            if bound >= need:
                pivot = i
                break
        if pivot < 0:
            return found
        item = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
            pivot += 1
        # The blocks in which the pivot's item would lie, list by list.
        block, onward = 0.0, cursors[pivot + 1][0] if pivot + 1 < len(cursors) else None
        for cursor in cursors[: pivot + 1]:
            at = cursor[1] if cursor[0] == item else bisect_left(cursor[2], item, cursor[1])
            if at < len(cursor[2]):
                block += cursor[4][at // BLOCK]
                last = cursor[2][min(at - at % BLOCK + BLOCK, len(cursor[2])) - 1] + 1
                onward = last if onward is None else min(onward, last)
        if block < need:
            target = item + 1 if onward is None else max(onward, item + 1)
        elif cursors[0][0] == item:
            score = sum(c[3][c[1]] for c in cursors[: pivot + 1])
            if score >= need:
                found.append((item, score))
            target = item + 1
        else:
            target = item
        cursors = [c for i, c in enumerate(cursors) if i > pivot or c[0] >= target or move(c, target)]
        cursors.sort(key=_item)


_item = itemgetter(0)


def stretches(index: Index, terms: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and sizes of all shingles that some item has, in order. ``stops`` is where each text ends."""
    text = np.repeat(np.arange(len(stops)), np.diff(stops, prepend=0))
    places, sizes = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for size, names in index.grams().items():
        hashes = gram_hashes(terms, size)
        if not len(hashes):
            continue
        inside = text[: len(hashes)] == text[size - 1 :]
        for i in range(size):
            inside &= terms[i : i + len(hashes)] > 0
        place = np.flatnonzero(inside)
        place = place[names[np.searchsorted(names, hashes[place]).clip(max=len(names) - 1)] == hashes[place]]
        places.append(place)
        sizes.append(np.full(len(place), size))
    at, size = np.concatenate(places), np.concatenate(sizes)
    order = np.argsort(at, kind="stable")
    return at[order], size[order]


def leaks(index: Index, texts: list[str | None], threshold: float = RETRIEVE, overlap: float = OVERLAP) -> list[dict[int, tuple]]:
    """For every text: item place -> (score, whole, question and answer overlap)."""
    out: list[dict[int, tuple]] = [{} for _ in texts]
    if not index.item_ids:
        return out
    terms, stops = index.words().terms(texts)
    places, sizes = stretches(index, terms, stops)
    need = max(min(threshold, index.least(overlap)), 1e-8)
    asking = np.unique(np.searchsorted(stops, places, side="right"))
    for text in asking.tolist():
        start, stop = int(stops[text - 1]) if text else 0, int(stops[text])
        own, begin = terms[start:stop].tolist(), np.searchsorted(places, [start, stop])
        grams = {tuple(own[p - start : p - start + n]) for p, n in zip(places[slice(*begin)].tolist(), sizes[slice(*begin)].tolist(), strict=True)}
        for item, score in wand(index, list(chain.from_iterable(sorted(grams))), need):
            question, answer = index.parts[item]
            whole = held(shingles(question + answer), grams)
            in_question, in_answer = held(shingles(question), grams), held(shingles(answer), grams)
            if whole >= overlap or (in_question >= overlap and in_answer >= overlap):
                out[text][item] = score, whole, in_question, in_answer
    return out


def shards(items: DataFrame, shard_chars: int = SHARD_CHARS) -> Iterator[tuple[Index, bool]]:
    """Indexes over all items, each over about ``shard_chars`` characters at most, one at a time; and whether it is the only one."""
    named = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        "text is not null"
    )
    total = named.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    count = max(1, -(-total // shard_chars))
    for shard in range(count):
        own = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == shard) if count > 1 else named
        rows = own.distinct().collect()
        yield Index.build(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))), count == 1


def find_leaks(
    docs: DataFrame, items: DataFrame, threshold: float = RETRIEVE, overlap: float = OVERLAP, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """``doc_id, item_id, score, overlap, question_overlap, answer_overlap`` for every leaked item of every document row.

    Null and empty texts leak nothing. The score is the share of the item's own
    BM25 score that the document reaches with its terms in shingles of the items.
    """
    schema = "doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, answer_overlap double"
    result = None
    for index, alone in shards(items, shard_chars):
        index.least(overlap)  # once, not in every worker
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def work(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch:
            own = shared.value
            rows = [
                (key, own.item_ids[item], *facts)
                for key, mine in zip(
                    batch.column("doc_id").to_pylist(), leaks(own, batch.column("text").to_pylist(), threshold, overlap), strict=True
                )
                for item, facts in sorted(mine.items())
            ]
            names = ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap"]
            kinds = [pa.int64(), pa.int64(), *[pa.float64()] * 4]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        found = map_texts(id_and_text(docs), work, schema)
        if not alone:  # written before the next shard's index is built, so that one index at a time is held
            found = durable(found, "leaks")
            shared.destroy()
        result = found if result is None else result.unionByName(found)
    return result


def without_leaks(
    docs: DataFrame, items: DataFrame, threshold: float = RETRIEVE, overlap: float = OVERLAP, shard_chars: int = SHARD_CHARS
) -> DataFrame:
    """Documents that leak no item, with all their columns."""
    for index, alone in shards(items, shard_chars):
        index.least(overlap)
        shared = docs.sparkSession.sparkContext.broadcast(index)
        docs = keep_rows(docs, lambda texts, shared=shared: np.array([not f for f in leaks(shared.value, texts, threshold, overlap)], bool))
        if not alone:
            docs = durable(docs, "without_leaks")
            shared.destroy()
    return docs
