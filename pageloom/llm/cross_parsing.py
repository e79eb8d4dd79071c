"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language knows every substring of it. A document is parsed against each
automaton from left to right into phrases, each the longest match from where the last one ended; an unseen symbol is a
phrase of its own. The language that needs the fewest phrases wins, each weighed by the logarithm of the length of that
language's labelled text, so that a language known from more text isn't favoured for it.

Texts are parsed whole, in segments of ``SEGMENT`` symbols (a phrase ends with its segment), many segments abreast in
numpy. Symbols are lower-cased letters; a run of anything else is one blank. The most common letters of the sample are
one symbol each, every other one that occurs in it is two symbols or more, so that tables stay narrow in any script.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.texts import fold, id_and_text, kept, map_texts

SEGMENT = 1024
#: Bounds of the labelled sample: documents for each language, and symbols that they contribute.
SAMPLE_DOCS = 400
SAMPLE_SYMBOLS = 40_000
#: Languages learned: those with most labelled documents. A label column with more values is no column of languages.
MOST_LANGUAGES = 300
#: Letters that are one symbol, and digits that the number of any other letter of the sample is written in.
SYMBOLS, DIGITS = 60, 32
UNDETERMINED = "und"
_BLANK, _OTHER = 1, 2


def crc_fold(key: Column, parts: int) -> Column:
    """``texts.fold`` as a column."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit("null"))) % parts).cast("int")


_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Whether a code point is a letter."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def has_letter(text: str | None) -> bool:
    return bool(text) and bool(letters()[code_points(text)].any())


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


@dataclass
class Model:
    """Labelled sample: a symbol's number by code point, the symbols of each language's text, and the other letters in order."""

    alphabet: dict[int, int]
    texts: dict[str, np.ndarray]
    _tables: tuple | None = field(default=None, repr=False)
    rare: list[int] = field(default_factory=list)

    @property
    def languages(self) -> list[str]:
        return sorted(self.texts)

    def symbols(self, text: str) -> np.ndarray:
        points = code_points(text)
        coded = self.coder()[points]
        keep = np.ones(len(coded), bool)
        keep[1:] = (coded[1:] != _BLANK) | (coded[:-1] != _BLANK)
        coded = coded[keep]
        if not self.rare:
            return coded
        place = np.flatnonzero(coded == _OTHER)
        rank = self.ranks()[points[keep][place]]
        place, rank = place[rank >= 0], rank[rank >= 0]
        n = 2
        while DIGITS**n < len(self.rare):
            n += 1
        size = np.ones(len(coded), np.int64)
        size[place] = n
        out, ends = np.repeat(coded, size), np.cumsum(size)[place]
        for i in range(n):
            out[ends - 1 - i] = self.first_digit + rank // DIGITS**i % DIGITS
        return out

    @property
    def first_digit(self) -> int:
        return max(self.alphabet.values(), default=_OTHER) + 1

    def ranks(self) -> np.ndarray:
        if getattr(self, "_ranks", None) is None:
            self._ranks = np.full(0x110000, -1, np.int32)
            self._ranks[self.rare] = np.arange(len(self.rare))
        return self._ranks

    def coder(self) -> np.ndarray:
        if getattr(self, "_coder", None) is None:
            table = np.where(letters(), _OTHER, _BLANK).astype(np.uint8)
            for point, number in self.alphabet.items():
                table[point] = number
            self._coder = table
        return self._coder

    def automata(self) -> tuple[np.ndarray, np.ndarray, int]:
        """All transition tables in a row, the place of each root, and symbols to a state."""
        if self._tables is None:
            width = self.first_digit + (DIGITS if self.rare else 0)
            tables, roots, at = [], [], 0
            for language in self.languages:
                own = suffix_automaton(self.texts[language], width)
                own[own > 0] += at
                tables.append(own)
                roots.append(at)
                at += len(own)
            self._tables = np.concatenate(tables), np.array(roots, np.int32), width
        return self._tables

    def __getstate__(self) -> dict:
        return {"alphabet": self.alphabet, "texts": self.texts, "_tables": None, "rare": self.rare}


def suffix_automaton(symbols: np.ndarray, width: int) -> np.ndarray:
    """Transitions as one array: entry ``state * width + symbol`` is the next state times ``width``; 0 is none.

    The root is state 0. Symbol 0 parts documents and has no transitions, so no match runs over it.
    """
    target: list[dict[int, int]] = [{}]
    length, link = [0], [-1]
    last = 0
    for symbol in symbols.tolist():
        if symbol == 0:
            last = 0
            continue
        if symbol in target[last] and length[target[last][symbol]] == length[last] + 1:
            last = target[last][symbol]  # known substring: the generalised automaton has this state
            continue
        here = len(target)
        target.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in target[at]:
            target[at][symbol] = here
            at = link[at]
        if at >= 0:
            after = target[at][symbol]
            if length[after] == length[at] + 1:
                link[here] = after
            else:
                clone = len(target)
                target.append(dict(target[after]))
                length.append(length[at] + 1)
                link.append(link[after])
                while at >= 0 and target[at].get(symbol) == after:
                    target[at][symbol] = clone
                    at = link[at]
                link[after] = clone
                link[here] = clone
        last = here
    table = np.zeros(len(target) * width, np.int32)
    for state, edges in enumerate(target):
        for symbol, to in edges.items():
            table[state * width + symbol] = to * width
    return table


def phrase_counts(texts: list[np.ndarray], model: Model) -> np.ndarray:
    """Phrases of every text (rows) against every language (columns)."""
    table, roots, _ = model.automata()
    sizes = np.array([len(t) for t in texts], np.int64)
    flat = np.concatenate(texts) if len(texts) else np.empty(0, np.uint8)
    per_text = -(-sizes // SEGMENT)
    owner = np.repeat(np.arange(len(texts)), per_text)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = (np.cumsum(sizes) - sizes)[owner] + nth * SEGMENT
    size = np.minimum(sizes[owner] - nth * SEGMENT, SEGMENT)
    order = np.argsort(-size, kind="stable")
    begin, size, owner = begin[order], size[order], owner[order]
    counts = np.zeros((len(roots), len(owner)), np.int32)
    state = np.repeat(roots[:, None], len(owner), 1)
    base = roots[:, None]
    for step in range(int(size[0]) if len(size) else 0):
        live = int(np.searchsorted(-size, -step, side="left"))
        symbol = flat[begin[:live] + step].astype(np.int32)
        now = state[:, :live]
        onward = table.take(now + symbol)
        dead = onward == 0
        counts[:, :live] += dead | (now == base)
        fresh = table.take(base + symbol)
        np.copyto(onward, np.where(fresh == 0, base, fresh), where=dead)
        state[:, :live] = onward
    out = np.zeros((len(roots), len(texts)), np.int64)
    for row in range(len(roots)):
        out[row] = np.bincount(owner, counts[row], len(texts)).astype(np.int64)
    return out.T


def build(samples: dict[str, list[str]], limit: int = SAMPLE_SYMBOLS) -> Model:
    """A model from texts by language, about ``limit`` symbols of each, as evenly from its texts as their lengths allow."""
    seen: Counter[int] = Counter()
    known = letters()
    for texts in samples.values():
        for text in texts:
            points, counts = np.unique(code_points(text), return_counts=True)
            seen.update({int(p): int(n) for p, n in zip(points, counts, strict=True) if known[p]})
    ranked = sorted(seen, key=lambda p: (-seen[p], p))
    model = Model({p: _OTHER + 1 + i for i, p in enumerate(ranked[:SYMBOLS])}, {}, rare=ranked[SYMBOLS:])
    for language, texts in samples.items():
        found = [model.symbols(text) for text in texts]
        share = window([len(f) for f in found], limit)  # of each text, so that every one is learned from
        parts = [part for f in found for part in (f[:share], np.zeros(1, np.uint8))]
        if any(map(len, found)):
            model.texts[language] = np.concatenate(parts)
    return model


def train(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_symbols: int = SAMPLE_SYMBOLS, folds: int = 3, held_out: int = 1
) -> Model:
    """A model from a bounded sample of the labelled documents outside the held-out fold.

    Every language gives at most ``sample_docs`` distinct texts, those with the
    smallest hashes, and of each a window at a place that its hash names. Windows
    are so long that they hold ``2 * sample_symbols`` characters together, or are
    the whole texts. Beyond ``MOST_LANGUAGES`` labels only those with the most
    documents are learned (ties: the first by name), which bounds the model.
    """
    labelled = id_and_text(docs, "doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (crc_fold(F.col("doc_id"), folds) != held_out)
    )
    unit = 1 << 30
    hashed = labelled.select("lang", F.xxhash64("text").alias("h"), "text")
    rows = hashed.groupBy("lang").agg(F.approx_count_distinct("h").alias("count"), F.count("*").alias("documents"))
    rows = rows.orderBy(F.desc("documents"), "lang").limit(MOST_LANGUAGES).drop("documents")
    near = hashed.join(F.broadcast(rows), "lang").where(F.pmod("h", F.lit(unit)) * F.col("count") < F.lit(2.0 * unit * sample_docs))
    facts = F.struct(F.pmod("h", F.lit(unit)).alias("place"), "h", F.length("text").cast("bigint").alias("n"))
    listed = near.select("lang", facts.alias("fact")).distinct().groupBy("lang")
    wanted = listed.agg(F.slice(F.array_sort(F.collect_list("fact")), 1, sample_docs).alias("facts")).collect()
    if not wanted:
        return build({}, sample_symbols)
    chosen = [(r["lang"], f["h"], window([g["n"] for g in r["facts"]], 2 * sample_symbols)) for r in wanted for f in r["facts"]]
    names = docs.sparkSession.createDataFrame(chosen, "lang string, h bigint, chars bigint")
    start = F.pmod(F.xxhash64("h", F.lit(1)), F.greatest(F.lit(1), F.length("text") - F.col("chars") + 1)) + 1
    part = F.substring("text", start.cast("int"), F.col("chars").cast("int")).alias("part")
    picked = hashed.join(F.broadcast(names), ["lang", "h"]).select("lang", F.pmod("h", F.lit(unit)).alias("place"), "h", part)
    texts: dict[str, list[str]] = {}
    for r in sorted(picked.dropDuplicates(["lang", "h"]).collect(), key=lambda r: (r["lang"], r["place"], r["h"])):
        texts.setdefault(r["lang"], []).append(r["part"])
    return build(texts, sample_symbols)


def window(lengths: list[int], total: int) -> int:
    """The least length to which texts can be cut and hold ``total`` together; that of the longest if they don't."""
    left = total
    for i, n in enumerate(sorted(lengths)):
        share = -(-left // (len(lengths) - i))
        if n >= share:
            return max(1, share)
        left -= n
    return max([1, *lengths])


def predict(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and score of each text, see ``identify``."""
    kept("language", dict)  # another operator's memory goes before the automata are built
    names = model.languages
    labels, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    ok = [i for i, t in enumerate(texts) if has_letter(t)] if names else []
    if not ok:
        return labels, scores
    weight = np.log2([max(2, len(model.texts[name])) for name in names])
    cost = phrase_counts([model.symbols(texts[i]) for i in ok], model) * weight
    rows = np.arange(len(ok))
    best = cost.argmin(1)
    lowest = cost[rows, best]
    cost[rows, best] = np.inf
    second = cost.min(1) if len(names) > 1 else np.full(len(ok), np.inf)
    share = np.where(np.isinf(second), 1.0, second / np.where(np.isinf(second), 1.0, lowest + second))
    for i, b, s in zip(ok, best, share, strict=True):
        labels[i], scores[i] = names[b], float(s)
    return labels, scores


def identify(docs: DataFrame, model: Model, folds: int = 3, held_out: int = 1) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text when no language was learned. Ties go to the language that sorts first.
    The score is the runner-up's share of both weighed phrase counts: 0.5 for a
    tie, towards 1 the clearer the winner.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double"

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        labels, scores = predict(batch.column("text").to_pylist(), shared.value)
        held = [fold(k, folds) == held_out for k in batch.column("doc_id").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(held, pa.bool_()), pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    return map_texts(id_and_text(docs), work, schema)
