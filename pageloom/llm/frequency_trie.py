"""Spelling variants by a trie of letter-group counts.

Letters are dealt into groups. A word's vector counts its letters in each group,
and the words stand in a trie by the successive counts of their vectors. One
edit changes a vector by at most one letter too many in one group and one too
few in another, so a depth-first search that may spend one surplus and one
deficit meets every word within one edit; the words of the leaves it reaches are
verified letter by letter. Of two words with different vectors only one searches,
the one with fewer letters in the first group that differs: its search spends the
surplus first.

On Spark: a word goes to the task of its vector's first counts, and asks in the
tasks of all beginnings that the budget reaches. So many counts make a beginning
that each has a bounded number of words. No two words meet but in a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators.skew import broadcast_if_small
from pageloom.storage import durable

#: Fixed values of the contract: what a run of letters is, and which runs lose a letter.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
SHORTEST, LEAST, LOSES = 7, 2, 31
RATIO = 10
GROUPS = 16
#: Words of a beginning, beyond which one more count is taken or, with all counts taken, the words are split.
MOST_WORDS = 50_000
#: Longer words are compared one pair at a time, not as rows of a matrix.
WIDTH = 48
PAIRS = 1 << 18
_A_TO_Z = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted_words(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST, least: int = LEAST, loses: int = LOSES
) -> DataFrame:
    """``word, n``: the letter runs of all texts with their occurrences, A-Z in lower case; native, one shuffle of counts.

    A run loses the code point ``h % length``, from 0, if ``loses`` divides ``h``, the
    crc32 of ``<id>:<run>``; a null id counts as ``null``. Only words of at least
    ``shortest`` code points that occur at least ``least`` times are kept. Null and
    empty texts have none. A run of any length is one word.
    """
    runs = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("id"),
        F.explode(F.regexp_extract_all(F.col(text).cast("string"), F.lit(RUN), F.lit(0))).alias("run"),
    ).where(F.length("run") >= shortest)
    lowered = runs.select("id", F.translate("run", *_A_TO_Z).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substr(F.col("run"), F.lit(1), at), F.substr(F.col("run"), at + 2))
    words = hashed.select(F.when(F.col("h") % loses == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def spelling_groups(words: DataFrame, ratio: int = RATIO, groups: int = GROUPS, most_words: int = MOST_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of rows ``word, n``, each word once.

    Near is a word that differs by exactly one inserted, deleted or replaced code
    point; ``n_near`` counts them all. ``form`` is the near word with the largest
    ``n`` (ties: the smallest in code-point order), if that is at least ``ratio``
    times the word's own, else null; ``root`` follows forms to the last one and is
    the word itself if there is none. Letters beyond U+00FF share the groups of
    the code points below. Null words are left out; an empty table gives an empty result.
    """
    words = durable(words.select(F.col("word").cast("string"), F.col("n").cast("bigint")).where(F.col("word").isNotNull()), "words")
    near = neighbours(words, groups, most_words)
    best = near.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near_word")).alias("best"))
    judged = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.col("best.near_word").alias("near_word"), (-F.col("best.less")).alias("near_n")
    )
    strong = F.col("near_n") >= ratio * F.col("n")
    formed = durable(judged.select("word", "n", "n_near", F.when(strong, F.col("near_word")).alias("form"), F.when(strong, F.col("near_n")).alias("form_n")), "forms")
    roots = _roots(formed.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Each word's last form. A form occurs more often than its word, so there are no circles; each round doubles the step."""
    links = durable(links, "roots")
    while True:
        onward = links.select(F.col("word").alias("via"), F.col("root").alias("onward"))
        stepped = durable(
            links.join(onward, links["root"] == onward["via"], "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")),
            "roots",
        )
        links = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return links


def letter_groups(words: DataFrame, groups: int) -> np.ndarray:
    """The group of each code point below 256, the most frequent letters dealt first, each to the lightest group.

    A code point beyond counts as its last byte. At most 256 rows are collected.
    """
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).where(F.col("letter") != "")
    counted = letters.groupBy((F.ascii("letter") % 256).alias("code")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "code").collect()
    of, weight = np.zeros(256, np.int64), np.zeros(groups)
    for row in counted:
        lightest = int(weight.argmin())
        of[row["code"]] = lightest
        weight[lightest] += row["rows"]
    return of


def neighbours(words: DataFrame, groups: int = GROUPS, most_words: int = MOST_WORDS) -> DataFrame:
    """``word, near, near_n, near_word``: for each beginning that holds near words of a word, their number and the best of them."""
    of = letter_groups(words, groups)
    depth, crowded = _depth(words, of, groups, most_words)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                begin = vectors(batch.column("word").to_pylist(), of, groups)[:, :depth]
                yield pa.RecordBatch.from_arrays([_written(begin), batch.column("word"), batch.column("n")], ["begin", "word", "n"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moves = within_budget(depth)
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                begin = vectors(part.column("word").to_pylist(), of, groups)[:, :depth]
                asked = (begin[:, None, :] + moves[None, :, :]).reshape(-1, depth)
                who = np.repeat(np.arange(len(begin)), len(moves))
                real = (asked >= 0).all(axis=1)
                at = pa.array(who[real])
                yield pa.RecordBatch.from_arrays([_written(asked[real]), part.column("word").take(at), part.column("n").take(at)], ["begin", "word", "n"])

    schema = "begin string, word string, n long"
    own, asked = words.mapInArrow(place, schema), words.mapInArrow(ask, schema)
    known = durable(own.select("begin").distinct(), "beginnings")
    asked = asked.join(broadcast_if_small(known), "begin", "left_semi")
    keys = ["begin"]
    if crowded is not None:
        own = own.join(broadcast_if_small(crowded), "begin", "left").withColumn("split", F.pmod(F.xxhash64("word"), F.coalesce("splits", F.lit(1))).cast("int")).drop("splits")
        asked = asked.join(broadcast_if_small(crowded), "begin", "left").withColumn("split", F.explode(F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1))).drop("splits")
        keys.append("split")
    search = lambda mine, theirs: _search(mine, theirs, of, groups)
    return own.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, "word string, near long, near_n long, near_word string")


def _depth(words: DataFrame, of: np.ndarray, groups: int, most_words: int) -> tuple[int, DataFrame | None]:
    """How many counts make a beginning, and with all counts taken the beginnings that still hold too many words."""
    for depth in range(1, groups + 1):

        def begins(batches: Iterator[pa.RecordBatch], depth: int = depth) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays([_written(vectors(batch.column("word").to_pylist(), of, groups)[:, :depth])], ["begin"])

        sizes = words.mapInArrow(begins, "begin string").groupBy("begin").agg(F.count("*").alias("words"))
        if depth < groups:
            if (sizes.agg(F.max("words").alias("words")).first()["words"] or 0) <= most_words:
                return depth, None
        else:
            crowded = durable(sizes.where(F.col("words") > most_words).select("begin", F.ceil(F.col("words") / most_words).cast("int").alias("splits")), "crowded")
            return depth, None if crowded.isEmpty() else crowded
    raise ValueError("at least one letter group is needed")


def within_budget(depth: int) -> np.ndarray:
    """All changes of ``depth`` counts by at most one surplus and, after it, at most one deficit."""
    one = np.eye(depth, dtype=np.int64)
    moves = [np.zeros(depth, np.int64), *one, *(one[up] - one[down] for up, down in combinations(range(depth), 2))]
    return np.array(moves).reshape(-1, depth)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in a row, and the words' lengths."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), sizes


def vectors(words: list[str], of: np.ndarray, groups: int) -> np.ndarray:
    """The letter-group counts of each word."""
    codes, sizes = _codes(words)
    flat = np.repeat(np.arange(len(words)), sizes) * groups + of[codes & 255]
    return np.bincount(flat, minlength=len(words) * groups).reshape(len(words), groups)


def _written(begin: np.ndarray) -> pa.Array:
    """Counts as text, the form in which they are keys."""
    return pa.array([",".join(map(str, row)) for row in begin.tolist()], pa.string())


class Trie:
    """Words by the successive counts of their vectors.

    The nodes of a level are the distinct beginnings of that length in order. A
    child is found by its parent's number and its count in one sorted array.
    """

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.lexsort(points.T[::-1])
        rows = points[self.order]
        self.base = int(rows.max(initial=0)) + 3
        self.levels = []
        node = np.zeros(len(rows), np.int64)
        for level in range(rows.shape[1]):
            self.levels.append(keys := np.unique(node * self.base + rows[:, level] + 1))
            node = np.searchsorted(keys, node * self.base + rows[:, level] + 1)
        self.starts = np.searchsorted(node, np.arange(node[-1] + 2 if len(node) else 1))

    def leaves(self, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """``(leaf, query)`` arrays of all leaves within one surplus and then one deficit of the queries, and whether any was spent.

        Depth first; a step of the stack takes all queries that have spent their
        budget alike along one branch of decisions.
        """
        stack = [(0, np.zeros(len(asked), np.int64), np.arange(len(asked)), ())]
        while stack:
            level, node, who, spent = stack.pop()
            if level == len(self.levels):
                yield node, who, bool(spent)
                continue
            keys = self.levels[level]
            count = asked[who, level]
            for step in {(): (0, 1), (1,): (0, -1), (1, -1): (0,)}[spent]:
                wanted = node * self.base + count + 1 + step
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                there = keys[at] == wanted
                if there.any():
                    stack.append((level + 1, at[there], who[there], (*spent, step) if step else spent))

    def pairs(self, asked: np.ndarray, most: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """``(word, query)`` arrays of all words of the leaves, in pieces of about ``most``, and whether their vectors differ."""
        for leaf, who, differ in self.leaves(asked):
            ends = np.cumsum(self.starts[leaf + 1] - self.starts[leaf])
            start = 0
            while start < len(leaf):
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + most, side="right")))
                sizes = (self.starts[leaf + 1] - self.starts[leaf])[start:stop]
                within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield self.order[np.repeat(self.starts[leaf[start:stop]], sizes) + within], np.repeat(who[start:stop], sizes), differ
                start = stop


def one_edit(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    low, high = 0, len(a)  # by halves, where the common beginning ends
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


class _Letters:
    """Words as rows of code points, from the left and from the right, as wide as the longest up to ``WIDTH``."""

    def __init__(self, words: list[str]) -> None:
        self.words = words
        codes, self.sizes = _codes(words)
        ends = np.cumsum(self.sizes)
        width = min(WIDTH, int(self.sizes.max(initial=0)))
        kind = np.uint8 if codes.max(initial=0) < 256 else np.uint32
        self.left, self.right = (np.zeros((len(words), width), kind) for _ in range(2))
        place = np.arange(len(codes)) - np.repeat(ends - self.sizes, self.sizes)
        back = np.repeat(self.sizes, self.sizes) - 1 - place
        row = np.repeat(np.arange(len(words)), self.sizes)
        for to, at in ((self.left, place), (self.right, back)):
            to[row[at < width], at[at < width]] = codes[at < width]


def _near(a: _Letters, i: np.ndarray, b: _Letters, j: np.ndarray) -> np.ndarray:
    """Which pairs ``a[i], b[j]`` are one edit apart: common beginning and end cover all but one code point."""
    n, m = a.sizes[i], b.sizes[j]
    more = np.maximum(n, m)
    near = np.abs(n - m) <= 1
    short = near & (more <= WIDTH)
    at = np.flatnonzero(short)
    if len(at):
        # Beyond the shorter of both widths nothing can be common.
        width = min(a.left.shape[1], b.left.shape[1])
        head, tail = (_common(x[i[at], :width], y[j[at], :width]) for x, y in ((a.left, b.left), (a.right, b.right)))
        near[at] = (np.maximum(head, tail) < more[at]) & (np.minimum(head, n[at]) + np.minimum(tail, m[at]) >= more[at] - 1)
    for p in np.flatnonzero(near & ~short):
        near[p] = one_edit(a.words[i[p]], b.words[j[p]])
    return near


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many entries the rows have in common from their start on."""
    unlike = x != y
    first = unlike.argmax(axis=1)
    first[~unlike.any(axis=1)] = x.shape[1]
    return first


_FOUND = {"word": pa.string(), "near": pa.int64(), "near_n": pa.int64(), "near_word": pa.string()}


def _search(mine: pa.Table, theirs: pa.Table, of: np.ndarray, groups: int) -> pa.Table:
    """The near pairs of ``mine`` and ``theirs``, told to both; words of one vector find each other and are told once each."""
    found = [pa.table([pa.array([], kind) for kind in _FOUND.values()], list(_FOUND))]
    if mine.num_rows and theirs.num_rows:
        own, asked = mine["word"].to_pylist(), theirs["word"].to_pylist()
        own_n, asked_n = mine["n"].to_numpy(), theirs["n"].to_numpy()
        letters, trie = _Letters(own), Trie(vectors(own, of, groups))
        hits: dict[bool, list[tuple[np.ndarray, np.ndarray]]] = {False: [], True: []}
        for start in range(0, len(asked), 20_000):
            part = asked[start : start + 20_000]
            query = _Letters(part)
            for word, who, differ in trie.pairs(vectors(part, of, groups)):
                good = _near(letters, word, query, who)
                hits[differ].append((word[good], start + who[good]))
        for differ, pairs in hits.items():
            word, who = (np.concatenate(x) for x in zip(*pairs)) if pairs else (np.empty(0, np.int64),) * 2
            if len(word):
                found.append(_told(asked, who, own, own_n, word))
                if differ:
                    found.append(_told(own, word, asked, asked_n, who))
    return pa.concat_tables(found)


def _told(words: list[str], who: np.ndarray, others: list[str], n: np.ndarray, near: np.ndarray) -> pa.Table:
    """For each word of ``who`` the number of its near words and the best: the largest n, then the smallest word."""
    ids, owner, counts = np.unique(who, return_inverse=True, return_counts=True)
    used, place = np.unique(near, return_inverse=True)
    order = np.array(sorted(range(len(used)), key=lambda k: (-n[used[k]], others[used[k]])))
    rank = np.empty(len(used), np.int64)
    rank[order] = np.arange(len(used))
    best = np.full(len(ids), len(used))
    np.minimum.at(best, owner, rank[place])
    pick = used[order[best]]
    columns = [[words[i] for i in ids.tolist()], counts, n[pick], [others[i] for i in pick.tolist()]]
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, _FOUND.values())], list(_FOUND))
