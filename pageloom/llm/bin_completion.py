"""Packing of documents into sequences by bin completion, with best fit as the incumbent.

Pieces are dealt by a hash of their id into groups of bounded size, and each group is packed on its own: best fit on
falling lengths gives the incumbent; where that uses more bins than the lower bound, a depth-first search completes one
bin at a time. It takes the largest piece left, enumerates the undominated fillings of the room beside it, and cuts a
branch whose waste exceeds what a packing better than the incumbent could afford. The search has a bounded number of
nodes, after which the incumbent stands. What the groups leave in underfilled bins is packed again in further rounds,
until it fits one group or no round saves a bin.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.chunk_ids import encoder
from pageloom.llm.texts import id_and_text, map_texts
from pageloom.storage import durable

CAPACITY = 4096
GROUP_PIECES = 8192
NODES = 400
#: Bounds of the search: fillings of a bin that are kept, and steps to enumerate them.
FILLINGS, STEPS = 10, 1_500


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best fit on falling lengths: bins as lists of sizes. Ties go to the bin opened first."""
    bins: list[list[int]] = []
    rooms: list[tuple[int, int]] = []
    for size in sorted(sizes, reverse=True):
        at = bisect_left(rooms, (size, -1))
        if at < len(rooms):
            room, number = rooms.pop(at)
            bins[number].append(size)
        else:
            room, number = capacity, len(bins)
            bins.append([size])
        if room > size:
            insort(rooms, (room - size, number))
    return bins


def lower_bound(sizes: list[int], capacity: int) -> int:
    """Bins that any packing needs: the total, or pieces above half with what can't go beside them."""
    ordered = np.sort(np.asarray(sizes, np.int64))
    bound = -(-int(ordered.sum()) // capacity)
    sums = np.concatenate([[0], np.cumsum(ordered)])
    half = bisect_right(ordered, capacity // 2)
    for small in np.unique(ordered[:half]):
        alone = len(ordered) - bisect_right(ordered, capacity - small)
        middle = len(ordered) - alone - half
        low = bisect_left(ordered, small)
        rest = int(sums[half] - sums[low]) - (middle * capacity - int(sums[len(ordered) - alone] - sums[half]))
        bound = max(bound, alone + middle + max(0, -(-rest // capacity)))
    return max(bound, len(ordered) - half)


def fillings(left: Counter, ordered: list[int], room: int, limit: int = FILLINGS, perfect: bool = False) -> list[tuple[int, ...]]:
    """Undominated sets of remaining sizes that fit ``room``, least waste first: at most ``limit`` of what bounded steps find.

    With ``perfect`` the first one without waste ends the enumeration.

    The stack is as deep as there are distinct sizes: all copies of a size are
    taken at once, then fewer of them. A filling that can take a further piece is
    dominated.
    """
    found: list[tuple[int, ...]] = []
    # Sizes taken with their copies, room left, place of the next size, its copies to take, smallest size that was passed over.
    stack: list[tuple[tuple[tuple[int, int], ...], int, int, int, int]] = []

    def onward(taken: tuple[tuple[int, int], ...], free: int, top: int, passed: int) -> None:
        """On to the largest size below place ``top`` that fits; if none does, a filling that nothing passed over can join is found."""
        at = bisect_right(ordered, free, 0, top) - 1
        if at >= 0:
            stack.append((taken, free, at, min(left[ordered[at]], free // ordered[at]), passed))
        elif taken and free < passed:
            found.append(tuple(size for size, copies in taken for _ in range(copies)))

    onward((), room, len(ordered), room + 1)
    steps = 0
    while stack and len(found) < 4 * limit and steps < STEPS:
        steps += 1
        taken, free, at, copies, passed = stack.pop()
        size = ordered[at]
        rest = free - copies * size
        # Smaller pieces in the last copy's place are dominated where that leaves no room, or holds no two of them.
        fewer = copies - 1 - (rest == 0 or rest < ordered[0] and 2 * ordered[0] > rest + size)
        if at and fewer >= 0:
            stack.append((taken, free, at, fewer, size))
        onward((*taken, (size, copies)) if copies else taken, rest, at, passed)
        if perfect and found and sum(found[-1]) == room:
            break
    unique = sorted(set(found), key=lambda f: (-sum(f), len(f)))
    kept: list[tuple[int, ...]] = []
    for filling in unique:
        if not any(dominates(better, filling) for better in kept):
            kept.append(filling)
    return kept[:limit]


def dominates(better: tuple[int, ...], filling: tuple[int, ...]) -> bool:
    """Whether the pieces of ``filling`` can be put, whole, into places as large as those of ``better``.

    Pieces that both have take each other's places.
    """
    places, given = Counter(better), Counter(filling)
    rooms = sorted((places - given).elements())
    for size in sorted((given - places).elements(), reverse=True):
        at = bisect_left(rooms, size)
        if at == len(rooms):
            return False
        insort(rooms, rooms.pop(at) - size)
    return True


def pack(sizes: list[int], capacity: int = CAPACITY, nodes: int = NODES) -> list[list[int]]:
    """Bins as lists of sizes: the incumbent, or a packing with fewer bins that the search finds."""
    if any(not 0 < s <= capacity for s in sizes):
        raise ValueError(f"lengths must lie between 1 and {capacity}")
    best = best_fit(sizes, capacity)
    bound = lower_bound(sizes, capacity) if sizes else 0
    total = sum(sizes)
    budget = nodes
    while len(best) > bound and budget > 0:
        allowed = (len(best) - 1) * capacity - total
        found, used = _search(Counter(sizes), capacity, allowed, budget)
        budget -= used
        if found is None:
            break
        best = found
    return best


def _search(left: Counter, capacity: int, allowed: int, nodes: int) -> tuple[list[list[int]] | None, int]:
    """A packing that wastes at most ``allowed``, or None; a stack of bins with their untried fillings."""
    ordered = sorted(left)
    bins: list[list[int]] = []
    waste, used = 0, 0
    stack: list[Iterator[tuple[int, ...]]] = []

    def take(size: int) -> None:
        left[size] -= 1
        if not left[size]:
            del left[size]
            ordered.pop(bisect_left(ordered, size))

    def give(size: int) -> None:
        if size not in left:
            insort(ordered, size)
        left[size] += 1

    def choices() -> Iterator[tuple[int, ...]]:
        """Fillings around the largest piece: one without waste at once, all others only if the search comes back."""
        top, tried = ordered[-1], set()
        for perfect in (True, False):
            take(top)
            options = fillings(left, ordered, capacity - top, perfect=perfect) if ordered and ordered[0] <= capacity - top else [()]
            give(top)
            if perfect and top + sum(options[0]) != capacity:
                continue
            for option in options[: 1 if perfect else None]:
                if option not in tried:
                    tried.add(option)
                    yield (top, *option)

    while ordered:
        if len(stack) == len(bins):
            used += 1
            if used > nodes + sum(left.values()) // 2 + len(bins):
                return None, used
            stack.append(choices())
        filled = next((f for f in stack[-1] if waste + capacity - sum(f) <= allowed), None)
        if filled is None:
            stack.pop()
            if not bins or used > nodes:
                return None, used
            undone = bins.pop()
            waste -= capacity - sum(undone)
            for size in undone:
                give(size)
            used += 1
            continue
        for size in filled:
            take(size)
        bins.append(list(filled))
        waste += capacity - sum(filled)
    return bins, used


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: whole texts as ids with the end id, cut only beyond ``capacity``.

    A null text counts as empty. Repeated rows give repeated pieces.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        ids, sizes = encoder(tokenizer).encode(texts)
        ids = np.insert(ids, np.cumsum(sizes), end_id)
        sizes = sizes + 1
        n_pieces = -(-sizes // capacity)
        document = np.repeat(np.arange(len(texts)), n_pieces)
        piece = np.arange(len(document)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
        start = piece * capacity
        length = np.minimum(sizes[document] - start, capacity)
        begin = (np.cumsum(sizes) - sizes)[document] + start
        raw = memoryview(ids.astype("<u4").tobytes())
        crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").take(pa.array(document)),
                pa.array(piece.astype(np.int32)),
                pa.array(start),
                pa.array(length),
                pa.array(crc, pa.int64()),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32"],
        )

    return map_texts(id_and_text(docs), work, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def _place(group: pd.DataFrame, capacity: int, nodes: int) -> pd.DataFrame:
    ordered = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
    waiting: dict[int, list[int]] = {}
    for row, size in zip(range(len(ordered))[::-1], ordered["length"].to_numpy()[::-1], strict=True):
        waiting.setdefault(int(size), []).append(row)
    bins = pack([int(s) for s in ordered["length"]], capacity, nodes)
    number, offset, filled = (np.empty(len(ordered), np.int64) for _ in range(3))
    for i, sizes in enumerate(bins):
        at = 0
        for size in sizes:
            row = waiting[size].pop()
            number[row], offset[row], filled[row] = i, at, sum(sizes)
            at += size
    return ordered.assign(bin=number, offset=offset, filled=filled)


def packed(parts: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, nodes: int = NODES) -> DataFrame:
    """``parts`` with ``sequence_id, offset``: sequences of at most ``capacity`` ids, gapless from 0.

    ``parts`` must come from a written table, since it is read once for its number of rows. An empty table stays empty.
    """
    columns = parts.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) + ", round int, grp bigint, bin bigint, offset bigint, filled bigint"

    def one_round(rows: DataFrame, n_rows: int, number: int) -> DataFrame:
        groups = max(1, math.ceil(n_rows / group_pieces))

        def place(group: pd.DataFrame) -> pd.DataFrame:
            out = _place(group, capacity, nodes)
            out["round"] = np.int32(number)
            return out[[*columns, "round", "grp", "bin", "offset", "filled"]]

        # By place, not by content: repeated rows must not meet in one group.
        dealt = rows.withColumn("grp", F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit(number)), F.lit(groups)))
        return durable(dealt.groupBy("grp").applyInPandas(place, schema), f"packed_{number}")

    left, n_left, number, done = parts, parts.count(), 0, []
    while True:
        tried = one_round(left, n_left, number)
        is_open = F.col("filled") < capacity - capacity // 16
        rest = tried.where(is_open)
        facts = rest.agg(F.count("*").alias("rows"), F.sum("length").alias("ids"), F.count_distinct("grp", "bin").alias("bins")).first()
        one_group = n_left <= group_pieces
        if one_group or not facts["rows"] or facts["bins"] <= -(-(facts["ids"] or 0) // capacity) or facts["rows"] > n_left // 2:
            done.append(tried)
            break
        done.append(tried.where(~is_open))
        left, n_left, number = rest.select(columns), facts["rows"], number + 1
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    sequence = (F.col("round").cast("bigint") * F.lit(1 << 56)) + F.col("grp") * F.lit(1 << 20) + F.col("bin")
    return result.select(*columns, sequence.alias("sequence_id"), "offset")
