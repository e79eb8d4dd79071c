"""Exact percentiles of numeric columns by narrowing, without a global sort.

Each pass over the column brackets the wanted ranks between two values that a
sketch of the remaining rows proposes, and counts exactly how many rows lie below
and at either. What is outside the bracket is settled, so a pass leaves a few
ten-thousandths of the rows, and a few passes do for any number of rows. Only one
row of counts a pass reaches the driver, whatever the values look like.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000


@dataclass
class _Bracket:
    """The rank sought, and the open interval that holds it: ``below`` values are at or under ``low``."""

    rank: int
    low: float | int | None = None
    high: float | int | None = None
    below: int = 0
    rows: int = 0
    found: float | int | None = None


def discrete_rank(rows: int, share: float) -> int:
    """The rank, from 1, of a discrete percentile: the least value that at least ``share`` of the rows don't exceed."""
    return max(1, rows - math.floor(rows - rows * share))


def exact_percentiles(df: DataFrame, wanted: dict[str, list[float]], accuracy: int = ACCURACY) -> dict[str, list]:
    """Values of the discrete percentiles ``wanted`` of each column, equal to sorting the column and taking the rank.

    Null and NaN entries don't count; a column without any other entry gives nulls.
    ``df`` is read two times a pass; pass a written table or a cached narrow one.
    """
    columns = list(wanted)
    known = {c: F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")) for c in columns}
    totals = df.agg(F.count("*").alias("all"), *(F.count_if(known[c]).alias(c) for c in columns)).first()
    seeking: list[tuple[str, _Bracket]] = []
    out: dict[str, list[_Bracket]] = {}
    for c in columns:
        out[c] = [_Bracket(discrete_rank(totals[c], share), rows=totals[c]) for share in wanted[c]]
        seeking += [(c, b) for b in out[c] if totals[c]]
    while seeking:
        _narrow(df, known, seeking, accuracy)
        seeking = [(c, b) for c, b in seeking if b.found is None]
    return {c: [b.found for b in brackets] for c, brackets in out.items()}


def _narrow(df: DataFrame, known: dict, seeking: list[tuple[str, _Bracket]], accuracy: int) -> None:
    """One pass for all open brackets: propose two values around each rank, count, and settle or tighten."""
    rows = []
    for place, (c, b) in enumerate(seeking):
        inside = known[c]
        if b.low is not None:
            inside &= F.col(c) > F.lit(b.low)
        if b.high is not None:
            inside &= F.col(c) < F.lit(b.high)
        share, slack = (b.rank - b.below) / b.rows, 2 / accuracy
        shares = [max(0.0, share - slack), min(1.0, share + slack)]
        rows.append(F.percentile_approx(F.when(inside, F.col(c)), shares, accuracy).alias(f"edges_{place}"))
    edges = df.agg(*rows).first()
    counts = []
    for place, (c, _) in enumerate(seeking):
        for name, edge in zip(("low", "high"), edges[f"edges_{place}"]):
            counts += [
                F.count_if(known[c] & (F.col(c) < F.lit(edge))).alias(f"under_{name}_{place}"),
                F.count_if(known[c] & (F.col(c) <= F.lit(edge))).alias(f"upto_{name}_{place}"),
            ]
    counted = df.agg(*counts).first()
    for place, (_, b) in enumerate(seeking):
        above = b.below + b.rows + 1  # rank of the first row beyond the bracket
        for name, edge in zip(("low", "high"), edges[f"edges_{place}"]):
            under, upto = counted[f"under_{name}_{place}"], counted[f"upto_{name}_{place}"]
            if under < b.rank <= upto:
                b.found = edge
                break
            if upto < b.rank and upto >= b.below:
                b.low, b.below = edge, upto
            elif under >= b.rank and under + 1 <= above:
                b.high, above = edge, under + 1
        b.rows = above - 1 - b.below
