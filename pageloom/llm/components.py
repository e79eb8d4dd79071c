"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.texts import written
from pageloom.operators.skew import MAX_BROADCAST_ROWS

MAX_ROUNDS = 60


def _with_least(pairs: DataFrame, few: bool) -> DataFrame:
    """``u, v, m``: every pair with the least neighbour of ``u``.

    A hub's pairs are joined to one row, so a skewed hub is split by the join
    and never gathered. ``few``: the pairs need no shuffle for the join, as the
    nodes are known to be few enough to be broadcast.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(F.broadcast(least) if few else least, "u")


def large_star(edges: DataFrame, few: bool = False) -> DataFrame:
    """Every larger neighbour of a node moves to the least of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_least(both, few).where("v > u")
    return linked.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u <> v").distinct()


def small_star(edges: DataFrame, few: bool = False) -> DataFrame:
    """A node and its smaller neighbours move to the least of them. Expects ``u > v``."""
    linked = _with_least(edges, few)
    moved = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = linked.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``node, root`` for every node that has an edge to another; the root is the least node of its component.

    Edges may repeat, run either way or join a node to itself; null ends are
    left out. Every round is written to the shared folder.
    """
    a, b = F.col(left).cast("bigint"), F.col(right).cast("bigint")
    now = written(
        edges.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
        "edges",
    )

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(now)
    for _ in range(MAX_ROUNDS):
        few = 2 * before[0] <= MAX_BROADCAST_ROWS  # an edge has two nodes, and large stars are no more edges
        now = written(small_star(large_star(now, few), few), "stars")
        after = mark(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no fixed point after {MAX_ROUNDS} rounds")
    # At the fixed point every node points at its root, and roots point at nothing.
    rooted = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rooted.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
