"""PageRank as a DataFrame iteration."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators.skew import ROWS_PER_SPLIT, copy_small_side, heavy_keys, salt_large_side
from pageloom.storage import checkpointed, durable

RESET = 0.15
MAX_ITER = 10
CHECKPOINT_EVERY = 5


def pagerank(
    vertices: DataFrame,
    edges: DataFrame,
    reset: float = RESET,
    max_iter: int = MAX_ITER,
    checkpoint_every: int = CHECKPOINT_EVERY,
    rows_per_split: int = ROWS_PER_SPLIT,
) -> DataFrame:
    """Vertices with ``pagerank`` after a fixed number of rounds; the ranks sum to the number of vertices.

    Every rank starts at 1 and becomes ``reset + (1 - reset) * sum(rank / out-degree)``
    over the incoming edges. Edges and out-degrees are partitioned by vertex and
    sorted once, so a round shuffles only the contributions, already summed per
    task. A vertex with very many outgoing edges is split over several tasks.

    Both inputs are read more than once; pass written tables.
    """
    partitions = int(vertices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = edges.select("src_id", "dst_id")
    degrees = durable(links.groupBy("src_id").agg(F.count("*").alias("out_degree")), "degrees")
    heavy = heavy_keys(degrees, "src_id", rows_per_split, rows="out_degree")

    source = ["src_id"]
    if heavy is not None:
        links = salt_large_side(links, "src_id", F.col("dst_id"), heavy)
        source.append("salt")
    links = (
        links.repartition(partitions, *source).sortWithinPartitions(*source).persist(StorageLevel.MEMORY_AND_DISK)
    )
    nodes = (
        vertices.select("id")
        .join(degrees, F.col("id") == F.col("src_id"), "left")
        .select("id", "out_degree")
        .repartition(partitions, "id")
        .sortWithinPartitions("id")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        for cached in (links, nodes):
            cached.count()  # a filled cache tells the planner how it is partitioned and sorted
        ranks = nodes.select("id", "out_degree", F.lit(1.0).alias("rank"))
        for step in range(1, max_iter + 1):
            ranks = _one_round(ranks, nodes, links, source, heavy, reset)
            if step % checkpoint_every == 0 or step == max_iter:
                ranks = checkpointed(ranks)
        totals = ranks.agg(F.count("*").alias("n"), F.sum("rank").alias("rank")).first()
    finally:
        links.unpersist()
        nodes.unpersist()
    scale = totals.n / totals.rank if totals.n else 1.0
    scaled = ranks.select("id", (F.col("rank") * scale).alias("pagerank"))
    return vertices.join(scaled, "id")


def _one_round(
    ranks: DataFrame, nodes: DataFrame, links: DataFrame, source: list[str], heavy: DataFrame | None, reset: float
) -> DataFrame:
    shares = ranks.where(F.col("out_degree") > 0).select(
        F.col("id").alias("src_id"), (F.col("rank") / F.col("out_degree")).alias("share")
    )
    if heavy is not None:
        shares = copy_small_side(shares, "src_id", heavy)
    received = (
        links.join(shares, source).groupBy(F.col("dst_id").alias("id")).agg(F.sum("share").alias("received"))
    )
    return nodes.join(received, "id", "left").select(
        "id", "out_degree", (F.lit(reset) + (1 - reset) * F.coalesce("received", F.lit(0.0))).alias("rank")
    )


def top_by_rank(ranked: DataFrame, kind: str, n: int = 10) -> DataFrame:
    """The highest-ranked vertices of one kind."""
    return (
        ranked.where(F.col("kind") == kind)
        .orderBy(F.desc("pagerank"), "id")
        .limit(n)
        .select("id", "title", "kind", "pagerank")
    )
