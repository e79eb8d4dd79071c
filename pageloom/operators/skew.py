"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.storage import durable

ROWS_PER_SPLIT = 1_000_000
MAX_BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark a table for broadcasting once its size is known to be within the limit.

    A larger table comes back unmarked and is joined by whatever strategy the
    planner picks. Rows are counted, not bytes: the bound is for narrow rows, a
    hundred bytes or so, and the result is the same either way.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def heavy_keys(
    df: DataFrame, key: str, rows_per_split: int = ROWS_PER_SPLIT, rows: str | None = None
) -> DataFrame | None:
    """Keys with more than ``rows_per_split`` rows as ``heavy_key, splits``; None when there is none.

    ``rows`` names a column that already holds row counts. A key is heavy if it
    has more than an eighth of an average shuffle partition too, so at most
    eight keys for each partition can be, which bounds the list for broadcasting.
    """
    counted = durable(
        df.where(F.col(key).isNotNull()).groupBy(key).agg((F.count("*") if rows is None else F.sum(rows)).alias("rows")),
        "key_counts",
    )
    total = counted.agg(F.sum("rows").alias("rows")).first()["rows"] or 0
    least = max(rows_per_split, total / (8 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    listed = counted.where(F.col("rows") > least).select(
        F.col(key).alias("heavy_key"), F.ceil(F.col("rows") / rows_per_split).cast("int").alias("splits")
    )
    table = durable(listed, "heavy_keys")
    return None if table.isEmpty() else table


def splits_of(rows: str, rows_per_split: int, total: int | None, partitions: int) -> Column:
    """Splits of a key with ``rows`` rows: 1 unless it is heavy as in ``heavy_keys``, where ``partitions`` share ``total`` rows."""
    least = max(rows_per_split, (total or 0) / (8 * partitions))
    return F.when(F.col(rows) > least, F.ceil(F.col(rows) / rows_per_split)).otherwise(1).cast("int")


def salt_large_side(df: DataFrame, key: str, spread_by: Column, heavy: DataFrame) -> DataFrame:
    """Add ``salt``: rows of a heavy key spread over its splits by a hash, all others 0."""
    marked = df.join(F.broadcast(heavy), F.col(key) == F.col("heavy_key"), "left")
    salt = F.pmod(F.xxhash64(spread_by), F.coalesce("splits", F.lit(1))).cast("int")
    return marked.withColumn("salt", salt).drop("heavy_key", "splits")


def copy_small_side(df: DataFrame, key: str, heavy: DataFrame) -> DataFrame:
    """Add ``salt``: a row of a heavy key once for each of its splits, all others once with 0."""
    marked = df.join(F.broadcast(heavy), F.col(key) == F.col("heavy_key"), "left")
    salts = F.sequence(F.lit(0), F.coalesce("splits", F.lit(1)) - 1)
    return marked.withColumn("salt", F.explode(salts)).drop("heavy_key", "splits")


def join_split(
    large: DataFrame, small: DataFrame, key: str, spread_by: Column, rows_per_split: int = ROWS_PER_SPLIT
) -> DataFrame:
    """Inner join on ``key`` whose heavy keys are shared out over several tasks by a hash of ``spread_by``.

    Heavy is a key by the rows that the join makes of it: rows of ``large`` times
    rows of ``small``. Both sides are read twice; pass written tables.
    """
    per_key = large.groupBy(key).agg(F.count("*").alias("n")).join(small.groupBy(key).agg(F.count("*").alias("m")), key)
    heavy = heavy_keys(per_key.withColumn("made", F.col("n") * F.col("m")), key, rows_per_split, rows="made")
    if heavy is None:
        return large.join(small, key)
    salted = salt_large_side(large, key, spread_by, heavy)
    return salted.join(copy_small_side(small, key, heavy), [key, "salt"]).drop("salt")
