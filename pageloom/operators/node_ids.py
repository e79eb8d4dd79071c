"""Node ids that cannot collide, and the collisions of hashed ones."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.storage import durable

#: Bits of Spark's running number that count the rows of a partition.
_ROW_BITS = 33


def dense_ids(names: DataFrame, column: str = "title", first: int = -1, step: int = -1) -> DataFrame:
    """``column, id``: each distinct name with a number of its own, ``first``, ``first + step`` and so on in the order of the names.

    The names are sorted over ranges, numbered within each range, and a range starts
    where those before it end: one shuffle, one number a range to the driver, no
    hash and hence no collision. Negative by default, so that no number meets a page
    id. The numbers depend on the set of names alone. Nulls have none.
    """
    distinct = names.select(column).where(F.col(column).isNotNull()).distinct()
    ordered = distinct.repartitionByRange(F.col(column)).sortWithinPartitions(column)
    numbered = durable(ordered.withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", _ROW_BITS)
    counts = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("rows")).orderBy("part").toArrow()
    rows = counts["rows"].to_numpy()
    starts = names.sparkSession.createDataFrame(pa.table({"part": counts["part"], "start": pa.array(np.cumsum(rows) - rows, pa.int64())}))
    place = F.col("start") + F.col("at") - F.shiftleft("part", _ROW_BITS)
    # One row for each range is broadcast.
    return numbered.withColumn("part", part).join(F.broadcast(starts), "part").select(column, (F.lit(first) + F.lit(step) * place).alias("id"))


def id_collisions(names: DataFrame, hashed: Column, column: str = "title") -> DataFrame:
    """``id, names, first_name, last_name``: ids that the hash gives to more than one name."""
    distinct = names.select(hashed.alias("id"), column).distinct()
    found = distinct.groupBy("id").agg(F.count("*").alias("names"), F.min(column).alias("first_name"), F.max(column).alias("last_name"))
    return found.where("names > 1")
