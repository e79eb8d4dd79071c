"""A count-min sketch of document frequencies as a filter of rare values."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES = 2
MOST_BUCKETS = 1 << 22


def _bucket(value: Column, nth: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value, F.lit(nth)), F.lit(buckets)).cast("int")


def sketch(rows: DataFrame, values: str, buckets: int, hashes: int = HASHES, counts: str | None = None) -> DataFrame:
    """``nth, bucket, rows``: for each hash, in how many rows the array column holds a value of the bucket.

    A row adds each distinct value once for each hash. Counters are summed in the
    tasks first, so no task sends more than ``hashes * buckets`` of them, and each is
    merged where it is sent. With ``counts`` the rows hold a value each and this
    number of rows that it stands for.
    """
    if counts is not None:
        own = F.array(*(F.struct(F.lit(nth).alias("nth"), _bucket(F.col(values), nth, buckets).alias("bucket")) for nth in range(hashes)))
        return rows.select(F.inline(own), counts).groupBy("nth", "bucket").agg(F.sum(counts).alias("rows"))

    def counter(nth: int) -> Callable[[Column], Column]:
        return lambda value: F.struct(F.lit(nth).alias("nth"), _bucket(value, nth, buckets).alias("bucket"))

    each = F.flatten(F.array(*(F.transform(F.array_distinct(values), counter(nth)) for nth in range(hashes))))
    return rows.select(F.inline(each)).groupBy("nth", "bucket").agg(F.count("*").alias("rows"))


def frequent_enough(
    rows: DataFrame, values: str, least: int, buckets: int, hashes: int = HASHES, counts: str | None = None
) -> Callable[[Column], Column]:
    """A predicate that is false only for values in fewer than ``least`` rows.

    A counter is the sum over the values of its bucket, so it never falls below a
    value's own count: no frequent value is lost, and a rare one passes only if all
    its buckets are crowded. The driver takes one bit for each counter, in words of
    64; ``buckets`` is rounded up to whole words and bounded.
    """
    buckets = min(-(-buckets // 64) * 64, MOST_BUCKETS)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("bucket", F.lit(64)))
    enough = sketch(rows, values, buckets, hashes, counts).where(F.col("rows") >= least)
    found = enough.groupBy("nth", F.shiftright("bucket", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()
    words = [[0] * (buckets // 64) for _ in range(hashes)]
    for row in found:
        words[row["nth"]][row["word"]] = row["bits"]
    # A constant of the plan: folded once into an array, not looked up by a join.
    masks = [F.split(F.lit(",".join(map(str, own))), ",").cast("array<bigint>") for own in words]

    def keeps(value: Column) -> Column:
        def crowded(nth: int) -> Column:
            bucket = _bucket(value, nth, buckets)
            return F.getbit(F.get(masks[nth], F.shiftright(bucket, 6)), F.pmod(bucket, F.lit(64))) == 1

        return reduce(lambda a, b: a & b, map(crowded, range(hashes)))

    return keeps
