"""Durable intermediate tables in the folder shared by the whole cluster.

Tables written here outlive any executor, cut the lineage of what follows and
carry real file sizes, so the join planner sees what it is dealing with.
"""

from __future__ import annotations

import gc
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_SETTING = "spark.checkpoint.dir"
#: For tables of texts and vectors, which it makes smaller than the default codec does.
DENSE = "zstd"
#: Seconds between two sweeps of a long fit.
SWEEP_EVERY = 30.0


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the session's warehouse; also set for checkpoints.

    A cluster session must name one, because only the caller knows which folder
    every executor can reach.
    """
    context = spark.sparkContext
    named = spark.conf.get(_SETTING, None) or context.getConf().get(_SETTING) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/pageloom"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def tables_folder(spark: SparkSession) -> str:
    """Where this application's intermediate tables go."""
    return f"{shared_folder(spark)}/tables/{spark.sparkContext.applicationId}"


def release(spark: SparkSession) -> None:
    """Drop the application's intermediate tables, once nothing reads them any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(tables_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{tables_folder(spark)}/{name}-{uuid.uuid4().hex}"


def sweep(spark: SparkSession) -> None:
    """Let the driver find what is no longer used, so that Spark drops its shuffle files, blocks and broadcasts.

    Else they stay on the executors' disks until the driver's heap happens to fill
    up. Frames that Python still holds keep theirs, so Python goes first.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def swept(spark: SparkSession, every: float | None = None) -> Iterator[None]:
    """``sweep`` before, now and then within, and after: a fit is one call that leaves a shuffle for each of its rounds."""
    done, wait = threading.Event(), SWEEP_EVERY if every is None else every

    def run() -> None:
        while not done.wait(wait):
            sweep(spark)

    sweep(spark)
    sweeper = threading.Thread(target=run, name="sweeper", daemon=True)
    sweeper.start()
    try:
        yield
    finally:
        done.set()
        sweeper.join()
        sweep(spark)


def durable(df: DataFrame, name: str, read_schema: T.StructType | str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and return it as a scan of the written table.

    ``read_schema`` reads the table under another schema, for instance an ML
    vector as the plain struct that Parquet holds for it. ``codec`` compresses a
    large table with another codec than the session's.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    (df.write if codec is None else df.write.option("compression", codec)).parquet(path)
    return spark.read.schema(read_schema or df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
