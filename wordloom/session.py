"""Where intermediate results live, and how small inputs get spread over the cores."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

PARTS_PER_CORE = 3


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate results.

    It is the one the cluster names in ``spark.checkpoint.dir``. A folder of our own is used
    only on a local master, where driver and executors share one disk.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wordloom-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its form."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Removes on leaving what ``stage_table`` has written inside, for work whose results are stored elsewhere."""
    token = _staged.set(paths := [])
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            files, at = file_system(spark, path)
            files.delete(at, True)


def stage_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the checkpoint folder and read it back.

    Used where several later jobs read the same rows, or only some columns or partitions of them.
    Within ``staging`` the table is removed at the end; else it stays as long as the folder does,
    since the result may be read at any later time.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if (paths := _staged.get()) is not None:
        paths.append(path)
    df.write.partitionBy(*(partition_by or [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash a scan with fewer splits than there are cores over all cores.

    A large input has more splits than cores and passes through unchanged, without a shuffle. A
    few partitions per core even out rows of very different size.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(PARTS_PER_CORE * cores, *keys)
