"""Storing intermediate rows in the cluster's shared folder, and removing them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: the folder of the run that the current thread or context is in
_run: ContextVar[str | None] = ContextVar("meterbook_run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`, a folder that all executors share."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of whatever file system it is in; nothing happens if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def files(spark: SparkSession, path: str) -> set[str]:
    """Names of the files right in a folder of whatever file system it is in; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in system.listStatus(place) if f.isFile()} if system.exists(place) else set()


@contextmanager
def run_folder(spark: SparkSession, below: str) -> Iterator[str]:
    """What is stored inside goes to one folder, which is removed at the end, also after an error.

    Runs in several threads have a folder each.
    """
    path = f"{below}/_meterbook-run-{uuid.uuid4().hex}"
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        remove(spark, path)


def stored(df: DataFrame, codec: str = "snappy") -> DataFrame:
    """Write the rows to a table of their own in the run's folder, or in the shared one, and read them from there.

    This cuts the lineage: what follows is planned from a plain scan, with column pruning, and neither lost executors
    nor a second reader repeat the work before it. For the widest tables zstd takes up less room, for more CPU time.
    """
    folder = _run.get() or shared_folder(df.sparkSession)
    path = f"{folder}/meterbook-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows dealt by keys to as many tasks as the session has shuffle partitions.

    Spark would join tasks by the compressed size of what they read. Repeated texts are far larger in memory.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def merged(df: DataFrame) -> DataFrame:
    """One side of a join that grows with the input: joined by sort and merge, never collected for a broadcast.

    Spark takes the size of stored rows from their files. Repeated texts and lists take up little room
    there, so it would broadcast tables that the driver cannot hold.
    """
    return df.hint("merge")
