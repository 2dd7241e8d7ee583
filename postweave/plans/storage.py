"""Intermediate tables on the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Folders made for sessions that name none, by application.
_local_folders: dict[str, str] = {}
# The folder of the work in progress, see ``work_folder``.
_work: ContextVar[str | None] = ContextVar("work", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster its absence is
    an error, because executors could not read each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="postweave-")
    return _local_folders[context.applicationId]


def new_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path in the given folder, that of the work in progress or the shared one, that nothing else uses."""
    return f"{folder or _work.get() or shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def work_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A new folder for all tables stored within the block. Its owner deletes it, see ``delete``."""
    path = new_path(spark, name)
    token = _work.set(path)
    try:
        yield path
    finally:
        _work.reset(token)


def file_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of all files under the paths, on whatever file systems they are."""
    total = 0
    for path in paths:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        total += hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(hadoop).getLength()
    return total


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def stored(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a frame once as Parquet and return it as a scan of what was written.

    For frames that several jobs or many iterations read: the scan prunes columns, the lineage ends
    here, and a lost executor costs no recomputation.
    """
    spark = df.sparkSession
    path = new_path(spark, name, folder)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
