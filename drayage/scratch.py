"""The shared folder for staged tables.

A staged table replaces lineage: it is written once, survives the loss of any
executor and is read back by column.  The folder is the one the cluster names in
``spark.checkpoint.dir``, or the one the session set with ``setCheckpointDir``.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCOPE = threading.local()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach; it is never guessed."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    system, folder = _hadoop_path(spark, configured)
    return system.makeQualified(folder).toString()


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark)}/drayage-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    for held in getattr(_SCOPE, "paths", []):
        held.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread stages inside, once it is done; for work that repeats forever."""
    held: list[str] = []
    _SCOPE.paths = [*getattr(_SCOPE, "paths", []), held]
    try:
        yield
    finally:
        _SCOPE.paths = _SCOPE.paths[:-1]
        for path in held:
            delete(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, folder = _hadoop_path(spark, path)
    return system.exists(folder)


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the micro-batches that have a folder under ``path``."""
    system, folder = _hadoop_path(spark, path)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return [int(n.removeprefix("stream_batch=")) for n in names if n.startswith("stream_batch=")]


def make_folder(spark: SparkSession, path: str) -> None:
    system, folder = _hadoop_path(spark, path)
    system.mkdirs(folder)


def publish(df: DataFrame, path: str) -> bool:
    """Write ``df`` as the folder ``path``, all at once: aside first, then renamed; not if it is there already.

    Readers of the parent folder never see a part of it, nor what was written aside.
    """
    spark = df.sparkSession
    if path_exists(spark, path):
        return False
    parent, _, _ = path.rpartition("/")
    aside = f"{parent}/_aside/{uuid.uuid4().hex}"
    df.write.parquet(aside)
    system, source = _hadoop_path(spark, aside)
    if not system.rename(source, spark._jvm.org.apache.hadoop.fs.Path(path)):
        raise RuntimeError(f"{aside} could not be renamed to {path}")
    return True


def release(spark: SparkSession) -> None:
    """Delete everything this application has staged."""
    delete(spark, run_folder(spark))


def delete(spark: SparkSession, path: str) -> None:
    system, folder = _hadoop_path(spark, path)
    system.delete(folder, True)


def _hadoop_path(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder
