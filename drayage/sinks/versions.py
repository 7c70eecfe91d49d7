"""Appending columnar fragments under numbered versions.

Fragments are Parquet folders.  A version is a small file that lists the fragments it is
made of; publishing one succeeds for a single writer, so two appends that read the same
version cannot both succeed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class VersionConflict(RuntimeError):
    """Another append was published since the version this one was based on."""


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The last published version, or None where nothing was written yet; 0 is a version."""
    system, folder = _versions(spark, path)
    if not system.exists(folder):
        return None
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    return max(numbers, default=None)


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    manifest = _manifest(spark, path, latest_version(spark, path) if version is None else version)
    return spark.read.schema(_schema(manifest)).parquet(*[f"{path}/{f}" for f in manifest["fragments"]])


def append_version(df: DataFrame, path: str, based_on: int | None, mode: str = "append") -> int:
    """Write ``df`` as a new fragment and publish the version after ``based_on``."""
    if mode != "append":
        raise ValueError("datasets are only appended to, not replaced")
    if not path:
        raise ValueError("a dataset needs the option path")
    spark = df.sparkSession
    if based_on is None:
        earlier, version = [], 0
    else:
        manifest = _manifest(spark, path, based_on)
        if _schema(manifest) != _nullable(df):
            raise ValueError("schema differs from that of the dataset")
        earlier, version = manifest["fragments"], based_on + 1
    fragment = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{fragment}")
    _publish(spark, path, version, {"schema": _nullable(df).json(), "fragments": [*earlier, fragment]})
    return version


def _nullable(df: DataFrame) -> T.StructType:
    """The schema as it reads back: every field may be null."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])


def _schema(manifest: dict) -> T.StructType:
    return T.StructType.fromJson(json.loads(manifest["schema"]))


def _versions(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_versions")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _manifest(spark: SparkSession, path: str, version: int | None) -> dict:
    if version is None:
        raise ValueError(f"no dataset at {path}")
    return json.loads(spark.read.text(f"{path}/_versions/{version}.json", wholetext=True).first()[0])


def _publish(spark: SparkSession, path: str, version: int, manifest: dict) -> None:
    system, folder = _versions(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{version}.json")
    system.mkdirs(folder)
    # Written aside first: a version is there in full or not at all.
    aside = spark._jvm.org.apache.hadoop.fs.Path(folder, f".{version}-{uuid.uuid4().hex}")
    out = system.create(aside, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    no_options = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(aside, target, no_options)
    except Exception as error:
        system.delete(aside, False)
        if system.exists(target):
            raise VersionConflict(f"version {version} of {path} is already published") from error
        raise
