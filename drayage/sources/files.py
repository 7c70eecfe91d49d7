"""File-backed tables: exported sheets, dataset splits, CSV datasets and text lines."""

from __future__ import annotations

import ast
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.functions.convert import strip_line_end
from drayage.functions.sheets import unique_names

# A quote within a quoted cell is doubled; a backslash is a character like any other.
_QUOTING = {"quote": '"', "escape": '"'}


def sheet_schema(spark: SparkSession, path: str) -> T.StructType:
    """All-string columns named by the header line."""
    # Every exported sheet of one read has the same header; one row is all the driver sees.
    row = spark.read.options(**_QUOTING, multiLine=True).csv(path).limit(1).collect()
    if not row or not any(row[0]):
        raise ValueError(f"no header line in {path}")
    return T.StructType([T.StructField(n, T.StringType()) for n in unique_names(row[0])])


def read_sheet(spark: SparkSession, path: str, schema: T.StructType | str | None = None, has_header: bool = True):
    """An exported sheet; a given schema renames columns by position and sets their types."""
    if schema is None:
        if not has_header:
            raise ValueError("a sheet without a header needs a schema")
        schema = sheet_schema(spark, path)
    return (
        spark.read.schema(schema)
        .options(**_QUOTING, multiLine=True)
        .option("header", has_header)
        .option("enforceSchema", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def read_split(
    spark: SparkSession,
    path: str,
    split: str = "train",
    schema: T.StructType | str | None = None,
    as_text: bool = True,
) -> DataFrame:
    """One split of a dataset folder ``data/<split>-*``.

    Without a schema every feature is text, unless ``as_text`` is false.  With a schema,
    columns are taken by name and absent ones are null.
    """
    stored = spark.read.parquet(f"{path}/data/{split}-*")
    if schema is None:
        return stringify(stored) if as_text else stored
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    present = set(stored.columns)
    return stored.select(
        [
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in wanted.fields
        ]
    )


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_dataset_csv(
    spark: SparkSession, path: str, options: Mapping[str, str] | None = None, sampling_ratio: float = 1.0
) -> DataFrame:
    """A CSV file of a downloaded dataset with inferred types; options are Python literals.

    Cells may hold line breaks, so a file is read by one task.  ``multiLine`` false lets large
    files without them be split.
    """
    passed = {k: ast.literal_eval(v) if isinstance(v, str) else v for k, v in (options or {}).items()}
    given = {"header": True, "inferSchema": True, "samplingRatio": sampling_ratio, "mode": "FAILFAST"}
    return spark.read.options(**{**given, **_QUOTING, "multiLine": True, **passed}).csv(path)


def read_lines(spark: SparkSession, path: str, recursive: bool = False, pattern: str | None = None) -> DataFrame:
    """One row ``value`` per line of a file or folder, without the line end.

    As everywhere in Spark, files whose name starts with ``_`` or ``.`` are not read.
    """
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(strip_line_end(F.col("value")).alias("value"))


def new_files(listing: DataFrame, seen: DataFrame, key: str = "path") -> DataFrame:
    """Entries of a listing that were not there before."""
    return listing.join(seen.select(key).distinct(), key, "left_anti")
