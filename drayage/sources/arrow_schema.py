"""One schema for many Arrow files: all footers are read by a job and their types merged as in a tree."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema

from drayage.sources.arrow_ipc import list_files, open_path

FOOTERS_PER_TASK, SCHEMAS_PER_TASK = 64, 256
# From narrow to wide; a type holds all before it.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds the values of both; raises where there is none.

    Whole numbers widen to larger ones, to decimals of enough digits, and with any fraction to double;
    dates to timestamps; structs by field; nothing becomes text by itself.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return a if _WHOLE.index(type(a)) > _WHOLE.index(type(b)) else b
    if kinds <= {*_WHOLE, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if T.DecimalType in kinds and kinds <= {*_WHOLE, T.DecimalType}:
        a, b = ((x if isinstance(x, T.DecimalType) else T.DecimalType(_DIGITS[type(x)], 0)) for x in (a, b))
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        if digits <= 38:
            return T.DecimalType(digits, scale)
    elif kinds in ({T.DateType, T.TimestampType}, {T.DateType, T.TimestampNTZType}):
        return a if isinstance(b, T.DateType) else b
    elif kinds == {T.ArrayType}:
        return T.ArrayType(wider(a.elementType, b.elementType), a.containsNull or b.containsNull)
    elif kinds == {T.MapType}:
        value = wider(a.valueType, b.valueType)
        return T.MapType(wider(a.keyType, b.keyType), value, a.valueContainsNull or b.valueContainsNull)
    elif kinds == {T.StructType}:
        return merged(a, b)
    raise TypeError(f"no type holds both {a.simpleString()} and {b.simpleString()}")


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """All fields of both, those of the first before the others; a field that one lacks may be null."""
    others, fields = {f.name: f for f in b.fields}, []
    for field in a.fields:
        other = others.pop(field.name, None)
        if other is None:
            fields.append(T.StructField(field.name, field.dataType, True))
            continue
        try:
            kind = wider(field.dataType, other.dataType)
        except TypeError as error:
            raise TypeError(f"column {field.name}: {error}") from None
        fields.append(T.StructField(field.name, kind, field.nullable or other.nullable))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in others.values()]])


def _footer(path: str) -> T.StructType:
    system, inner = open_path(path)
    with system.open_input_file(inner) as source, pa.ipc.open_file(source) as reader:
        return from_arrow_schema(reader.schema, prefer_timestamp_ntz=True)


def _merge_all(schemas: Iterator[tuple[int, T.StructType]]) -> pd.DataFrame:
    """One row of the merged schema, under the smallest number."""
    least, found = None, None
    for number, schema in schemas:
        least = number if least is None else least
        found = schema if found is None else merged(found, schema)
    return pd.DataFrame({"number": [] if found is None else [least], "schema": [] if found is None else [found.json()]})


def merged_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema of all files behind ``path``, columns in the order the files, by name, bring them up.

    Footers are read by tasks of a bounded number of files each.  A task's schemas become one, those of
    a bounded number of tasks become one, and so on to the last, so no task and not the driver
    ever holds more than that.
    """
    scheme = path.split("://")[0] + "://" if "://" in path else ""
    system, files = list_files(path)
    if not files:
        raise ValueError(f"there is no Arrow file at {path}")
    names = [f"{scheme}{f.path}" for f in files]
    listed = spark.createDataFrame(list(enumerate(names)), "number long, path string")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((int(n), p) for frame in frames for n, p in zip(frame["number"], frame["path"]))
        yield _merge_all((n, _footer(p)) for n, p in sorted(rows))

    def merge(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((int(n), s) for frame in frames for n, s in zip(frame["number"], frame["schema"]))
        yield _merge_all((n, T.StructType.fromJson(json.loads(s))) for n, s in sorted(rows))

    shape = "number long, schema string"
    count = math.ceil(len(names) / FOOTERS_PER_TASK)
    size = FOOTERS_PER_TASK  # neighbouring files in one task
    level = _dealt(listed, size, count).mapInPandas(read, shape)
    while count > 1:
        size, count = size * SCHEMAS_PER_TASK, math.ceil(count / SCHEMAS_PER_TASK)
        level = _dealt(level, size, count).mapInPandas(merge, shape)
    return T.StructType.fromJson(json.loads(level.first()["schema"]))


def _dealt(rows: DataFrame, size: int, count: int) -> DataFrame:
    """Rows with neighbouring numbers together, ``count`` partitions."""
    if count == 1:
        return rows.coalesce(1)
    return rows.repartitionById(count, (F.floor(F.col("number") / size) % count).cast("int"))
