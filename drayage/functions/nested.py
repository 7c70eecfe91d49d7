"""Nested values: flattening, JSON text, and JSON objects built from parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_struct(df: DataFrame, separator: str = "_") -> DataFrame:
    """Replace every struct column by its leaves, named by the path to them."""

    def leaves(path: list[str], data_type: T.DataType):
        if isinstance(data_type, T.StructType):
            for child in data_type.fields:
                yield from leaves([*path, child.name], child.dataType)
        else:
            yield F.col(".".join(f"`{p}`" for p in path)).alias(separator.join(path))

    return df.select([leaf for f in df.schema.fields for leaf in leaves([f.name], f.dataType)])


def default(col: Column, value) -> Column:
    return F.coalesce(col, F.lit(value))


def is_json(col: Column) -> Column:
    """Whether the text is exactly one JSON value; false for null.

    Spark's parsers stop after the first value, so the text is put into an array and into an
    object: whatever follows the value breaks at least one of the two.
    """
    in_array = F.json_array_length(F.concat(F.lit("["), col, F.lit("]")))
    in_object = F.json_object_keys(F.concat(F.lit('{"v":'), col, F.lit("}")))
    return F.coalesce(in_array == 1, F.lit(False)) & in_object.isNotNull()


def json_text(df: DataFrame, name: str, on_bad: str = "fail") -> Column:
    """A column as JSON text: text is checked and kept, any other value is serialised.

    The text ``null`` is a null.  Invalid text raises an error that names the column; ``on_bad="null"`` yields null.
    """
    data_type = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if not isinstance(data_type, T.StringType):
        return F.to_json(col) if _is_complex(data_type) else scalar_json(col)
    bad = (
        F.raise_error(F.lit(f"field '{name}' must be valid JSON when provided as string")).cast("string")
        if on_bad == "fail"
        else F.lit(None).cast("string")
    )
    empty = col.isNull() | (F.btrim(col) == "null")
    return F.when(empty, F.lit(None).cast("string")).when(is_json(col), col).otherwise(bad)


def scalar_json(col: Column) -> Column:
    """A scalar as JSON text; null stays null."""
    return _matched(F.to_json(F.struct(col.alias("v"))), r'(?s)\A\{"v":(.*)\}\z', 1)


def members(*fields: Column) -> Column:
    """The non-null fields as JSON members without braces, or null where none is left."""
    return _matched(F.to_json(F.struct(*fields)), r"(?s)\A\{(.+)\}\z", 1)


def member(name: str, json: Column) -> Column:
    """One member whose value already is JSON text; null where the value is null."""
    return F.concat(F.lit(f'"{name}":'), json)


def json_object(*parts: Column) -> Column:
    """Join members into an object; null parts are left out."""
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def json_object_or_null(*parts: Column) -> Column:
    return _matched(json_object(*parts), r"(?s)\A\{.+\}\z", 0)


def any_filled(names: list[str]) -> Column:
    """Whether a row has a value in at least one of the columns."""
    return reduce(Column.__or__, [F.col(f"`{n}`").isNotNull() for n in names], F.lit(False))


def _matched(text: Column, pattern: str, group: int) -> Column:
    """The group of the first match, or null; names ``text`` once, so it is built once per row."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(0))


def _is_complex(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType))
