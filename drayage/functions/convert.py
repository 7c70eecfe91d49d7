"""Tolerant conversions and the hashing rules of the event sink."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHITESPACE = " \t\n\r\f\v"
HEX_DIGEST = r"\A[0-9a-f]{64}\z"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def strip_line_end(col: Column) -> Column:
    """Drop trailing carriage returns and line feeds."""
    return F.rtrim(col, F.lit("\r\n"))


def safe_double(col: Column, default: float | None = None) -> Column:
    """A double, or ``default`` where the text is empty or no number."""
    value = col.try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def safe_int(col: Column) -> Column:
    return col.try_cast("double").try_cast("int")


def safe_boolean(col: Column) -> Column:
    return col.try_cast("boolean")


def epoch_to_timestamp(col: Column) -> Column:
    """Seconds since 1970 to a UTC instant; null stays null."""
    return F.timestamp_seconds(col.try_cast("double"))


def event_epoch(col: Column, data_type: T.DataType) -> Column:
    """Whole seconds of an event time: an instant, a number, or now where it is null."""
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        seconds = col.cast("timestamp").cast("long")
    else:
        seconds = col.try_cast("long")
    now = F.unix_timestamp(F.current_timestamp())
    return F.when(col.isNull(), now).otherwise(seconds)


def hash_unless_hashed(col: Column) -> Column:
    """SHA-256 in lower-case hex, leaving a value that already is one as it is."""
    return F.when(col.rlike(HEX_DIGEST), col).otherwise(F.sha2(col, 256))


def hashed_email(col: Column) -> Column:
    return hash_unless_hashed(F.lower(strip(col)))


def hashed_phone(col: Column) -> Column:
    return hash_unless_hashed(strip(col))


def truthy(col: Column, data_type: T.DataType) -> Column:
    """The value, or null where it is empty: no text, zero or false."""
    if isinstance(data_type, T.StringType):
        return F.nullif(col, F.lit(""))
    if isinstance(data_type, T.BooleanType):
        return F.nullif(col, F.lit(False))
    if isinstance(data_type, T.NumericType):
        return F.nullif(col, F.lit(0).cast(data_type))
    return col


def first_filled(schema: T.StructType, *names: str) -> Column | None:
    """The first non-empty value among the named columns that exist, as text."""
    present = [n for n in names if n in schema.fieldNames()]
    if not present:
        return None
    return F.coalesce(*[truthy(F.col(f"`{n}`"), schema[n].dataType).cast("string") for n in present])


def iso_text(col: Column, data_type: T.DataType) -> Column:
    """ISO 8601 text of a date or time; microseconds only where there are any."""
    if isinstance(data_type, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    micros = F.date_format(col, "SSSSSS")
    seconds = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == "000000", seconds).otherwise(F.concat(seconds, F.lit("."), micros))


def record_value(col: Column, data_type: T.DataType) -> Column:
    """A value as a CRM record takes it: numbers and booleans as they are, the rest as text."""
    if isinstance(data_type, (T.BooleanType, T.IntegralType, T.FractionalType)) and not isinstance(
        data_type, T.DecimalType
    ):
        return col
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return iso_text(col, data_type)
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return F.to_json(col)
    return col.cast("string")
