"""Weather timelines, read incrementally per location."""

from __future__ import annotations

import ast

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.landed import parsed
from drayage.operators.joins import join_keyed

TIMELINES_DDL = "timelines MAP<STRING, ARRAY<STRUCT<time: STRING, values: STRING>>>"
FREQUENCIES = ("minutely", "hourly", "daily")
# Fixed value: where a location that was never read starts.
FIRST_OFFSET = "2024-09-01T00:00:00Z"


def parse_locations(text: str) -> list[tuple[float, float]]:
    """``[(lat, lon), ...]`` as given in an option."""
    try:
        return [(float(lat), float(lon)) for lat, lon in ast.literal_eval(text)]
    except (SyntaxError, TypeError, ValueError) as error:
        raise ValueError("locations must be a list of (latitude, longitude) pairs") from error


def location_key(latitude: float, longitude: float) -> str:
    return f"{latitude},{longitude}"


def location_frame(spark: SparkSession, text: str) -> DataFrame:
    rows = [(location_key(lat, lon), lat, lon) for lat, lon in parse_locations(text)]
    return spark.createDataFrame(rows, "location string, latitude double, longitude double")


def initial_offsets(locations: DataFrame) -> DataFrame:
    return locations.select("location", F.lit(FIRST_OFFSET).alias("last_time"))


def timeline_entries(
    landed: DataFrame, frequency: str = "minutely", on_error: str = "fail", polled: bool = False
) -> DataFrame:
    """``location, latitude, longitude, weather, timestamp`` for every entry of the chosen timeline.

    With ``polled`` the time the response was fetched stays as ``fetched_at``.
    """
    if frequency not in FREQUENCIES:
        raise ValueError(f"Unsupported frequency: {frequency}; must be one of: {', '.join(FREQUENCIES)}")
    parts = F.split("location", ",")
    return (
        parsed(landed, TIMELINES_DDL, on_error)
        .select(
            F.col("request_key").alias("location"),
            "fetched_at",
            F.explode(F.col("doc.timelines")[frequency]).alias("e"),
        )
        .select(
            "location",
            F.get(parts, F.lit(0)).cast("double").alias("latitude"),
            F.get(parts, F.lit(1)).cast("double").alias("longitude"),
            F.col("e.values").alias("weather"),
            F.col("e.time").alias("timestamp"),
            *(["fetched_at"] if polled else []),
        )
    )


def newer_than(entries: DataFrame, offsets: DataFrame, key: str, time: str, offset: str = "last_time") -> DataFrame:
    """Entries strictly later than the offset of their key; a key without offset is all new."""
    joined = join_keyed(entries, offsets.select(key, F.col(offset).alias("_start")), key, "left")
    return joined.where(F.col("_start").isNull() | (F.col(time) > F.col("_start"))).drop("_start")


def next_offsets(entries: DataFrame, offsets: DataFrame, key: str, time: str, offset: str = "last_time") -> DataFrame:
    """The offset of every key after reading ``entries``: it never moves back."""
    seen = entries.groupBy(key).agg(F.max(time).alias("_seen"))
    return offsets.join(seen, key, "full").select(key, F.greatest(F.col(offset), F.col("_seen")).alias(offset))
