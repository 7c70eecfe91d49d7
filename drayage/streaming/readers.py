"""Streams of landed responses, files and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from drayage.landed import LANDED_COLUMNS, LANDED_SCHEMA
from drayage.scratch import batch_numbers, delete, stage, staging_scope
from drayage.sources.aircraft import aircraft_states
from drayage.sources.weather import FIRST_OFFSET, location_key, newer_than, next_offsets, parse_locations, timeline_entries
from drayage.streaming.keyed import newest_stream


def landed_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Responses as they land, as Parquet files of the landed schema or as a landed table."""
    reader = spark.readStream.schema(T.StructType.fromDDL(LANDED_SCHEMA))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path).select(*LANDED_COLUMNS)


def aircraft_stream(landed: DataFrame, region: str | None = None, dedupe_within: str | None = None) -> DataFrame:
    """Aircraft states of every poll; a failed poll adds nothing and stays in the landed table.

    ``dedupe_within`` drops states already seen in an earlier poll within that delay.
    """
    states = aircraft_states(landed, region, on_error="skip")
    if dedupe_within is None:
        return states
    return states.withWatermark("last_contact", dedupe_within).dropDuplicatesWithinWatermark(
        ["icao24", "last_contact"]
    )


def incremental_stream(
    entries: DataFrame,
    first_offsets: DataFrame,
    key: str,
    time: str,
    path: str,
    offsets_path: str,
    checkpoint: str,
    polled: str | None = None,
) -> DataStreamWriter:
    """Keep the entries later than the offset of their key, and move the offsets on.

    Offsets are a table with one version per micro-batch.  A batch always starts from the
    version before its own, so running it again gives the same rows and offsets.  No key is
    gathered in one task: the filter is a join, the new offsets a pre-aggregated maximum.  Of
    entries with the same key and time the one with the largest ``polled`` stays, or without that
    column, the largest of the others.
    """
    spark = entries.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        earlier = [n for n in batch_numbers(spark, offsets_path) if n < batch_id]
        offsets = (
            spark.read.parquet(f"{offsets_path}/stream_batch={max(earlier)}") if earlier else first_offsets
        )
        with staging_scope(spark):
            staged = stage(batch, "batch")
            # Polls overlap, so one batch may hold an entry more than once.
            fresh = latest_polls(newer_than(staged, offsets, key, time), key, time, polled)
            fresh.write.mode("overwrite").parquet(f"{path}/stream_batch={batch_id}")
            moved = next_offsets(staged, offsets, key, time)
            moved.write.mode("overwrite").parquet(f"{offsets_path}/stream_batch={batch_id}")
        # A replay needs the version before its own, and none before that.
        for number in sorted(earlier)[:-1]:
            delete(spark, f"{offsets_path}/stream_batch={number}")

    return entries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def latest_polls(entries: DataFrame, key: str, time: str, polled: str | None = None) -> DataFrame:
    """One entry of each key and time, that of the latest poll; ``polled`` itself is not kept."""
    others = [c for c in entries.columns if c not in (key, time, polled)]
    rank = F.struct(*[F.col(c) for c in ([polled] if polled else []) + others])
    best = entries.groupBy(key, time).agg(F.max(rank).alias("_best"))
    columns = [F.col(c) if c in (key, time) else F.col(f"_best.{c}").alias(c) for c in entries.columns if c != polled]
    return best.select(*columns)


def weather_stream(
    spark: SparkSession,
    path: str,
    frequency: str = "minutely",
    locations: str | None = None,
    forget_after: int | None = None,
) -> DataFrame:
    """``latitude, longitude, weather, timestamp`` of every entry later than those of its location before."""
    landed = landed_stream(spark, path)
    if locations is not None:
        wanted = [location_key(*place) for place in parse_locations(locations)]
        landed = landed.where(F.col("request_key").isin(wanted))
    entries = timeline_entries(landed, frequency, "skip", polled=True)
    fresh = newest_stream(entries, "location", "timestamp", "fetched_at", FIRST_OFFSET, forget_after)
    return fresh.drop("location")


def new_file_stream(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``path, modificationTime, length, content`` of files not seen before."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", pattern)
        .load(path)
    )


def rate_stream(spark: SparkSession, rows_per_second: int, partitions: int | None = None) -> DataFrame:
    """``timestamp, value``: as many rows as seconds have passed, times the rate."""
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    return (reader if partitions is None else reader.option("numPartitions", partitions)).load()


def counter_stream(spark: SparkSession, rows_per_batch: int) -> DataFrame:
    """Consecutive numbers, ``rows_per_batch`` per micro-batch; a replay repeats them."""
    return spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).load().select("value")
