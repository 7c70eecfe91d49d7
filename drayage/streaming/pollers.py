"""Asking a service again and again, into a landed table that streams read."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from drayage.landed import LANDED_SCHEMA, Get, fetch
from drayage.operators.outcomes import NO_ANSWER, SECONDS_PER_DAY
from drayage.scratch import make_folder, path_exists, publish

CUT_OFF = "the poll was cut off before its answer landed"


def polling_stream(
    spark: SparkSession,
    requests: DataFrame,
    source: str,
    get: Get,
    path: str,
    checkpoint: str,
    max_in_flight: int | None = None,
    gap_seconds: float = 0.0,
    daily_quota: int | None = None,
) -> DataStreamWriter:
    """A stream that sends ``requests`` once for each trigger; answers land in a folder of ``path`` each.

    Start it with the trigger of choice.  Before a poll asks, it marks its number; its answers land as
    one folder, all or nothing.  A poll that runs again after a crash finds the answers and does
    not ask, or finds only the mark: then nobody knows whether the service was asked, and a row
    without an answer (status 0) lands for each request, as for any poll that failed.  Readers of
    the table skip such rows, so what they remember stays as it was and the next poll makes up for it.

    Polls start at least ``gap_seconds`` after the answers of the one before have landed; beyond
    ``daily_quota`` requests in a UTC day polls ask nothing until the next.
    """
    make_folder(spark, path)
    n_requests = requests.count()

    def poll(batch: DataFrame, number: int) -> None:
        folder, mark = f"{path}/poll={number}", f"{path}/_asked/{number}"
        if path_exists(spark, folder):
            return
        if path_exists(spark, mark):
            lost = requests.select(
                F.lit(source).alias("source"),
                F.col("request_key").cast("string").alias("request_key"),
                F.col("page_no").cast("long").alias("page_no"),
                F.current_timestamp().alias("fetched_at"),
                F.lit(NO_ANSWER).alias("status"),
                F.lit(CUT_OFF).alias("body"),
            )
            publish(lost, folder)
            return
        last, today = _used(spark, path)
        if daily_quota is not None and today + n_requests > daily_quota:
            publish(spark.createDataFrame([], LANDED_SCHEMA), folder)
            return
        time.sleep(max(0.0, last + gap_seconds - time.time()))
        make_folder(spark, mark)
        publish(fetch(requests, source, get, max_in_flight), folder)

    clock = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    return clock.writeStream.foreachBatch(poll).option("checkpointLocation", checkpoint)


def _used(spark: SparkSession, path: str) -> tuple[float, int]:
    """When the last answer landed, and how many today; footers of other days' files rule them out."""
    today = int(time.time() // SECONDS_PER_DAY) * SECONDS_PER_DAY
    landed = spark.read.schema(LANDED_SCHEMA).parquet(path)
    recent = landed.where(F.col("fetched_at") >= F.timestamp_seconds(F.lit(today - SECONDS_PER_DAY)))
    at = F.unix_micros("fetched_at") / F.lit(1e6)
    last, count = recent.agg(F.max(at), F.count_if(at >= today)).first()
    return last or 0.0, count
