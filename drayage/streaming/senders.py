"""Sending what streams put into an outbox."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from drayage.operators.deliver import BASE_SECONDS, Send, read_outcomes, settle
from drayage.operators.pacing import Pace
from drayage.outbox import OUTBOX_SCHEMA
from drayage.scratch import make_folder, stage, staging_scope

FILES_PER_TRIGGER = 64


def sending_stream(
    spark: SparkSession,
    outbox_path: str,
    outcomes_path: str,
    checkpoint: str,
    send: Send,
    max_in_flight: int | None = None,
    base_seconds: float = BASE_SECONDS,
    pace: Pace | None = None,
    files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataStreamWriter:
    """A stream over the batch folders of an outbox that sends every request in them.

    Outcomes are committed under the number of the outbox batch they belong to, round by round, and a
    batch is first compared with what is there under its number.  So a micro-batch that runs
    again, or an outbox batch that appears twice, sends only what has no outcome yet; no other
    batch's outcomes are read.  Requests that fail for good do not stop the stream: their outcomes say so.
    """
    make_folder(spark, outbox_path)
    # The number is read from the path: folders that appear later may not count as partitions yet.
    number = F.regexp_extract("_metadata.file_path", "/stream_batch=([0-9]+)/", 1).cast("long")
    requests = (
        spark.readStream.schema(OUTBOX_SCHEMA)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(outbox_path)
        .select(*[c.split()[0] for c in OUTBOX_SCHEMA.split(", ")], number.alias("stream_batch"))
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        with staging_scope(spark):
            staged = stage(batch, "to-send")
            # No more numbers than files in a trigger.
            numbers = sorted(row[0] for row in staged.select("stream_batch").distinct().collect())
            for number in numbers:
                own = staged.where(F.col("stream_batch") == number).drop("stream_batch")
                settle(own, send, f"{outcomes_path}/stream_batch={number}", max_in_flight, base_seconds, pace)

    return requests.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def sent(spark: SparkSession, outcomes_path: str) -> DataFrame | None:
    """The outcomes of all batches."""
    return read_outcomes(spark, outcomes_path)
