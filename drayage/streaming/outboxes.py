"""Streams into an outbox: each micro-batch is one folder that a replay overwrites."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from drayage.outbox import write_batch
from drayage.scratch import stage, staging_scope


def outbox_stream(
    rows: DataFrame, build: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> DataStreamWriter:
    """A stream writer that turns every micro-batch into requests; start it with the trigger of choice.

    ``build`` is one of the outbox functions of ``drayage.sinks``.  The keys of the requests
    follow from their content and the folder from the batch id, so a batch that runs again
    after a crash leaves the outbox as it was.  The source of a batch is read once.
    """
    spark = rows.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        with staging_scope(spark):
            write_batch(build(stage(batch, "batch")), path, batch_id)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    """All requests written so far, with the micro-batch each came from."""
    return spark.read.parquet(path)
