"""Requests waiting to be sent.

Every sink turns rows into this one table.  ``batch_id`` and ``idem_key`` follow from the
content alone, so building the outbox again yields the same keys.  Credentials are never
part of it; the sending function adds them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.plans.ranges import NUMBERS_PER_ROW, number_rows
from drayage.scratch import publish

COLUMNS = ("batch_id", "seq", "method", "path", "body", "n_records", "idem_key")
# Of requests that can be split: characters before the first record, and of each record.
SPLIT_COLUMNS = (*COLUMNS, "head", "sizes")
OUTBOX_SCHEMA = (
    "batch_id string, seq int, method string, path string, body string, n_records int, idem_key string, head int, "
    "sizes array<int>"
)


def batch_requests(batches: DataFrame, target: str, method: str, path: str, prefix: str, suffix: str) -> DataFrame:
    """One request per batch: ``prefix``, the payloads joined by commas, ``suffix``."""
    body = F.concat(F.lit(prefix), F.array_join("payloads", ","), F.lit(suffix))
    return (
        batches.withColumn("body", body)
        .withColumn("batch_id", F.concat(F.lit(f"{target}-"), F.col("batch_no").cast("string")))
        .withColumn("seq", F.lit(0))
        .withColumn("method", F.lit(method))
        .withColumn("path", F.lit(path))
        .withColumn("idem_key", content_key(F.col("batch_id"), F.col("body")))
        .withColumn("head", F.lit(len(prefix)))
        .withColumn("sizes", F.transform("payloads", F.length))
        .drop("payloads")
    )


def single_requests(
    rows: DataFrame, target: str, method: Column, path: Column, body: Column, key: Column, distinct: bool
) -> DataFrame:
    """One request per row.  Unless the keys are ``distinct``, equal requests are numbered apart."""
    requests = rows.select(
        F.concat(F.lit(f"{target}-"), key.cast("string")).alias("batch_id"),
        F.lit(0).alias("seq"),
        method.alias("method"),
        path.alias("path"),
        body.alias("body"),
        F.lit(1).alias("n_records"),
        content_key(F.lit(target), key.cast("string"), body).alias("idem_key"),
    )
    return requests if distinct else number_copies(requests)


def number_copies(requests: DataFrame) -> DataFrame:
    """The same requests, where each copy of one has an idempotency key of its own.

    Copies are counted before the shuffle and written out again after it, a great number of
    them by several tasks.
    """
    counted = requests.groupBy(*requests.columns).agg((F.count("*") - 1).alias("_last"))
    few = counted.where(F.col("_last") < NUMBERS_PER_ROW)
    few = few.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_last"))))
    many = number_rows(counted.where(F.col("_last") >= NUMBERS_PER_ROW), F.col("_last"), "_copy")
    copy_key = content_key(F.col("idem_key"), F.col("_copy").cast("string"))
    return (
        few.unionByName(many)
        .withColumn("idem_key", F.when(F.col("_copy") == 0, F.col("idem_key")).otherwise(copy_key))
        .drop("_last", "_copy")
    )


def part_body(body: str, head: int, sizes: list[int], positions: list[int]) -> str:
    """The request with only some of its records; ``head`` and ``sizes`` say where each lies."""
    starts = [head]
    for size in sizes:
        starts.append(starts[-1] + size + 1)
    kept = ",".join(body[starts[p] : starts[p] + sizes[p]] for p in positions)
    return body[:head] + kept + body[starts[-1] - 1 :]


def content_key(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u001f", *parts), 256)


def write_batch(outbox: DataFrame, path: str, batch_id: int) -> None:
    """Write the outbox of one micro-batch as one folder, which appears whole or not at all.

    A replay finds the folder and leaves it.  The batch is part of the keys: the same rows in a later
    batch are new requests.
    """
    keyed = outbox.withColumn("idem_key", content_key(F.lit(str(batch_id)), F.col("idem_key")))
    publish(keyed, f"{path}/stream_batch={batch_id}")
