"""Points of a vector store, upserted in batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage import outbox
from drayage.functions.nested import json_object, json_text, member, scalar_json
from drayage.operators.batching import batch_assign, collect_batches

DEFAULT_BATCH = 100
POINT_PARTS = ("id", "vector", "payload", "shard_key")


def point_json(rows: DataFrame) -> Column:
    """The point of a row as JSON: ids and shard keys as given, vector and payload as text or value."""
    parts = []
    for name in POINT_PARTS:
        if name not in rows.columns:
            continue
        value = json_text(rows, name) if name in ("vector", "payload") else scalar_json(F.col(name))
        parts.append(member(name, value))
    return json_object(*parts)


def last_points(rows: DataFrame) -> DataFrame:
    """The last row of each id and shard key, as they come; rows without an id all stay.

    Requests are sent in no order, so of two versions of a point only one may be among them.
    """
    if "id" not in rows.columns:
        return rows
    keys = [c for c in ("id", "shard_key") if c in rows.columns]
    others = ["_at", *[c for c in rows.columns if c not in keys]]
    version = F.struct(*[F.col(f"`{c}`") for c in others])
    return (
        rows.withColumn("_at", F.monotonically_increasing_id())
        .groupBy(*keys, F.when(F.col("id").isNull(), F.col("_at")).alias("_lone"))
        .agg(F.max_by(version, "_at").alias("_last"))
        .select(*keys, *[F.col("_last").getField(c).alias(c) for c in others[1:]])
        .select(*[F.col(f"`{c}`") for c in rows.columns])
    )


def point_outbox(
    rows: DataFrame, collection: str, *order_by: str | Column, batch_size: int = DEFAULT_BATCH, wait: bool = True
) -> DataFrame:
    """Upserts of up to ``batch_size`` points each, in the order of ``order_by`` or else as they come.

    Of rows with the same id the last is sent.
    """
    batched = batch_assign(last_points(rows), batch_size, *order_by)
    batches = collect_batches(batched, point_json(rows))
    path = f"/collections/{collection}/points?wait={str(wait).lower()}"
    return outbox.batch_requests(batches, f"points-{collection}", "PUT", path, '{"points":[', "]}").select(
        *outbox.SPLIT_COLUMNS
    )
