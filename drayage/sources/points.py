"""Points of a vector store."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.landed import parsed
from drayage.plans.cursors import in_range
from drayage.plans.point_filter import payload_predicate

# Text fields take ids of any type, and vectors and payloads as the JSON they are.
SCROLL_DDL = (
    "result STRUCT<points: ARRAY<STRUCT<id: STRING, vector: STRING, payload: STRING, "
    "shard_key: STRING, order_value: STRING>>, next_page_offset: STRING>"
)


def points(
    landed: DataFrame,
    with_payload: bool = True,
    with_vector: bool = True,
    condition: Mapping[str, Any] | None = None,
    on_error: str = "fail",
) -> DataFrame:
    """``id, vector, payload, shard_key, order_value``; a part not asked for is null."""
    rows = (
        parsed(landed, SCROLL_DDL, on_error)
        .select("request_key", F.explode("doc.result.points").alias("p"))
        .where(in_range(F.col("request_key"), F.col("p.id")))
        .select("p.id", "p.vector", "p.payload", "p.shard_key", _whole("p.order_value").alias("order_value"))
    )
    if condition is not None:
        rows = rows.where(payload_predicate(condition, F.col("payload")))
    nothing = F.lit(None).cast("string")
    if not with_payload:
        rows = rows.withColumn("payload", nothing)
    if not with_vector:
        rows = rows.withColumn("vector", nothing)
    return rows


def _whole(number: str) -> Column:
    """A number given as text, cut to a whole one; whole numbers of any length stay exact."""
    exact = F.col(number).try_cast("long")
    return F.coalesce(exact, F.col(number).try_cast("double").try_cast("long"))


def typed_points(rows: DataFrame) -> DataFrame:
    """Points with the vector as ``array<float>``, for unnamed vectors."""
    return rows.withColumn("vector", F.from_json("vector", "ARRAY<FLOAT>"))


def scroll_pages(landed: DataFrame) -> DataFrame:
    """Landed pages with the offset that follows each, for the chain check."""
    return parsed(landed, SCROLL_DDL).select(
        "request_key", "page_no", F.col("doc.result.next_page_offset").alias("next_offset")
    )
