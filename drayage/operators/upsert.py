"""Last write wins, and routing rows to create or update."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_per_key(df: DataFrame, key: str, *order_by: str) -> DataFrame:
    """The row that comes last by ``order_by`` for each key; pre-aggregated before the shuffle."""
    rank = F.struct(*[F.col(f"`{c}`") for c in order_by])
    others = [c for c in df.columns if c != key]
    return (
        df.groupBy(key)
        .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in others]), rank).alias("_row"))
        .select(key, *[F.col("_row").getField(c).alias(c) for c in others])
        .select(*df.columns)
    )


def route_create_update(rows: DataFrame, current: DataFrame, key: str, *order_by: str) -> DataFrame:
    """Last row per key with ``action``: update where the key is in ``current``, else create."""
    known = current.select(key).distinct().withColumn("_known", F.lit(True))
    return (
        last_per_key(rows, key, *order_by)
        .join(known, key, "left")
        .withColumn("action", F.when(F.col("_known"), "update").otherwise("create"))
        .drop("_known")
    )
