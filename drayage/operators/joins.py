"""Joining a large table to a keyed one without assuming either is small or even."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.scratch import stage

# A broadcast side is proven to stay within both bounds before the hint is given.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024


def is_bounded(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows of ``max_bytes`` in all, as JSON text.

    Only row lengths reach the driver, no more than one beyond the bound, and a large frame
    is read no further than that.
    """
    lengths = df.select(F.octet_length(F.to_json(F.struct("*")))).head(max_rows + 1)
    return len(lengths) <= max_rows and sum(row[0] for row in lengths) <= max_bytes


def join_keyed(
    big: DataFrame,
    keyed: DataFrame,
    on: str,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``big`` to ``keyed``, which holds one row per value of ``on``.

    A keyed side of proven size is broadcast.  Otherwise the keys too frequent for one
    shuffle partition are joined apart: there can be at most ``2 * partitions`` of them, so
    their rows of the keyed side are broadcast, while the rest goes through an ordinary
    shuffle join.  Every row takes exactly one of the two ways.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"join_keyed supports inner and left, not {how}")
    if is_bounded(keyed, max_rows):
        return big.join(F.broadcast(keyed), on, how)

    hot = hot_keys(big, on)
    if not hot:
        return big.join(keyed, on, how)
    is_hot = F.coalesce(F.col(on).isin(hot), F.lit(False))
    cold = big.where(~is_hot).join(keyed.where(~is_hot), on, how)
    hot_side = keyed.where(is_hot)
    if is_bounded(hot_side):
        hot_side = F.broadcast(hot_side)
    return cold.unionByName(big.where(is_hot).join(hot_side, on, how))


def hot_keys(df: DataFrame, on: str) -> list:
    """Keys that hold more rows than half an even shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One pass over the rows; the counts have one row per key and are staged for the two reads.
    counts = stage(df.where(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # More than total / (2 * partitions) rows each: fewer than 2 * partitions keys qualify.
    frequent = counts.where(F.col("n") * (2 * partitions) > F.lit(total))
    return [row[0] for row in frequent.select(on).collect()]
