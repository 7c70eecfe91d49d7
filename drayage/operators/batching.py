"""Dense numbering and fixed-size batches without a single-task window."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.operators.joins import BROADCAST_ROWS
from drayage.scratch import stage

# monotonically_increasing_id() keeps the partition above bit 33 and the position below it.
_POSITION_BITS = 33


def dense_index(df: DataFrame, *order_by: str | Column, name: str = "idx") -> DataFrame:
    """Number the rows 0..n-1, in the order of ``order_by`` or else as they come.

    Rows are range-partitioned, so every executor numbers its own range.  The numbered
    ranges are staged once; one count per range then gives the offset of each.  Rows that
    agree on all of ``order_by`` are ordered by input position, so that a heavily repeated
    key is spread over several ranges.  Without ``order_by`` there is no shuffle at all, and
    the numbers hold for this run only.

    Index the rows first and build payloads afterwards: the range sampling reads ``df`` twice.
    """
    ranges = df
    if order_by:
        order = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by] + [F.col("_tie")]
        ranges = (
            df.withColumn("_tie", F.monotonically_increasing_id())
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .drop("_tie")
        )
    staged = stage(ranges.withColumn("_pos", F.monotonically_increasing_id()), "index")
    range_no = F.shiftright("_pos", _POSITION_BITS)
    counts = sorted(staged.groupBy(range_no.alias("r")).count().collect())
    starts = accumulate((n for _, n in counts), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(r, start) for (r, _), start in zip(counts, starts)], "_range long, _start long"
    )
    position = F.col("_pos").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # One row of 16 bytes per partition.  Beyond the bound the join shuffles by range, which is even.
    if len(counts) <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    return (
        staged.withColumn("_range", range_no)
        .join(offsets, "_range")
        .withColumn(name, F.col("_start") + position)
        .drop("_range", "_start", "_pos")
    )


def batch_assign(df: DataFrame, size: int, *order_by: str | Column) -> DataFrame:
    """Add ``batch_no`` and ``seq``: full batches of ``size`` and one remainder."""
    if size <= 0:
        raise ValueError("batch size must be a positive integer")
    return (
        dense_index(df, *order_by)
        .withColumn("batch_no", F.expr(f"idx div {size}"))
        .withColumn("seq", (F.col("idx") % size).cast("int"))
        .drop("idx")
    )


def orderable(schema: T.StructType) -> list[str]:
    """Columns that rows can be ordered by; together they order rows the same way on every run."""
    return [f.name for f in schema.fields if _has_order(f.dataType)]


def row_order(schema: T.StructType) -> list[Column]:
    """A digest of the row to order rows by: as sure as all columns, and short wherever it is sampled or sorted."""
    names = orderable(schema)
    return [F.sha2(F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])), 256)] if names else []


def _has_order(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_has_order(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _has_order(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def collect_batches(batched: DataFrame, payload: Column, *keep: Column) -> DataFrame:
    """One row per batch with its payload texts in order; a group never exceeds the batch size."""
    ordered = F.sort_array(F.collect_list(F.struct("seq", "_payload")))
    return (
        batched.withColumn("_payload", payload)
        .groupBy("batch_no")
        .agg(ordered.alias("_items"), F.count("*").cast("int").alias("n_records"), *keep)
        .withColumn("payloads", F.transform("_items", lambda i: i["_payload"]))
        .drop("_items")
    )
