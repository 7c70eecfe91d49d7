"""Sharding by Karmarkar-Karp differencing: indivisible groups, shards of nearly equal bytes.

Rows with equal texts form a group that stays together.  Groups are first filled into bundles
of at most twice a small fixed share of all bytes; a group above that share is a bundle of its
own.  So the number of bundles depends on the number of shards and tasks only, not on the size
of the corpus, and one task can difference them all: it keeps partial partitions of some bundles
into all shards, takes the two with the largest spread, and adds them in opposite order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from drayage.llm.salted import join_back, salt_mask, salt_of
from drayage.scratch import stage

FINENESS = 100  # bundles that an even shard holds, about
OVERHEAD = 8  # bytes added for each row


def difference(sizes: list[int], shards: int) -> list[int]:
    """A shard for each size, by repeatedly combining the two partitions with the largest spread.

    A partition is a list of sums, largest first.  Adding two in opposite order evens them out.
    Ties are taken in the order of the sizes given.
    """
    if not sizes:
        return []
    # Node i < n holds size i alone in its first sum; later nodes are combinations.
    sums = [np.zeros(shards, dtype=np.int64) for _ in sizes]
    for i, size in enumerate(sizes):
        sums[i][0] = size
    parts: list[tuple[int, int, np.ndarray, np.ndarray] | None] = [None] * len(sizes)
    heap = [(-size, i) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = sums[a] + sums[b][::-1]
        order = np.argsort(-total, kind="stable")
        place = np.empty(shards, dtype=np.int64)
        place[order] = np.arange(shards)
        # Where the sums of a and of b have gone.
        parts.append((a, b, place, place[::-1]))
        sums[a] = sums[b] = None
        sums.append(total[order])
        heapq.heappush(heap, (int(total[order[-1]] - total[order[0]]), len(sums) - 1))
    found = [0] * len(sizes)
    todo = [(heap[0][1], np.arange(shards))]
    while todo:
        node, place = todo.pop()
        if parts[node] is None:
            found[node] = int(place[0])
        else:
            a, b, to_a, to_b = parts[node]
            todo += [(a, place[to_a]), (b, place[to_b])]
    return found


def _bundles(groups: DataFrame, share: int) -> DataFrame:
    """``digest``, ``salts``, ``bytes`` and ``bundle``: runs of a task's groups of up to two shares."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, alone = 0, 0
        for batch in batches:
            sizes = batch.column("bytes").to_numpy()
            large = sizes > share
            small = np.where(large, 0, sizes)
            upto = before + np.cumsum(small)
            # Even numbers are runs of small groups, odd ones are large groups.
            number = np.where(large, 2 * (alone + np.cumsum(large)) + 1, 2 * ((upto - small) // share))
            if batch.num_rows:
                before, alone = int(upto[-1]), alone + int(large.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("digest", "salts", "bytes")] + [batch.column("task"), pa.array(number)],
                ["digest", "salts", "bytes", "task", "number"],
            )

    dealt = groups.withColumn("task", F.spark_partition_id())
    return dealt.mapInArrow(run, "digest string, salts long, bytes long, task int, number long")


def assign_shards(docs: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For every row: ``key``, ``size``, ``text_crc32``, ``group`` (the text's digest), ``shard``, ``slot``.

    ``size`` is the text's UTF-8 bytes plus 8; null counts as an empty text.  Rows with equal
    texts go to one shard, and the shards' bytes differ as little as differencing manages; a
    group larger than an even shard has a shard nearly to itself.  ``slot`` numbers the rows of
    a shard from 0 without gaps.  Repeated rows and null keys are placed like any other.  An
    empty table gives an empty result.  Other columns are not read.
    """
    if shards < 1:
        raise ValueError("shards must be a positive integer")
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{key}`").alias("key"),
        (F.octet_length(content) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
        F.sha2(content, 256).alias("digest"),
        salt_of(F.col(f"`{key}`")).alias("salt"),
    )
    rows = stage(rows, "sharded-rows")
    groups = stage(
        rows.groupBy("digest").agg(F.sum("size").alias("bytes"), salt_mask(F.col("salt")).alias("salts")), "groups"
    )
    total = groups.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    bundled = stage(_bundles(groups, max(1, total // (shards * FINENESS))), "bundles")
    items = bundled.groupBy("task", "number").agg(F.sum("bytes").alias("bytes"), F.min("digest").alias("name"))

    def run(frames):
        # All bundles; there are about 2 * shards * FINENESS of them, and one more for each task.
        import pandas as pd

        frame = pd.concat([*frames, pd.DataFrame({"task": [], "number": [], "bytes": [], "name": []})])
        frame = frame.sort_values(["bytes", "name"], ascending=[False, True])
        frame["shard"] = difference([int(b) for b in frame["bytes"]], shards)
        yield frame[["task", "number", "shard"]]

    placed = stage(items.coalesce(1).mapInPandas(run, "task int, number long, shard int"), "placed")
    answers = bundled.join(placed, ["task", "number"]).select("digest", "salts", "shard")
    found = join_back(rows, answers, "digest", "salt", "salts")
    return _with_slots(found.select("key", "size", "text_crc32", F.col("digest").alias("group"), "shard"))


def _with_slots(rows: DataFrame) -> DataFrame:
    """``rows`` with ``slot``: each task counts its rows by shard, and starts where those before it end."""
    columns = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            place = np.zeros(len(shard), dtype=np.int64)
            for s in np.unique(shard).tolist():
                own = shard == s
                n = int(own.sum())
                place[own] = seen.get(s, 0) + np.arange(n)
                seen[s] = seen.get(s, 0) + n
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*columns, "task", "place"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.withColumn("task", F.spark_partition_id())
    placed = stage(dealt.mapInArrow(run, f"{schema}, task int, place long"), "placed-rows")
    counts = placed.groupBy("shard", "task").agg(F.count("*").alias("n"))
    # One row for each task and shard.
    before = Window.partitionBy("shard").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return (
        placed.join(starts, ["shard", "task"])
        .withColumn("slot", F.col("start") + F.col("place"))
        .select(*columns, "slot")
    )
