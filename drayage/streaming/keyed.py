"""Streams that remember one value for each key."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPARKS_OWN = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"

BUCKETS = 1024  # fixed, as it is part of the state in a checkpoint
# Columns of their own; in frames for state, names must not begin with an underscore.
KEY, BUCKET = "keyed__key", "keyed__bucket"


class Newest(StatefulProcessor):
    """Rows of a key later than all its rows so far; of rows with one time, that of the latest poll.

    It is called for a bucket of keys, named by ``KEY`` as text.  Its state is one text: the last time of each key
    of the bucket, and when the key was last heard of.
    """

    def __init__(self, time: str, polled: str, columns: list[str], first: str, forget_after: int | None):
        self._time, self._polled, self._columns = time, polled, columns
        self._first, self._forget_after = first, forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        keep_ms = None if self._forget_after is None else 1000 * self._forget_after
        self._last = handle.getValueState("last_times", "last_times string", keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = self._last.get()
        last = {} if state is None else json.loads(state[0])
        now = 0
        if self._forget_after is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            last = {k: v for k, v in last.items() if now - v[1] < 1000 * self._forget_after}
        # Equal polls are told apart by the rest of the row, so that any order of rows gives the same.
        order = [KEY, self._time, self._polled, *[c for c in self._columns if c != self._time]]
        fresh, heard = None, set()
        for frame in rows:
            heard.update(frame[KEY])
            start = frame[KEY].map(lambda k: last[k][0] if k in last else self._first)
            frame = frame[frame[self._time] > start]
            both = frame if fresh is None else pd.concat([fresh, frame], ignore_index=True)
            both = both.sort_values(order, na_position="first", kind="stable")
            fresh = both.drop_duplicates([KEY, self._time], keep="last")
        moved = {} if fresh is None else dict(zip(fresh[KEY], fresh[self._time]))  # sorted, so the latest stays
        # Those heard of are not to be forgotten yet, though nothing of theirs is new.
        touched = moved if self._forget_after is None else {**{k: last[k][0] for k in heard if k in last}, **moved}
        if touched:
            last.update({k: [str(time), now] for k, time in touched.items()})
            self._last.update((json.dumps(last, separators=(",", ":")),))
        if moved:
            yield fresh[self._columns]

    def close(self) -> None:
        pass


def newest_stream(
    rows: DataFrame, key: str, time: str, polled: str, first: str, forget_after: int | None = None
) -> DataFrame:
    """The rows of a stream whose ``time`` (text that sorts by time) is later than any of their key before.

    Polls overlap: what an earlier micro-batch has passed on is old, and of rows of one micro-batch with the
    same key and time the one with the latest ``polled`` stays.  Rows with a null key or time are dropped;
    a key never heard of starts at ``first``, exclusive.  ``polled`` itself is not passed on.

    State is the last time of each key, kept in Spark's checkpoint and so exact over restarts and replays.
    Every call of the Python state and every frame has its price, so keys share ``BUCKETS`` values of
    state, and a micro-batch pays for buckets and rows, not for keys.  With ``forget_after`` seconds a key that is not heard of for so long is
    forgotten; Spark then runs batches without data to see to that, so such a stream must be stopped,
    it does not end by itself with ``availableNow``.
    """
    use_keyed_state(rows.sparkSession)
    columns = [c for c in rows.columns if c != polled]
    bucket = F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(BUCKETS)).cast("int")
    return (
        rows.dropna(subset=[key, time])
        .withColumns({BUCKET: bucket, KEY: F.col(f"`{key}`").cast("string")})
        .groupBy(BUCKET)
        .transformWithStateInPandas(
            Newest(time, polled, columns, first, forget_after),
            outputStructType=T.StructType([rows.schema[c] for c in columns]),
            outputMode="Append",
            timeMode="None" if forget_after is None else "ProcessingTime",
        )
    )


def use_keyed_state(spark: SparkSession) -> None:
    """Spark keeps values by key in RocksDB only; streams started from now on use it unless the session names a store.

    Streams that were started before go on with the store in their checkpoint.
    """
    if spark.conf.get(STATE_PROVIDER, SPARKS_OWN) == SPARKS_OWN:
        spark.conf.set(STATE_PROVIDER, ROCKSDB)
