"""Sending an outbox with a caller-supplied function, at bounded concurrency."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.landed import in_flight
from drayage.operators.outcomes import (
    NO_ANSWER,
    OUTCOME_SCHEMA,
    due_after,
    latest_outcome,
    succeeded,
    worth_another_try,
)
from drayage.operators.pacing import Pace, lease, seconds_of
from drayage.outbox import part_body
from drayage.scratch import path_exists, stage

# send(request) -> {"status": int, "n_accepted": int | None, "refused": list[int] | None, "error": str | None}
Send = Callable[[dict[str, Any]], dict[str, Any]]

BASE_SECONDS = 1.0  # the wait before another try, doubled with every attempt
IDLE_ROUNDS = 5  # rounds in a row without any answer after which ``settle`` gives up


def _cut(body: pd.Series, head: pd.Series, sizes: pd.Series, picks: pd.Series) -> pd.Series:
    """The request with only the picked ones of its records."""
    rows = zip(body, head, sizes, picks)
    return pd.Series([part_body(b, int(h), [int(s) for s in of], [int(p) for p in wanted]) for b, h, of, wanted in rows])


def _parts_of(held: DataFrame, wanted: str, picks: Column) -> DataFrame:
    """Rows with the body, sizes and number of the records at ``picks``, which are ``wanted`` in the request."""
    cut = held.withColumn("_picks", picks)
    return cut.withColumns(
        {
            "body": F.pandas_udf(_cut, "string")("body", "head", "sizes", "_picks"),
            "sizes": F.transform("_picks", lambda n: F.get("sizes", n)),
            "n_records": F.size("_picks"),
            "positions": F.col(wanted),
        }
    ).drop("_picks")


def attempt_all(work: DataFrame, send: Send, max_in_flight: int | None) -> DataFrame:
    """One outcome row per request, at most ``max_in_flight`` at once; else the cluster sets the pace.

    A row with ``positions`` is a part: its body holds the records that lie there in its request.
    A request with a time in ``send_at`` is held back until then; if its task comes later than
    ``send_until``, the slot has lapsed and nothing is sent.  The frame is lazy and every
    evaluation sends again: write it once, as ``deliver`` does.
    """
    if "attempt" not in work.columns:
        work = work.withColumn("attempt", F.lit(1))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for request in frame.to_dict("records"):
                if not _slot_reached(request.get("send_at"), request.get("send_until")):
                    continue
                positions = request.get("positions")
                positions = None if positions is None else [int(p) for p in positions]
                try:
                    answer = send(request)
                except Exception as error:  # a failed call is an outcome, not a failed job
                    answer = {"status": None, "error": f"{type(error).__name__}: {error}"}
                refused, taken = answer.get("refused"), answer.get("n_accepted")
                if refused is not None:
                    size = int(request["n_records"])
                    refused = sorted({int(n) for n in refused if 0 <= n < size})
                    taken = size - len(refused)
                    refused = [n if positions is None else positions[n] for n in refused]
                rows.append(
                    (
                        request["idem_key"],
                        request["batch_id"],
                        int(request["attempt"]),
                        answer.get("status") or NO_ANSWER,
                        taken,
                        datetime.now(timezone.utc),
                        answer.get("error"),
                        request.get("request_key") or request["idem_key"],
                        positions,
                        refused,
                    )
                )
            out = pd.DataFrame(rows, columns=[f.split()[0] for f in OUTCOME_SCHEMA.split(", ")])
            out["n_accepted"] = out["n_accepted"].astype("Int32")
            out["finished_at"] = pd.to_datetime(out["finished_at"], utc=True)
            yield out

    if "lane" in work.columns:
        lanes = in_flight(work, max_in_flight)
        spread = work.repartitionById(lanes, F.col("lane") % lanes).sortWithinPartitions("send_at")
    else:
        # Row by row, so that copies of one request do not gather in one task.
        spread = work.repartition(in_flight(work, max_in_flight))
    return spread.mapInPandas(run, OUTCOME_SCHEMA)


def _slot_reached(send_at: float | None, send_until: float | None) -> bool:
    """Wait for the time of a slot, in seconds since 1970; whether it can still be used."""
    if send_at is None or pd.isna(send_at):
        return True
    left = send_at - time.time()
    if left > 0:
        time.sleep(left)
    return send_until is None or pd.isna(send_until) or time.time() <= send_until


class DeliveryFailed(RuntimeError):
    """Some requests were not accepted; the outcomes table says which and why."""


def open_work(
    outbox: DataFrame, outcomes: DataFrame | None, base_seconds: float = BASE_SECONDS, split: bool = True
) -> DataFrame:
    """What is still to be sent, and not before when.

    Adds ``request_key``, ``positions`` (null for a whole request), ``attempt`` and ``due``.  Requests
    without an outcome are open; of the others what ``following`` says.
    """
    fresh = outbox.withColumns(
        {
            "request_key": F.col("idem_key"),
            "positions": F.lit(None).cast("array<int>"),
            "attempt": F.lit(1),
            "due": F.lit(None).cast("timestamp"),
        }
    )
    if outcomes is None:
        return fresh
    latest = stage(latest_outcome(outcomes), "latest-outcomes")
    keys = latest.select("idem_key")
    again = following(outbox, latest, base_seconds, split)
    # A part that was sent already has an outcome of its own.
    known = keys.withColumn("_known", F.lit(True))
    again = again.join(known, "idem_key", "left").where(F.col("_known").isNull() | (F.col("attempt") > 1)).drop("_known")
    return fresh.join(keys, "idem_key", "left_anti").unionByName(again)


def following(outbox: DataFrame, latest: DataFrame, base_seconds: float, split: bool = True) -> DataFrame:
    """What the latest outcomes leave to be sent.

    A request without a usable answer is sent again while attempts are left.  One that was refused is
    halved, and so are the records that a partly accepted one did not take, until each refused
    record has been sent alone and has an outcome of its own; records that were taken are never sent
    again.  Requests that cannot be split are refused as a whole.
    """
    roots = outbox.withColumnRenamed("idem_key", "request_key")
    held = latest.select(
        F.coalesce("request_key", "idem_key").alias("request_key"),
        *["idem_key", "positions", "attempt", "status", "refused", "finished_at"],
    )
    held = held.where(_leaves_something()).join(roots, "request_key")
    if "sizes" in outbox.columns:
        parts = held.where("positions IS NOT NULL").withColumn("_wanted", F.col("positions"))
        parts = _parts_of(parts, "_wanted", F.col("positions")).drop("_wanted")
        held = held.where("positions IS NULL").unionByName(parts)
    return _left_open(held, outbox.columns, base_seconds, split)


def _leaves_something() -> Column:
    """False for outcomes that took all; nothing follows from those."""
    return ~(succeeded(F.col("status")) & (F.coalesce(F.size("refused"), F.lit(0)) <= 0))


def _left_open(held: DataFrame, columns: list[str], base_seconds: float, split: bool = True) -> DataFrame:
    """What outcomes leave to be sent, from requests and parts (``held``) that have the body they were sent with.

    A part has only its own records, so all parts of a request that are halved down to one record
    hold each of its records once on every level, however many there are.
    """
    status, attempt = F.col("status"), F.col("attempt")
    unanswered = worth_another_try(status, attempt)
    again = held.where(unanswered).withColumn("due", due_after(F.col("finished_at"), attempt, base_seconds))
    again = again.withColumn("attempt", attempt + 1)
    wanted = [*columns, "request_key", "positions", "attempt", "due"]
    if not split or "sizes" not in columns:
        return again.select(*wanted)
    here = F.coalesce("positions", F.sequence(F.lit(0), F.col("n_records") - 1))
    # An answer of another kind than "try again" is about the records themselves.
    final = ~worth_another_try(status, F.lit(0))
    lost = F.when(succeeded(status), F.coalesce("refused", F.array().cast("array<int>"))).when(final, here)
    middle = F.ceil(F.size("_lost") / 2).cast("int")
    halves = F.array(F.slice("_lost", 1, middle), F.slice("_lost", middle + 1, F.size("_lost")))
    parts = (
        F.when(F.size("_here") <= 1, F.array().cast("array<array<int>>"))
        .when(F.size("_lost") > 1, halves)
        .when(F.size("_lost") == 1, F.array("_lost"))
        .otherwise(F.array().cast("array<array<int>>"))
    )
    parted = (
        held.where(F.col("sizes").isNotNull())
        .withColumns({"_here": here, "_lost": lost})
        .withColumn("_wanted", F.explode(parts))
        .withColumn("idem_key", F.sha2(F.concat_ws(":", "request_key", F.array_join("_wanted", ",")), 256))
        .withColumns({"attempt": F.lit(1), "due": F.lit(None).cast("timestamp")})
    )
    at = F.transform("_wanted", lambda p: (F.array_position("_here", p) - 1).cast("int"))
    return again.select(*wanted).unionByName(_parts_of(parted, "_wanted", at).select(*wanted))


def deliver(
    outbox: DataFrame,
    send: Send,
    outcomes_path: str,
    max_in_flight: int | None = None,
    waves: int = 1,
    fail_fast: bool = False,
    base_seconds: float = BASE_SECONDS,
    split: bool = False,
) -> DataFrame:
    """Send what is open once, append the outcomes to a table and return that table.

    Requests accepted earlier are skipped by ``idem_key``, so a run that died half-way can be
    repeated; so are those refused for good, and those that have used up their attempts.  What is
    worth another try waits until it is due.  A task lost between the call and its commit may send
    once more; receivers tell such copies by the same key.  Outcomes are committed after each of the
    ``waves``, equal parts of the outbox, so a failed job forgets no more than one of them.

    With ``split``, requests refused earlier are sent again in halves, and of those taken in part the
    records that were not taken; ``settle`` goes on with that to the end.

    With ``fail_fast`` a wave with failures ends the run in ``DeliveryFailed``; its outcomes
    are kept.
    """
    spark = outbox.sparkSession
    work = open_work(outbox, read_outcomes(spark, outcomes_path), base_seconds, split)
    work = work.withColumn("send_at", seconds_of(F.col("due")))
    if waves > 1 or fail_fast:
        work = stage(work, "outbox")
    for number in range(waves):
        wave = work if waves == 1 else work.where(F.pmod(F.xxhash64("idem_key"), F.lit(waves)) == number)
        attempt_all(wave, send, max_in_flight).write.parquet(_new_run(outcomes_path))
        if fail_fast:
            _raise_on_failure(spark, outcomes_path, wave)
    return read_outcomes(spark, outcomes_path)


def settle(
    outbox: DataFrame,
    send: Send,
    outcomes_path: str,
    max_in_flight: int | None = None,
    base_seconds: float = BASE_SECONDS,
    pace: Pace | None = None,
) -> DataFrame:
    """Send until nothing is open, and return the outcomes table.

    Round by round, what a round leaves open is the next one's work: another try of what had no usable
    answer, halves of what was refused.  Only the outcomes of the last round are read for it.
    Every round commits its outcomes, so a run that is repeated after a crash takes up at the last
    committed round.  With a ``pace``, a round is a lease of slots (see ``pacing``); what lapses stays open.
    """
    spark = outbox.sparkSession
    work = stage(open_work(outbox, read_outcomes(spark, outcomes_path), base_seconds), "open-work")
    idle = 0
    while not work.isEmpty():
        if pace is None:
            now = work.withColumn("send_at", seconds_of(F.col("due")))
        else:
            # A round in which every slot lapsed leaves its tasks twice the time.
            lead = pace.lead_seconds * 2**idle
            now = lease(work, read_outcomes(spark, outcomes_path), pace, max_in_flight, lead)
        path = _new_run(outcomes_path)
        attempt_all(now, send, max_in_flight).write.parquet(path)
        answered = spark.read.schema(OUTCOME_SCHEMA).parquet(path)
        idle = idle + 1 if answered.isEmpty() else 0
        if idle == IDLE_ROUNDS:
            raise DeliveryFailed(f"nothing was sent in {IDLE_ROUNDS} rounds; the pace leaves its tasks too little time")
        # What was sent has all that is needed; requests that are done are not read again.
        told = answered.where(_leaves_something()).select("idem_key", "status", "refused", "finished_at")
        left = _left_open(work.drop("due").join(told, "idem_key"), outbox.columns, base_seconds)
        if pace is not None:
            left = left.unionByName(work.join(answered.select("idem_key"), "idem_key", "left_anti"))
        work = stage(left, "open-work")
    found = read_outcomes(spark, outcomes_path)
    return spark.createDataFrame([], OUTCOME_SCHEMA) if found is None else found


def _new_run(outcomes_path: str) -> str:
    """A folder for the outcomes of one job."""
    return f"{outcomes_path}/run-{uuid.uuid4().hex}"


def _raise_on_failure(spark: SparkSession, outcomes_path: str, sent: DataFrame) -> None:
    # The table may hold outcomes of other outboxes too.
    own = read_outcomes(spark, outcomes_path).join(sent.select("idem_key"), "idem_key", "left_semi")
    failed = latest_outcome(own).where(~succeeded(F.col("status")))
    count, example = failed.agg(F.count("*"), F.any_value("error")).first()
    if count:
        raise DeliveryFailed(f"{count} requests failed, for instance with: {example}")


def read_outcomes(spark: SparkSession, path: str) -> DataFrame | None:
    """All outcomes under ``path``, whatever job or micro-batch wrote them."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema(OUTCOME_SCHEMA).option("recursiveFileLookup", "true").parquet(path)
