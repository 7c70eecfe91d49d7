"""When to send: due times, a gap between any two sends and a number of sends a day, in one plan.

A plan is made for one lease at a time: so many of the requests that are due first, each with the
slot it is to be sent in.  Slots are a gap and a slack apart, and a slot ends when its slack is
over; a task that comes later sends nothing, and the request stays open for the next lease.
So two sends are never closer than the gap, however slow a task or its receiver is, as far as the
clocks of the executors agree.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drayage.landed import in_flight
from drayage.operators.outcomes import SECONDS_PER_DAY
from drayage.scratch import stage

SLOTS_PER_LANE = 128


@dataclass(frozen=True)
class Pace:
    """At least ``gap_seconds`` between sends, at most ``daily_quota`` of them in a UTC day.

    ``slack_seconds`` is how late a send may be; ``lead_seconds`` is left for tasks to start.
    """

    gap_seconds: float
    daily_quota: int | None = None
    slack_seconds: float = 0.5
    lead_seconds: float = 1.0

    def __post_init__(self) -> None:
        quota = 1 if self.daily_quota is None else self.daily_quota
        if self.gap_seconds <= 0 or self.slack_seconds <= 0 or quota <= 0:
            raise ValueError("gap, slack and quota must be positive")


def lease(
    work: DataFrame,
    outcomes: DataFrame | None,
    pace: Pace,
    max_in_flight: int | None = None,
    lead_seconds: float | None = None,
) -> DataFrame:
    """The requests of ``work`` to be sent next, with ``send_at``, ``send_until`` and ``lane``.

    Requests wait for ``due``; those due first come first.  The first slot is no earlier than now, than
    a gap after the last send, and than midnight if the day's quota is used up; the lease ends
    with that day or with its quota.  Its rows are at most ``SLOTS_PER_LANE`` for each lane, whatever
    the size of ``work``, so ordering them in one task is bounded.
    """
    lanes = in_flight(work, max_in_flight)
    room, earliest, day = lanes * SLOTS_PER_LANE, 0.0, int(time.time() // SECONDS_PER_DAY)
    used = 0
    if outcomes is not None:
        sent = seconds_of(F.col("finished_at"))
        last, used = outcomes.agg(F.max(sent), F.count_if(F.floor(sent / SECONDS_PER_DAY) >= day)).first()
        earliest = (last or 0.0) + pace.gap_seconds
    if pace.daily_quota is not None:
        if used >= pace.daily_quota:
            day, used = day + 1, 0
            earliest = max(earliest, day * SECONDS_PER_DAY)
        room = min(room, pace.daily_quota - used)
    queue = queued(work, room, lanes, pace)
    # The clock is read last: choosing the rows takes a job of its own.
    start = max(earliest, time.time() + (pace.lead_seconds if lead_seconds is None else lead_seconds))
    return slotted(queue, start, (day + 1) * SECONDS_PER_DAY, pace)


def queued(work: DataFrame, room: int, lanes: int, pace: Pace) -> DataFrame:
    """The first ``room`` requests in the order they are due, staged with their place and lane.

    The i-th request may be sent a step after the one before, and not before its own due time: at the
    latest of (due time of j, plus i - j steps) over all j up to i.  ``_from`` is that time without
    the i steps.
    """
    step = F.lit(pace.gap_seconds + pace.slack_seconds)
    first = work.withColumn("_due", F.coalesce(seconds_of(F.col("due")), F.lit(0.0)))
    first = first.orderBy("_due", "idem_key").limit(room)
    at = (F.row_number().over(Window.orderBy("_due", "idem_key")) - 1).alias("_at")
    latest = F.max(F.col("_due") - F.col("_at") * step).over(Window.orderBy("_at"))
    placed = first.select("*", at).withColumns({"_from": latest, "lane": (F.col("_at") % lanes).cast("int")})
    return stage(placed.drop("_due"), "lease")


def slotted(queue: DataFrame, start: float, end: float, pace: Pace) -> DataFrame:
    """The slots of ``queue`` from ``start`` on and before ``end``, in seconds since 1970."""
    slot = F.greatest(F.lit(float(start)), F.col("_from")) + F.col("_at") * (pace.gap_seconds + pace.slack_seconds)
    timed = queue.withColumn("send_at", slot).withColumn("send_until", F.col("send_at") + pace.slack_seconds)
    return timed.where(F.col("send_at") < end).drop("_at", "_from")


def seconds_of(time: Column) -> Column:
    """A timestamp as seconds since 1970."""
    return F.unix_micros(time) / F.lit(1e6)
