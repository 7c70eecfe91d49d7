"""What became of the requests: accounting, retries and pacing, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The statuses worth another try, and how often.
RETRY_STATUSES = (429, 500, 502, 503, 504)
NO_ANSWER = 0
MAX_RETRIES = 3
BACKOFF_FACTOR = 2
SECONDS_PER_DAY = 86_400

# A part of a request has a key of its own, that of its request, and the positions of its records;
# ``positions`` is null for a whole request, ``refused`` unless the answer tells which records.
OUTCOME_SCHEMA = (
    "idem_key string, batch_id string, attempt int, status int, n_accepted int, finished_at timestamp, error string, "
    "request_key string, positions array<int>, refused array<int>"
)


def succeeded(status: Column) -> Column:
    return status.between(200, 299)


def latest_outcome(outcomes: DataFrame) -> DataFrame:
    """The last attempt of each request."""
    others = [c for c in outcomes.columns if c != "idem_key"]
    return (
        outcomes.groupBy("idem_key")
        .agg(F.max_by(F.struct(*others), F.struct("attempt", "finished_at")).alias("o"))
        .select("idem_key", "o.*")
    )


def worth_another_try(status: Column, attempt: Column, max_attempts: int = MAX_RETRIES) -> Column:
    return status.isin(*RETRY_STATUSES, NO_ANSWER) & (attempt < max_attempts)


def delivery_stats(outbox: DataFrame, outcomes: DataFrame, *by: str) -> DataFrame:
    """Records processed, succeeded, failed and still pending, per group of requests.

    A request that was split has succeeded with as many records as its parts.
    """
    latest = latest_outcome(outcomes)
    told = F.coalesce("n_accepted", F.when(F.col("positions").isNotNull(), F.size("positions")))
    # Keys are unique on both sides, so an ordinary join is even.
    by_request = latest.groupBy(F.coalesce("request_key", "idem_key").alias("idem_key")).agg(
        F.sum(F.when(succeeded(F.col("status")), told)).alias("_told"),
        F.max(succeeded(F.col("status")) & told.isNull()).alias("_whole"),
    )
    accepted = F.when(F.col("_whole"), F.col("n_records")).otherwise(F.coalesce("_told", F.lit(0)))
    answered = F.col("_whole").isNotNull()
    return (
        outbox.join(by_request, "idem_key", "left")
        .withColumn("_ok", accepted)
        .groupBy(*by)
        .agg(
            F.sum("n_records").alias("processed"),
            F.sum("_ok").alias("succeeded"),
            F.sum(F.when(answered, F.col("n_records") - F.col("_ok")).otherwise(0)).alias("failed"),
            F.sum(F.when(answered, 0).otherwise(F.col("n_records"))).alias("pending"),
        )
    )


def record_outcomes(outbox: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per record: ``idem_key`` of its request, ``position``, and what became of it.

    ``verdict`` is ``accepted``, ``refused`` (by an answer that another try would not change),
    ``failed`` (worth another try, whether any is left or not) or ``pending``.  Where an answer tells only how many records it took, the
    first so many count as accepted.
    """
    requests = outbox.select("idem_key", "n_records")
    latest = latest_outcome(outcomes).withColumn("request_key", F.coalesce("request_key", "idem_key"))
    joined = requests.join(latest.drop("idem_key").withColumnRenamed("request_key", "idem_key"), "idem_key", "left")
    held = F.coalesce("positions", F.sequence(F.lit(0), F.col("n_records") - 1))
    ok = succeeded(F.col("status"))
    lost = F.coalesce("refused", F.slice(held, F.coalesce("n_accepted", F.size(held)) + 1, F.size(held)))
    said = (
        F.when(F.col("status").isNull(), "pending")
        .when(ok, F.when(F.array_contains("_lost", F.col("position")), "refused").otherwise("accepted"))
        .when(F.col("status").isin(*RETRY_STATUSES, NO_ANSWER), "failed")
        .otherwise("refused")
    )
    each = joined.withColumn("_lost", F.when(ok, lost)).withColumn("position", F.explode(held))
    each = each.withColumn("verdict", said)
    # A record sent in several parts counts as in the smallest of them, which came last.
    return each.groupBy("idem_key", "position").agg(
        F.min_by(F.struct("verdict", "status", "error"), F.struct(F.size(held), "verdict")).alias("o")
    ).select("idem_key", "position", "o.*")


def retry_plan(
    outbox: DataFrame,
    outcomes: DataFrame,
    base_seconds: float = 1.0,
    max_attempts: int = MAX_RETRIES,
    statuses: tuple[int, ...] = (*RETRY_STATUSES, NO_ANSWER),
) -> DataFrame:
    """The requests to send again, and not before when: the wait doubles with every attempt."""
    latest = latest_outcome(outcomes).select("idem_key", "attempt", "status", "finished_at")
    retryable = F.col("status").isin(list(statuses)) & (F.col("attempt") < max_attempts)
    again = latest.where(retryable)
    due = due_after(F.col("finished_at"), F.col("attempt"), base_seconds)
    return (
        outbox.join(again, "idem_key")
        .withColumn("next_attempt", F.col("attempt") + 1)
        .withColumn("next_at", due)
        .drop("attempt", "finished_at")
    )


def due_after(finished_at: Column, attempt: Column, base_seconds: float) -> Column:
    """When an attempt that failed may be repeated."""
    wait = F.lit(float(base_seconds)) * F.pow(F.lit(float(BACKOFF_FACTOR)), attempt)
    return F.timestamp_micros(F.unix_micros(finished_at.cast("timestamp")) + (wait * 1_000_000).cast("long"))


def retry_singletons(batched: DataFrame, outcomes: DataFrame, record_key: Column) -> DataFrame:
    """Records of failed batches, one request each, under a key that stays the same on every retry."""
    failed = latest_outcome(outcomes).where(~succeeded(F.col("status"))).select("batch_id")
    return (
        batched.join(failed, "batch_id", "left_semi")
        .withColumn("n_records", F.lit(1))
        .withColumn("idem_key", F.sha2(record_key.cast("string"), 256))
    )


def dispatch_schedule(indexed: DataFrame, gap_seconds: int, daily_quota: int) -> DataFrame:
    """Day and second of day for each request, ``gap_seconds`` apart; the excess rolls to later days.

    ``indexed`` carries the dense number ``idx`` of each request.
    """
    if gap_seconds <= 0 or daily_quota <= 0:
        raise ValueError("gap and quota must be a positive integer")
    per_day = min(daily_quota, -(-SECONDS_PER_DAY // gap_seconds))
    return indexed.withColumn("day_no", F.expr(f"idx div {per_day}")).withColumn(
        "second_of_day", (F.col("idx") % per_day) * gap_seconds
    )
