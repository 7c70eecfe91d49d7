"""Raw responses as a table, and the ways to fill it."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.functions.nested import is_json

LANDED_SCHEMA = (
    "source string, request_key string, page_no long, fetched_at timestamp, status int, body string"
)
LANDED_COLUMNS = ["source", "request_key", "page_no", "fetched_at", "status", "body"]

# Answers worth another try, 0 being none at all.
RETRIED = (0, 429, 500, 502, 503, 504)
TRIES = 3
WAIT_SECONDS = 0.5
# Answers that are passed on together: at most so many, and no more once their bodies have so many characters.
FRAME_ROWS, FRAME_CHARS = 1000, 4 << 20

# get(request) -> (status, body)
Get = Callable[[dict[str, Any]], tuple[int, str]]
# follow(request, status, body) -> the next request of the chain, or None at its end
Follow = Callable[[dict[str, Any], int, str], dict[str, Any] | None]


def fetch(requests: DataFrame, source: str, get: Get, max_in_flight: int | None = None) -> DataFrame:
    """Fetch independent requests in parallel, one landed row each.

    ``requests`` has ``request_key``, ``page_no`` and whatever else ``get`` needs.  At most
    ``max_in_flight`` requests run at once; without a limit the cluster sets the pace.
    """
    return _fetch(requests, source, get, lambda request, status, body: None, max_in_flight)


def fetch_chain(
    requests: DataFrame, source: str, get: Get, follow: Follow, max_in_flight: int | None = None
) -> DataFrame:
    """Fetch page after page from each starting request until ``follow`` returns None.

    A chain is sequential by nature; parallelism comes from many chains, one per shard,
    date window or key range.  Pages are passed on in frames of bounded size, never a whole chain.
    """
    return _fetch(requests, source, get, follow, max_in_flight)


def append(landed: DataFrame, path: str) -> None:
    """Add responses to the landed table at ``path``, in folders by source and day."""
    dated = landed.withColumn("fetch_date", F.to_date("fetched_at"))
    dated.write.mode("append").partitionBy("source", "fetch_date").parquet(path)


def read_landed(spark: SparkSession, path: str, source: str | None = None, since: str | None = None) -> DataFrame:
    """Responses from the landed table; other sources and earlier days are not read at all."""
    stored = spark.read.schema(f"{LANDED_SCHEMA}, fetch_date date").parquet(path)
    if source is not None:
        stored = stored.where(F.col("source") == source)
    if since is not None:
        stored = stored.where(F.col("fetch_date") >= F.lit(since).cast("date"))
    return stored.select(*LANDED_COLUMNS)


def in_flight(df: DataFrame, limit: int | None) -> int:
    """The number of partitions that keeps within the limit."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if limit is None else limit


def _fetch(requests: DataFrame, source: str, get: Get, follow: Follow, max_in_flight: int | None) -> DataFrame:
    def answers(frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for frame in frames:
            for start in frame.to_dict("records"):
                request, page_no = start, int(start.get("page_no") or 0)
                while request is not None:
                    status, body = _patiently(get, request)
                    yield source, start["request_key"], page_no, datetime.now(timezone.utc), status, body
                    request = follow(request, status, body)
                    page_no += 1

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _framed(answers(frames))

    return requests.repartition(in_flight(requests, max_in_flight)).mapInPandas(run, LANDED_SCHEMA)


def _framed(answers: Iterator[tuple], rows: int = FRAME_ROWS, chars: int = FRAME_CHARS) -> Iterator[pd.DataFrame]:
    """Landed rows in frames of bounded size; a frame for each answer would cost more than many answers do."""
    held, size = [], 0
    for answer in answers:
        held.append(answer)
        size += len(answer[-1] or "")
        if len(held) >= rows or size >= chars:
            yield pd.DataFrame(held, columns=LANDED_COLUMNS)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=LANDED_COLUMNS)


def _patiently(get: Get, request: dict[str, Any]) -> tuple[int, str | None]:
    """The answer after up to three tries; a call that fails for good is an answer with status 0."""
    for attempt in range(TRIES):
        try:
            status, body = get(request)
        except Exception as error:  # a failed call is a row, not a failed job
            status, body = 0, f"{type(error).__name__}: {error}"
        if status not in RETRIED or attempt == TRIES - 1:
            break
        time.sleep(WAIT_SECONDS * 2**attempt)
    return status, body


def bodies(landed: DataFrame, on_error: str = "fail") -> DataFrame:
    """Landed rows with a usable body.

    A response that failed raises, or with ``on_error="skip"`` is left out; ``failures``
    lists what was left out.
    """
    if on_error == "skip":
        return landed.where(_answered() & is_json(F.col("body")))
    if on_error != "fail":
        raise ValueError("on_error must be one of: fail, skip")
    problem = F.concat(
        F.lit("request "),
        F.coalesce("request_key", F.lit("?")),
        F.lit(" failed with status "),
        F.coalesce(F.col("status").cast("string"), F.lit("unknown")),
    )
    checked = F.when(_answered(), F.col("body")).otherwise(F.raise_error(problem).cast("string"))
    return landed.withColumn("body", checked)


def failures(landed: DataFrame) -> DataFrame:
    """Responses that ``bodies(..., on_error="skip")`` leaves out."""
    return landed.where(~(_answered() & is_json(F.col("body"))))


def _answered() -> Column:
    return F.coalesce(F.col("status").between(200, 299) & F.col("body").isNotNull(), F.lit(False))


def parsed(landed: DataFrame, ddl: str, on_error: str = "fail") -> DataFrame:
    """Parse the body by ``ddl`` into column ``doc``; a malformed body follows ``on_error`` too."""
    mode = "FAILFAST" if on_error == "fail" else "PERMISSIVE"
    return bodies(landed, on_error).withColumn("doc", F.from_json("body", ddl, {"mode": mode}))
