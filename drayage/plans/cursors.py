"""Reading a listing by many cursors: ranges of whole-number ids, cut again where one holds too much.

Such a listing starts anywhere: a cursor is the smallest id of the page it stands for.  The first chain
of pages starts at the beginning and ends after a bounded number of pages.  If there is more, what is left
is cut into ranges, the first as wide as the ids just read, each further one twice as wide, and all of them
are read side by side; a range that has not ended after as many pages is cut in the same way.  So a short
listing is one chain as ever, and of a long one the number of rounds grows with the logarithm of its
ids, however unevenly they lie.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.landed import LANDED_SCHEMA, Get, fetch_chain
from drayage.scratch import new_path, stage

PAGES_PER_CHAIN = 16
HIGHEST = 1 << 64  # ids are below; what sorts after all whole numbers belongs to the last range

# next_of(status, body) -> the cursor of the next page, or None
NextOf = Callable[[int, str], Any]


def range_key(listing: str, low: int, high: int) -> str:
    return f"{listing}@{low}-{high}"


def in_range(request_key: Column, identifier: Column) -> Column:
    """Whether a row of a page belongs to the range its chain was for: the last page may reach beyond it."""
    high = F.regexp_extract(request_key, "@[0-9]+-([0-9]+)$", 1).try_cast("decimal(20,0)")
    number = identifier.cast("string").try_cast("decimal(20,0)")
    return high.isNull() | (high >= F.lit(str(HIGHEST)).cast("decimal(20,0)")) | F.coalesce(number < high, F.lit(False))


def _is_number(cursor: Any) -> bool:
    return isinstance(cursor, int) and not isinstance(cursor, bool)


def fetch_split(
    spark: SparkSession,
    listing: str,
    url: str,
    body_of: Callable[[Any], str],
    next_of: NextOf,
    source: str,
    get: Get,
    max_in_flight: int | None = None,
    pages: int = PAGES_PER_CHAIN,
) -> DataFrame:
    """All pages of a listing, as staged landed rows; ``request_key`` names the range of each chain.

    ``body_of(cursor)`` is the body of a request, with None for the beginning.  ``in_range`` drops the rows of
    a last page that lie beyond its range.  A page that failed ends its range, as it ends a chain.
    Cursors that are no whole numbers, after all that are, are followed to the end in one chain.
    """
    highest = HIGHEST

    def follow(request: dict[str, Any], status: int, body: str) -> dict[str, Any] | None:
        cursor = next_of(status, body)
        high, left = int(request["high"]), int(request["left"]) - 1
        if cursor is None or (_is_number(cursor) and (cursor >= high or left <= 0)):
            return None
        if not _is_number(cursor) and high < highest:
            return None
        return {**request, "body": body_of(cursor), "left": left}

    def remaining(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The ranges that are left of chains whose last page names a cursor within the range."""
        for frame in frames:
            rows = []
            for key, status, body in zip(frame["request_key"], frame["status"], frame["body"]):
                low, high = map(int, key.rsplit("@", 1)[1].split("-"))
                cursor = next_of(int(status), body)
                if cursor is None or not _is_number(cursor) or cursor >= high:
                    continue
                start, width = cursor, max(1, cursor - low)
                while start < high:
                    end = min(high, start + width)
                    rows.append((range_key(listing, start, end), 0, url, body_of(start), str(end), pages))
                    start, width = end, 2 * width
            yield pd.DataFrame(rows, columns=["request_key", "page_no", "url", "body", "high", "left"])

    shape = "request_key string, page_no long, url string, body string, high string, left int"
    first = (range_key(listing, 0, HIGHEST), 0, url, body_of(None), str(HIGHEST), pages)
    requests, paths = spark.createDataFrame([first], shape), []
    while True:
        path = new_path(spark, f"landed-{source}")
        fetch_chain(requests, source, get, follow, max_in_flight).write.parquet(path)
        paths.append(path)
        landed = spark.read.schema(LANDED_SCHEMA).parquet(path)
        last = landed.groupBy("request_key").agg(F.max_by(F.struct("status", "body"), "page_no").alias("page"))
        left = last.select("request_key", "page.status", F.coalesce("page.body", F.lit("")).alias("body"))
        requests = stage(left.mapInPandas(remaining, shape), f"requests-{source}")
        if requests.isEmpty():
            return spark.read.schema(LANDED_SCHEMA).parquet(*paths)


def next_page_offset(status: int, body: str) -> Any:
    """The cursor in a page of points."""
    if status != 200:
        return None
    return (json.loads(body).get("result") or {}).get("next_page_offset")
