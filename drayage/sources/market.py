"""Quotes and price series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.functions.convert import safe_double
from drayage.landed import bodies, parsed

QUOTES_DDL = (
    "results ARRAY<STRUCT<price: STRING, bid_inclusive_of_sell_spread: STRING, "
    "ask_inclusive_of_buy_spread: STRING, timestamp: STRING>>"
)

# The field names of a price bar, and the series a symbol offers.
BAR_DDL = (
    "MAP<STRING, STRUCT<`1. open`: STRING, `2. high`: STRING, `3. low`: STRING, "
    "`4. close`: STRING, `5. volume`: STRING>>"
)
SERIES = ("TIME_SERIES_DAILY", "TIME_SERIES_WEEKLY", "TIME_SERIES_MONTHLY")
META_KEY = "Meta Data"


def quotes(landed: DataFrame, on_error: str = "skip") -> DataFrame:
    """Best bid and ask per trading pair; a pair whose request failed has no rows."""
    quote = parsed(landed, QUOTES_DDL, on_error).select("request_key", F.explode("doc.results").alias("q"))
    return quote.select(
        F.col("request_key").alias("symbol"),
        safe_double(F.col("q.price"), 0.0).alias("price"),
        safe_double(F.col("q.bid_inclusive_of_sell_spread"), 0.0).alias("bid_price"),
        safe_double(F.col("q.ask_inclusive_of_buy_spread"), 0.0).alias("ask_price"),
        F.coalesce("q.timestamp", F.lit("")).alias("updated_at"),
    )


def unanswered(symbols: DataFrame, landed: DataFrame) -> DataFrame:
    """Symbols asked for that have no usable response."""
    answered = bodies(landed, "skip").select(F.col("request_key").alias("symbol")).distinct()
    return symbols.select("symbol").join(answered, "symbol", "left_anti")


def price_bars(landed: DataFrame, on_error: str = "fail") -> DataFrame:
    """One row per symbol and date of the series that stands beside the metadata."""
    top = F.map_entries("doc")
    series = F.get(F.filter(top, lambda e: e["key"] != META_KEY), F.lit(0))["value"]
    bars = (
        parsed(landed, "MAP<STRING, STRING>", on_error)
        .select("request_key", F.from_json(series, BAR_DDL, {"mode": "FAILFAST"}).alias("bars"))
        .select("request_key", F.explode("bars").alias("date", "bar"))
    )
    return bars.select(
        "date",
        _number("1. open").alias("open"),
        _number("2. high").alias("high"),
        _number("3. low").alias("low"),
        _number("4. close").alias("close"),
        _number("5. volume").cast("long").alias("volume"),
        F.col("request_key").alias("symbol"),
    )


def _number(name: str) -> Column:
    return F.col("bar").getField(name).cast("double")


def rollup_bars(bars: DataFrame, unit: str) -> DataFrame:
    """Weekly or monthly bars from daily ones, dated by the last day seen in the period."""
    if unit not in ("week", "month"):
        raise ValueError("unit must be one of: week, month")
    return (
        bars.groupBy("symbol", F.date_trunc(unit, F.col("date").cast("timestamp")).alias("_period"))
        .agg(
            F.max("date").alias("date"),
            F.min_by("open", "date").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "date").alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select("date", "open", "high", "low", "close", "volume", "symbol")
    )
