"""Access to the given tables, and landed responses built from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that must give the same rows."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def landed(pages: DataFrame, source: str, key: Column | None = None, status: Column | None = None) -> DataFrame:
    """Responses with ``page_no`` and ``body`` in the landed layout."""
    return pages.select(
        F.lit(source).alias("source"),
        (F.lit(source) if key is None else key).cast("string").alias("request_key"),
        F.col("page_no").cast("long").alias("page_no"),
        F.lit("2024-06-01 00:00:00").cast("timestamp").alias("fetched_at"),
        (F.lit(200) if status is None else status).cast("int").alias("status"),
        "body",
    )


def paged(rows: DataFrame, key: str, size: int, item: Column, *by: str, **extra: Column) -> DataFrame:
    """Rows gathered in pages of at most ``size``, by a unique whole-number key.

    ``items`` holds the page's items as JSON text, in key order.
    """
    ordered = F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), item.alias("item"))))
    return (
        rows.groupBy(*by, F.expr(f"{key} div {size}").alias("page_no"))
        .agg(ordered.alias("rows"), *[col.alias(name) for name, col in extra.items()])
        .withColumn("items", F.concat(F.lit("["), F.array_join(F.transform("rows", lambda r: r["item"]), ","), F.lit("]")))
        .drop("rows")
    )


def body(prefix: str, *middle: Column | str) -> Column:
    """Text put together from parts; plain strings are literals."""
    return F.concat(F.lit(prefix), *[F.lit(m) if isinstance(m, str) else m for m in middle])


def obj(*fields: Column) -> Column:
    """A JSON object as text, nulls left out."""
    return F.to_json(F.struct(*fields))


def ntz(col: str | Column) -> Column:
    return (F.col(col) if isinstance(col, str) else col).cast("timestamp_ntz")
