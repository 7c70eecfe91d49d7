"""Database tables through Spark's own JDBC source."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Fixed value: rows per insert.
INSERT_BATCH = 1000
SAVE_MODES = ("append", "overwrite", "ignore", "error")


def read_options(
    url: str,
    dbtable: str | None = None,
    query: str | None = None,
    partition_column: str | None = None,
    lower: Any = None,
    upper: Any = None,
    partitions: int | None = None,
    custom_schema: str | None = None,
) -> dict[str, str]:
    if not url:
        raise ValueError("Option 'url' is required.")
    if not dbtable and not query:
        raise ValueError("Either 'dbtable' or 'query' must be provided.")
    if dbtable and query:
        raise ValueError("Only one of 'dbtable' and 'query' may be provided.")
    options = {"url": url}
    split = (partition_column, lower, upper, partitions)
    if any(s is not None for s in split):
        if any(s is None for s in split):
            raise ValueError("partition_column, lower, upper and partitions must be provided together")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower),
            upperBound=str(upper),
            numPartitions=str(partitions),
        )
    if dbtable:
        options["dbtable"] = dbtable
    elif "partitionColumn" in options:
        # A partitioned read takes a table, so the query becomes a derived one.
        options["dbtable"] = f"({query}) q"
    else:
        options["query"] = query
    if custom_schema:
        options["customSchema"] = custom_schema
    return options


def read_database(spark: SparkSession, connection: Mapping[str, str] | None = None, **what: Any) -> DataFrame:
    """A table or query, in parallel key ranges where bounds are given.

    Filters, projections, aggregates and limits above it reach the database.
    """
    return spark.read.format("jdbc").options(**(connection or {})).options(**read_options(**what)).load()


def read_database_ranges(
    spark: SparkSession, url: str, dbtable: str, predicates: list[str], connection: Mapping[str, str] | None = None
) -> DataFrame:
    """A table in the pieces of a ``range_plan``, one task per predicate."""
    return spark.read.jdbc(url, dbtable, predicates=predicates, properties=dict(connection or {}))


def write_options(url: str, dbtable: str, batch_size: int = INSERT_BATCH, truncate: bool = True) -> dict[str, str]:
    if not dbtable:
        raise ValueError("a database is written to by dbtable")
    if batch_size <= 0:
        raise ValueError("batch size must be a positive integer")
    return {"url": url, "dbtable": dbtable, "batchsize": str(batch_size), "truncate": str(truncate).lower()}


def write_database(
    df: DataFrame, mode: str = "append", connection: Mapping[str, str] | None = None, **what: Any
) -> None:
    """Insert the rows.  Each task commits on its own, so a failed append can leave part of the rows."""
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of: {', '.join(SAVE_MODES)}")
    df.write.format("jdbc").mode(mode).options(**(connection or {})).options(**write_options(**what)).save()
