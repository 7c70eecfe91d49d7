"""Run queries and their SQL twins side by side: ``python tests/compare.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="drayage-"))
        .getOrCreate()
    )


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def differences(frame, connection, sql: str) -> str | None:
    """None where both give the same rows of the same types, else what differs."""
    types = {f.name: SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in frame.schema.fields}
    sql_types = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    if types != sql_types:
        return f"types: spark {types}, sql {sql_types}"
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    ours, theirs = rows_of(frame.columns, frame.collect()), rows_of(names, result.fetchall())
    if ours == theirs:
        return None if ours else "both are empty"
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"only in spark {sum(extra.values())}, e.g. {list(extra)[:2]}; "
        f"only in sql {sum(missing.values())}, e.g. {list(missing)[:2]}"
    )


def main() -> int:
    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, connection = session(), database(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles, bad = entry.queries(), entry.oracle_sql(), 0
    for name in wanted or queries:
        start = time.time()
        try:
            problem = differences(queries[name](spark, sf_dir), connection, oracles[name])
        except Exception as error:  # the report goes on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{bad} of {len(wanted or queries)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main())
