"""Files: text lines, JSON lines with totals, and JSON arrays."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

MODES = ("append", "overwrite")


def _check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of: {', '.join(MODES)}")


def write_lines(df: DataFrame, path: str, mode: str = "append", by: tuple[str, ...] = ()) -> None:
    """The first column as text lines, in folders by the columns of ``by``.

    Files appear when the job commits; overwrite replaces what the folder held.  Rows are
    gathered by folder first, so that few files are written, and a large folder is split.
    """
    _check_mode(mode)
    value = next(c for c in df.columns if c not in by)
    lines = df.select(F.col(f"`{value}`").cast("string").alias("value"), *by)
    if by:
        lines = lines.hint("rebalance", *by)
    lines.write.mode(mode).partitionBy(*by).text(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> dict[str, int]:
    """One JSON object per line; returns the totals of the committed job."""
    _check_mode(mode)
    totals = Observation("json_lines")
    counted = df.observe(totals, F.count(F.lit(1)).alias("total_count"))
    counted.write.mode(mode).option("ignoreNullFields", False).json(path)
    return {"total_count": totals.get["total_count"]}


def write_json_arrays(df: DataFrame, path: str, mode: str = "append", rows_per_file: int = 100_000) -> None:
    """Files that each hold one JSON array of at most ``rows_per_file`` rows, without a shuffle."""
    _check_mode(mode)
    if rows_per_file <= 0:
        raise ValueError("rows_per_file must be a positive integer")

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(text)
                if len(held) == rows_per_file:
                    yield pa.RecordBatch.from_pydict({"value": ["[" + ",".join(held) + "]"]})
                    held = []
        if held:
            yield pa.RecordBatch.from_pydict({"value": ["[" + ",".join(held) + "]"]})

    objects = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    objects.mapInArrow(arrays, "value string").write.mode(mode).option("maxRecordsPerFile", 1).text(path)
