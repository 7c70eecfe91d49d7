"""Splitting keys, dates and symbol lists into pieces that are read in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Numbers produced from one row of an intermediate step; bounds the array behind it.
NUMBERS_PER_ROW = 10_000


def range_plan(df: DataFrame, column: str, pieces: int) -> DataFrame:
    """``pieces`` equal key ranges as rows; the first takes the nulls and the last is open above.

    Bounds come from one min/max pass.  ``predicate`` is ready for a database read.
    """
    bounds = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    width = F.greatest(F.expr(f"(hi - lo + {pieces}) div {pieces}"), F.lit(1))
    rows = bounds.select(F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("part_no"), "lo", "hi")
    lower = F.col("lo") + F.col("part_no") * width
    is_last = F.col("part_no") == pieces - 1
    planned = rows.select(
        "part_no",
        F.when(F.col("part_no") > 0, lower).cast("long").alias("lower"),
        F.when(~is_last, lower + width).cast("long").alias("upper"),
    )
    above = F.concat(F.lit(f"{column} >= "), F.col("lower").cast("string"))
    below = F.concat(F.lit(f"{column} < "), F.col("upper").cast("string"))
    only = F.when(F.col("lower").isNull() & F.col("upper").isNull(), F.lit("1 = 1"))
    first = F.when(F.col("lower").isNull(), F.concat(below, F.lit(f" or {column} is null")))
    last = F.when(F.col("upper").isNull(), above)
    return planned.withColumn("predicate", F.coalesce(only, first, last, F.concat(above, F.lit(" and "), below)))


def number_rows(df: DataFrame, last: Column, name: str) -> DataFrame:
    """Each row once per number 0..``last``; long runs are spread over the cluster in blocks."""
    block = NUMBERS_PER_ROW
    blocks = (
        df.withColumn("_to", last.cast("long"))
        .where(F.col("_to") >= 0)
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"_to div {block}"))))
        .repartition(*[F.col(f"`{c}`") for c in df.columns], F.col("_block"))
    )
    low = F.col("_block") * block
    numbers = F.sequence(low, F.least(low + (block - 1), F.col("_to")))
    return blocks.withColumn(name, F.explode(numbers)).drop("_to", "_block")


def date_plan(df: DataFrame, column: str) -> DataFrame:
    """One row per day between the first and the last value."""
    day = F.col(column).cast("date")
    return df.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("day")
    )


def symbols(text: Column) -> Column:
    """The trimmed entries of a comma list."""
    return F.transform(F.split(text, ","), lambda s: F.trim(s))


def trading_pairs(text: Column) -> Column:
    """Upper-case pairs of a comma list, in US dollars where no currency is given, without blanks."""
    filled = F.filter(F.transform(symbols(text), lambda s: F.upper(s)), lambda s: s != "")
    return F.transform(filled, lambda s: F.when(F.contains(s, F.lit("-")), s).otherwise(F.concat(s, F.lit("-USD"))))


def symbol_rows(lists: DataFrame, column: str, pairs: bool = False) -> DataFrame:
    """One row ``symbol`` per entry of every list, spread over the cluster by symbol."""
    entries = trading_pairs(F.col(column)) if pairs else symbols(F.col(column))
    others = [c for c in lists.columns if c != column]
    return lists.select(*others, F.explode(entries).alias("symbol"))
