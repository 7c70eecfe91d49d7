"""Splitting good rows from bad ones, with the reason kept."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def with_reason(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the first reason whose condition holds, or null for a good row."""
    reasons = [F.when(F.coalesce(bad, F.lit(False)), F.lit(reason)) for reason, bad in rules.items()]
    return df.withColumn(REASON, F.coalesce(*reasons) if reasons else F.lit(None).cast("string"))


def split_valid(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with a reason); together they are the whole input."""
    marked = with_reason(df, rules)
    return marked.where(F.col(REASON).isNull()).drop(REASON), marked.where(F.col(REASON).isNotNull())


def apply_rules(df: DataFrame, rules: Mapping[str, Column], fail_fast: bool) -> DataFrame:
    """Good rows only; with ``fail_fast`` the first bad row stops the job with its reason."""
    marked = with_reason(df, rules)
    if not fail_fast:
        return marked.where(F.col(REASON).isNull()).drop(REASON)
    checked = F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("row rejected: "), F.col(REASON))).cast("boolean")
    )
    return marked.where(checked).drop(REASON)
