"""Checking a table against a declared contract in one aggregate pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.functions.nested import is_json


@dataclass(frozen=True)
class ColumnRule:
    type: str | None = None
    required: bool = False
    minimum: Any = None
    maximum: Any = None
    allowed: Sequence[Any] | None = None
    json: bool = False

    def violations(self, col: Column) -> dict[str, Column]:
        found: dict[str, Column] = {}
        if self.required:
            found["missing"] = col.isNull()
        if self.minimum is not None:
            found["below_min"] = col < F.lit(self.minimum)
        if self.maximum is not None:
            found["above_max"] = col > F.lit(self.maximum)
        if self.allowed is not None:
            found["not_allowed"] = ~col.isin(list(self.allowed))
        if self.json:
            found["bad_json"] = col.isNotNull() & ~is_json(col)
        return found


def check_columns(schema: T.StructType, rules: Mapping[str, ColumnRule]) -> None:
    """Raise where a named column is absent or has another type."""
    for name, rule in rules.items():
        if name not in schema.fieldNames():
            raise ValueError(f"column '{name}' not found; columns are {', '.join(schema.fieldNames())}")
        actual = schema[name].dataType.simpleString()
        if rule.type is not None and actual != rule.type:
            raise ValueError(f"column '{name}' must be {rule.type}, not {actual}")


def contract_report(df: DataFrame, rules: Mapping[str, ColumnRule]) -> DataFrame:
    """One row: the row count and, per column and rule, how many rows break it."""
    check_columns(df.schema, rules)
    counts = [
        F.count_if(bad).alias(f"{name}_{kind}")
        for name, rule in rules.items()
        for kind, bad in rule.violations(F.col(f"`{name}`")).items()
    ]
    return df.agg(F.count("*").alias("n_rows"), *counts)


def check_against(df: DataFrame, target: T.StructType) -> None:
    """Raise unless ``df`` offers the target's mandatory columns and only its types."""
    given = {f.name: f.dataType for f in df.schema.fields}
    for field in target.fields:
        if field.name not in given:
            if not field.nullable:
                raise ValueError(f"mandatory column '{field.name}' not found")
        elif given[field.name] != field.dataType:
            raise ValueError(
                f"column '{field.name}' must be {field.dataType.simpleString()}, "
                f"not {given[field.name].simpleString()}"
            )
    unknown = sorted(set(given) - set(target.fieldNames()))
    if unknown:
        raise ValueError(f"column(s) {', '.join(unknown)} not in the target schema")
