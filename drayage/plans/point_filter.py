"""The vector store's JSON filter as a column predicate."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_predicate(condition: Mapping[str, Any], payload: Column) -> Column:
    """``{"must": [{"key": ..., "match": {"value": ...}}]}`` over a JSON payload column.

    Any other form raises, so that no condition is dropped unnoticed.
    """
    if set(condition) != {"must"} or not isinstance(condition["must"], list):
        raise ValueError("filter must be an object with the single list 'must'")
    return reduce(Column.__and__, [_match(term, payload) for term in condition["must"]], F.lit(True))


def _match(term: Any, payload: Column) -> Column:
    is_plain = isinstance(term, Mapping) and set(term) == {"key", "match"} and isinstance(term["match"], Mapping)
    if not is_plain or set(term["match"]) != {"value"}:
        raise ValueError(f"unsupported filter condition: {term}; only key with match.value is known")
    value = term["match"]["value"]
    path = "$" + "".join(f"['{part}']" for part in str(term["key"]).split("."))
    stored, wanted = _variant_type(value)
    found = F.try_variant_get(F.try_parse_json(payload), path, "variant")
    same = (F.schema_of_variant(found) == stored) & (F.try_variant_get(found, "$", wanted) == F.lit(value))
    return F.coalesce(same, F.lit(False))


def _variant_type(value: Any) -> tuple[str, str]:
    """How a variant names the value's type, and the type to read it as."""
    if isinstance(value, bool):
        return "BOOLEAN", "boolean"
    if isinstance(value, int):
        return "BIGINT", "long"
    if isinstance(value, str):
        return "STRING", "string"
    raise ValueError(f"unsupported match value: {value!r}; text, whole number or boolean expected")
