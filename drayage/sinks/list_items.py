"""Items of a shared list, and the registry of resources that can take rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage import outbox
from drayage.functions.nested import any_filled, json_object, members

# A resource turns rows into an outbox; further kinds are added with ``register_resource``.
Resource = Callable[..., DataFrame]
RESOURCES: dict[str, Resource] = {}


def register_resource(name: str, build: Resource) -> None:
    RESOURCES[name] = build


def resource_outbox(rows: DataFrame, resource: str, **options) -> DataFrame:
    if resource not in RESOURCES:
        raise ValueError(f"nothing can be written to {resource}; resources are {', '.join(RESOURCES)}")
    return RESOURCES[resource](rows, **options)


def mapped_records(rows: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """The mapped columns under their new names."""
    unknown = [name for name in fields if name not in rows.columns]
    if unknown:
        raise ValueError(f"rows have no column {', '.join(unknown)}; theirs are {', '.join(rows.columns)}")
    return rows.select([F.col(f"`{old}`").alias(new) for old, new in fields.items()])


def list_item_outbox(rows: DataFrame, site_id: str, list_id: str, fields: Mapping[str, str], *content_keys: str):
    """One request per row with at least one filled field."""
    mapped_records(rows, fields)  # the names are checked before any row is read
    item = json_object(members(*[F.col(f"`{old}`").alias(new) for old, new in fields.items()]))
    filled = rows.where(any_filled(list(fields))).withColumn("_item", item)
    key = F.sha2(F.concat_ws("\u001f", *[F.col(c).cast("string") for c in content_keys], "_item"), 256)
    return outbox.single_requests(
        filled,
        f"list-{list_id}",
        F.lit("POST"),
        F.lit(f"/sites/{site_id}/lists/{list_id}/items"),
        F.concat(F.lit('{"fields":'), F.col("_item"), F.lit("}")),
        key,
        distinct=bool(content_keys),
    )


register_resource("list", list_item_outbox)
