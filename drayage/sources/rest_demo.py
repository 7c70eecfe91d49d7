"""The six endpoints of the public REST demo service."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.functions.nested import flatten_struct
from drayage.landed import bodies

# The fields each endpoint serves.
ENDPOINTS: dict[str, str] = {
    "posts": "userId INT, id INT, title STRING, body STRING",
    "users": (
        "id INT, name STRING, username STRING, email STRING, phone STRING, website STRING, "
        "address STRUCT<street: STRING, suite: STRING, city: STRING, zipcode: STRING, "
        "geo: STRUCT<lat: STRING, lng: STRING>>, "
        "company STRUCT<name: STRING, catchPhrase: STRING, bs: STRING>"
    ),
    "todos": "userId INT, id INT, title STRING, completed BOOLEAN",
    "comments": "postId INT, id INT, name STRING, email STRING, body STRING",
    "albums": "userId INT, id INT, title STRING",
    "photos": "albumId INT, id INT, title STRING, url STRING, thumbnailUrl STRING",
}


def endpoint_schema(endpoint: str) -> T.StructType:
    if endpoint not in ENDPOINTS:
        raise ValueError(f"unknown endpoint '{endpoint}'; must be one of: {', '.join(ENDPOINTS)}")
    return T.StructType.fromDDL(ENDPOINTS[endpoint])


def rest_rows(landed: DataFrame, endpoint: str, on_error: str = "fail") -> DataFrame:
    """Rows of an endpoint, nested objects flattened; a body is a list or one object.

    Missing text becomes empty and a missing flag false; missing numbers stay null.
    """
    schema = T.ArrayType(endpoint_schema(endpoint))
    text = F.trim("body")
    listed = F.when(F.startswith(text, F.lit("{")), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    mode = "FAILFAST" if on_error == "fail" else "PERMISSIVE"
    items = bodies(landed, on_error).select(F.inline(F.from_json(listed, schema, {"mode": mode})))
    flat = flatten_struct(items)
    fills = {T.StringType(): "", T.BooleanType(): False}
    return flat.select(
        [
            F.coalesce(F.col(f.name), F.lit(fills[f.dataType])).alias(f.name) if f.dataType in fills else f.name
            for f in flat.schema.fields
        ]
    )


def first_rows(rows: DataFrame, limit: int, key: str = "id") -> DataFrame:
    """The service's ``limit``: the first rows by id."""
    return rows.orderBy(key).limit(limit)


def by_id(rows: DataFrame, value: int, key: str = "id") -> DataFrame:
    return rows.where(F.col(key) == value)
