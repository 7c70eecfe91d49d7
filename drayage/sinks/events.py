"""Conversion events, sent in batches."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage import outbox
from drayage.functions import convert
from drayage.functions.nested import json_object, json_object_or_null, member, members
from drayage.operators.batching import batch_assign, collect_batches
from drayage.operators.rejects import split_valid

DEFAULT_BATCH = 1000
DEFAULT_API_VERSION = "v19.0"
DEFAULT_ACTION_SOURCE = "website"
# Stands for the time of sending until the key of a request is known; no JSON text can hold it.
_NOW = "@now"


def event_rules(schema: T.StructType) -> dict[str, Column]:
    """Why a row cannot become an event."""
    rules = {"event_name missing": F.lit(True)}
    if "event_name" in schema.fieldNames():
        rules["event_name missing"] = _filled(schema, "event_name").isNull()
    if "event_time" in schema.fieldNames():
        seconds = convert.event_epoch(F.col("event_time"), schema["event_time"].dataType)
        rules["event_time unreadable"] = seconds.isNull()
    return rules


def split_events(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_valid(rows, event_rules(rows.schema))


def event_json(schema: T.StructType, now: Column | None = None) -> Column:
    """The event of a row as JSON; parts without content are left out.

    ``now`` is the JSON text of a time that is not given, else the current second.
    """
    names = schema.fieldNames()
    event_time = _current_second() if now is None else now
    if "event_time" in names:
        seconds = convert.event_epoch(F.col("event_time"), schema["event_time"].dataType).cast("string")
        event_time = F.when(F.col("event_time").isNull(), event_time).otherwise(seconds)
    action = _filled(schema, "action_source")
    source = F.lit(DEFAULT_ACTION_SOURCE)
    event_name = (F.col("event_name") if "event_name" in names else F.lit(None)).cast("string")
    base = [
        (source if action is None else F.coalesce(action, source)).alias("action_source"),
    ]
    event_id = _filled(schema, "event_id")
    if event_id is not None:
        base.append(event_id.alias("event_id"))
    return json_object(
        members(event_name.alias("event_name")),
        member("event_time", event_time),
        members(*base),
        member("user_data", _given_or(schema, "user_data", _flat_user_data(schema))),
        member("custom_data", _given_or(schema, "custom_data", _flat_custom_data(schema))),
    )


def _current_second() -> Column:
    return F.unix_timestamp(F.current_timestamp()).cast("string")


def _filled(schema: T.StructType, *names: str) -> Column | None:
    return convert.first_filled(schema, *names)


def _flat_user_data(schema: T.StructType) -> Column:
    """User fields from flat columns; each may go by a short name."""
    found = {
        "em": (_filled(schema, "email", "em"), convert.hashed_email),
        "ph": (_filled(schema, "phone", "ph"), convert.hashed_phone),
        "client_ip_address": (_filled(schema, "client_ip_address", "ip"), None),
        "client_user_agent": (_filled(schema, "client_user_agent", "user_agent"), None),
        "fbc": (_filled(schema, "fbc"), None),
        "fbp": (_filled(schema, "fbp"), None),
        "external_id": (_filled(schema, "external_id"), None),
    }
    fields = [
        (col if change is None else change(col)).alias(name) for name, (col, change) in found.items() if col is not None
    ]
    return json_object_or_null(members(*fields)) if fields else F.lit(None).cast("string")


def _flat_custom_data(schema: T.StructType) -> Column:
    fields = []
    if "value" in schema.fieldNames():
        fields.append(F.col("value"))
    currency = _filled(schema, "currency")
    if currency is not None:
        fields.append(currency.alias("currency"))
    return json_object_or_null(members(*fields)) if fields else F.lit(None).cast("string")


def _given_or(schema: T.StructType, name: str, flat: Column) -> Column:
    """A struct column as it is, nulls included; the flat form where there is none."""
    if name not in schema.fieldNames():
        return flat
    given = F.to_json(F.col(name), {"ignoreNullFields": "false"})
    return F.when(F.col(name).isNotNull(), given).otherwise(flat)


def event_outbox(
    rows: DataFrame,
    pixel_id: str,
    *order_by: str | Column,
    batch_size: int = DEFAULT_BATCH,
    api_version: str = DEFAULT_API_VERSION,
    test_event_code: str | None = None,
) -> DataFrame:
    """Requests of up to ``batch_size`` events each, in the order of ``order_by`` or else as they come.

    The access token is added on sending.  Events without a time get that of the outbox, which is
    no part of the keys: the same rows built later have the same keys.
    """
    good, _ = split_events(rows)
    batched = batch_assign(good, batch_size, *order_by)
    batches = collect_batches(batched, event_json(rows.schema, F.lit(_NOW)))
    suffix = "]}"
    if test_event_code is not None:
        suffix = f'],"test_event_code":{json.dumps(test_event_code)}}}'
    requests = outbox.batch_requests(
        batches, f"events-{pixel_id}", "POST", f"/{api_version}/{pixel_id}/events", '{"data":[', suffix
    )
    untimed, timed = (F.concat(F.lit('"event_time":'), t) for t in (F.lit(_NOW), _current_second()))
    return requests.withColumn("body", F.replace("body", untimed, timed)).select(*outbox.COLUMNS)
