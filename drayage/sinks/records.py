"""CRM records, created in tree requests of up to 200."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage import outbox
from drayage.functions.convert import record_value
from drayage.functions.nested import any_filled, json_object, member, members
from drayage.operators.batching import batch_assign, collect_batches

DEFAULT_BATCH = 200
DEFAULT_OBJECT = "Account"
# Fixed value: the fields of the default object.
ACCOUNT_DDL = (
    "Name STRING NOT NULL, Industry STRING, Phone STRING, Website STRING, AnnualRevenue DOUBLE, "
    "NumberOfEmployees INT, BillingStreet STRING, BillingCity STRING, BillingState STRING, "
    "BillingPostalCode STRING, BillingCountry STRING"
)


def target_schema(ddl: str | None = None) -> T.StructType:
    return T.StructType.fromDDL(ddl or ACCOUNT_DDL)


def record_members(schema: T.StructType) -> Column:
    """The filled fields of a row as JSON members; null where a row has none."""
    return members(*[record_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields])


def assigned_records(rows: DataFrame, *order_by: str | Column, batch_size: int = DEFAULT_BATCH) -> DataFrame:
    """Rows that have content, with their batch and the reference id they carry in its request."""
    filled = rows.where(any_filled(rows.columns))
    batched = batch_assign(filled, batch_size, *order_by)
    return batched.withColumn("reference_id", F.concat(F.lit("ref"), F.col("seq").cast("string")))


def record_json(schema: T.StructType, sobject: str) -> Column:
    attributes = F.concat(
        F.lit("{"), members(F.lit(sobject).alias("type"), F.col("reference_id").alias("referenceId")), F.lit("}")
    )
    return json_object(member("attributes", attributes), record_members(schema))


def record_outbox(
    rows: DataFrame, sobject: str = DEFAULT_OBJECT, *order_by: str | Column, batch_size: int = DEFAULT_BATCH
) -> DataFrame:
    batched = assigned_records(rows, *order_by, batch_size=batch_size)
    batches = collect_batches(batched, record_json(rows.schema, sobject))
    path = f"/composite/tree/{sobject}"
    return outbox.batch_requests(batches, f"tree-{sobject}", "POST", path, '{"records":[', "]}").select(
        *outbox.SPLIT_COLUMNS
    )


def accepted_records(answer: str, n_records: int) -> int:
    """How many records of a tree request were created, by the text of the answer."""
    told = json.loads(answer)
    if told.get("hasErrors", True) is False:
        return n_records
    return sum("id" in result for result in told.get("results", []))


def refused_records(answer: str, request: dict) -> list[int]:
    """Which records of a tree request were not created, counted from 0.

    Results carry the reference id of their record; without one they stand in the order of the records.
    """
    told = json.loads(answer)
    if told.get("hasErrors", True) is False:
        return []
    sent = [record["attributes"]["referenceId"] for record in json.loads(request["body"])["records"]]
    results = told.get("results", [])
    if len(results) == len(sent) and any("referenceId" not in result for result in results):
        return [n for n, result in enumerate(results) if "id" not in result]
    created = {result.get("referenceId") for result in results if "id" in result}
    return [n for n, reference in enumerate(sent) if reference not in created]


def single_record_outbox(failed: DataFrame, schema: T.StructType, sobject: str, key: str) -> DataFrame:
    """Records of failed tree requests, one request each; the key is the same on every retry."""
    body = json_object(record_members(schema))
    return outbox.single_requests(
        failed, f"record-{sobject}", F.lit("POST"), F.lit(f"/sobjects/{sobject}"), body, F.col(key), distinct=True
    )
