"""Issues, created or updated one request each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage import outbox
from drayage.functions.nested import any_filled, json_object, json_object_or_null, member, members

# Fields the tracker does not take from a writer.
READ_ONLY = ("created", "updated", "status", "resolution", "creator")
DEFAULT_TYPE = "Task"


def issue_outbox(
    rows: DataFrame,
    *content_keys: str,
    project: str | None = None,
    issuetype: str = DEFAULT_TYPE,
) -> DataFrame:
    """A row with a key becomes an update of the fields it fills, any other a new issue.

    Updates that fill no field are left out.  ``content_keys`` are columns that tell rows apart;
    without them equal rows are counted and numbered.
    """
    names = rows.columns
    has_key = F.coalesce(F.col("key").cast("string") != "", F.lit(False)) if "key" in names else F.lit(False)
    writable = [n for n in names if n != "key" and n not in READ_ONLY]

    update = json_object(members(*[F.col(f"`{n}`") for n in writable]))
    plain = [F.col(f"`{n}`") for n in writable if n not in ("project", "issuetype")]
    create = json_object(
        *([members(*plain)] if plain else []),
        _reference("project", "key", names, project),
        _reference("issuetype", "name", names, issuetype),
    )
    key = F.col("key").cast("string") if "key" in names else F.lit(None).cast("string")
    sent = rows.where(~has_key | any_filled(writable)).withColumn("_fields", F.when(has_key, update).otherwise(create))
    new_key = F.sha2(F.concat_ws("\u001f", *[F.col(c).cast("string") for c in content_keys], "_fields"), 256)
    return outbox.single_requests(
        sent,
        "issue",
        F.when(has_key, "PUT").otherwise("POST"),
        F.when(has_key, F.concat(F.lit("/rest/api/2/issue/"), key)).otherwise("/rest/api/2/issue"),
        F.concat(F.lit('{"fields":'), F.col("_fields"), F.lit("}")),
        F.when(has_key, key).otherwise(new_key),
        distinct=bool(content_keys),
    )


def _reference(name: str, inner: str, names: list[str], fallback: str | None) -> Column:
    """``"project": {"key": ...}``: a scalar, or else the option, as a reference object."""
    value = F.lit(fallback).cast("string")
    if name in names:
        value = F.coalesce(F.col(name).cast("string"), value)
    return member(name, json_object_or_null(members(value.alias(inner))))
