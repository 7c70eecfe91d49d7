"""New pages of a document database, one request each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage import outbox
from drayage.functions.nested import is_json, members
from drayage.operators.rejects import split_valid


def page_rules() -> dict[str, Column]:
    """Why a row cannot become a page.  The properties must be a JSON object with content."""
    text = F.col("properties")
    filled = F.size(F.map_keys(F.from_json(text, "MAP<STRING, STRING>"))) > 0
    return {
        "properties missing": F.coalesce(text, F.lit("")) == "",
        "properties not valid JSON": ~is_json(text),
        "properties empty": ~F.coalesce(filled, F.lit(False)),
    }


def split_pages(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_valid(rows, page_rules())


def page_outbox(rows: DataFrame, database_id: str, *content_keys: str) -> DataFrame:
    good, _ = split_pages(rows)
    parent = F.concat(F.lit("{"), members(F.lit(database_id).alias("database_id")), F.lit("}"))
    body = F.concat(F.lit('{"parent":'), parent, F.lit(',"properties":'), F.col("properties"), F.lit("}"))
    key = F.sha2(F.concat_ws("\u001f", *[F.col(c).cast("string") for c in content_keys], "properties"), 256)
    return outbox.single_requests(good, "page", F.lit("POST"), F.lit("/v1/pages"), body, key, bool(content_keys))
