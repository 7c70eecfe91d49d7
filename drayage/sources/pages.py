"""Pages of a document database."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.landed import parsed

# A text field takes whatever JSON stands there, so the property bag stays as it is.
PAGES_DDL = (
    "results ARRAY<STRUCT<id: STRING, created_time: STRING, last_edited_time: STRING, "
    "url: STRING, properties: STRING>>, has_more BOOLEAN, next_cursor STRING"
)
PROPERTY_DDL = "MAP<STRING, STRUCT<type: STRING, title: ARRAY<STRUCT<plain_text: STRING>>>>"


def title_of(properties: Column) -> Column:
    """Text of the first property whose type is ``title``, whatever its name; empty if none."""
    entries = F.map_entries(F.from_json(properties, PROPERTY_DDL))
    title = F.get(F.filter(entries, lambda e: e["value"]["type"] == "title"), F.lit(0))
    return F.coalesce(F.get(title["value"]["title"], F.lit(0))["plain_text"], F.lit(""))


def database_pages(landed: DataFrame, on_error: str = "fail") -> DataFrame:
    pages = parsed(landed, PAGES_DDL, on_error).select(F.explode("doc.results").alias("p"))
    properties = F.coalesce("p.properties", F.lit("{}"))
    return pages.select(
        "p.id",
        title_of(properties).alias("title"),
        F.to_timestamp("p.created_time").alias("created_time"),
        F.to_timestamp("p.last_edited_time").alias("last_edited_time"),
        "p.url",
        properties.alias("properties"),
    )


def cursor_pages(landed: DataFrame) -> DataFrame:
    """Landed pages with ``has_more`` and ``next_cursor``, for the completeness checks."""
    return parsed(landed, "has_more BOOLEAN, next_cursor STRING").select(
        "request_key", "page_no", "doc.has_more", "doc.next_cursor"
    )
