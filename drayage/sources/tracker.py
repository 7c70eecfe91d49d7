"""Pull requests and issues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.landed import parsed

PULLS_DDL = (
    "ARRAY<STRUCT<number: INT, title: STRING, user: STRUCT<login: STRING>, "
    "created_at: STRING, updated_at: STRING>>"
)
ISSUES_DDL = (
    "issues ARRAY<STRUCT<key: STRING, fields: STRUCT<"
    "summary: STRING, status: STRUCT<name: STRING>, description: STRING, created: STRING, updated: STRING, "
    "assignee: STRUCT<displayName: STRING>, reporter: STRUCT<displayName: STRING>, "
    "priority: STRUCT<name: STRING>, issuetype: STRUCT<name: STRING>, project: STRUCT<key: STRING>>>>"
)


def pull_requests(landed: DataFrame, on_error: str = "fail") -> DataFrame:
    return (
        parsed(landed, PULLS_DDL, on_error)
        .select(F.explode("doc").alias("p"))
        .select(
            F.col("p.number").alias("id"),
            "p.title",
            F.col("p.user.login").alias("author"),
            "p.created_at",
            "p.updated_at",
        )
    )


def issues(landed: DataFrame, on_error: str = "fail") -> DataFrame:
    return (
        parsed(landed, ISSUES_DDL, on_error)
        .select(F.explode("doc.issues").alias("i"))
        .select(
            "i.key",
            "i.fields.summary",
            F.col("i.fields.status.name").alias("status"),
            "i.fields.description",
            "i.fields.created",
            "i.fields.updated",
            F.col("i.fields.assignee.displayName").alias("assignee"),
            F.col("i.fields.reporter.displayName").alias("reporter"),
            F.col("i.fields.priority.name").alias("priority"),
            F.col("i.fields.issuetype.name").alias("issuetype"),
            F.col("i.fields.project.key").alias("project"),
        )
    )
