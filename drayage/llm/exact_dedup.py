"""Exact duplicates: combine locally, by salted digest groups, then across salts.

1. Rows with the same digest, salt and *text* are combined; Spark does this within each task
   before it shuffles, so copies that lie together travel once.
2. The winners of the salts are combined across salts, again by digest and text.
3. The answer goes back to the rows by digest and salt, so that no task gets a whole hot group.

Texts are compared in full in 1 and 2.  That also shows whether a digest stands for more than
one text; where it does, its rows are joined by text instead (step 3 for such digests only).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.llm.salted import join_back, salt_mask, salt_of
from drayage.scratch import stage


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def duplicate_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """For every row: ``key``, ``keep`` (the group's largest key), ``group_size``, ``digest``.

    Null text counts as empty.  Null keys lose to all others; a group of null keys keeps null.
    Repeated rows are counted each.  An empty table gives an empty result.  Other columns are
    not read, whatever their names.  ``digest`` need not be free of collisions.
    """
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")
    ).select("key", "text", digest(F.col("text")).alias("digest"), salt_of(F.col("key")).alias("salt"))

    by_salt = rows.groupBy("digest", "salt", "text").agg(F.max("key").alias("keep"), F.count("*").alias("n"))
    by_text = by_salt.groupBy("digest", "text").agg(
        F.max("keep").alias("keep"), F.sum("n").alias("group_size"), salt_mask(F.col("salt")).alias("salts")
    )
    # One row for each digest; texts is 1 unless the digest collides.
    groups = stage(
        by_text.groupBy("digest").agg(
            F.max("keep").alias("keep"),
            F.max("group_size").alias("group_size"),
            F.bit_or("salts").alias("salts"),
            F.count("*").alias("texts"),
        ),
        "duplicate-groups",
    )
    joined = join_back(rows.select("key", "digest", "salt"), groups, "digest", "salt", "salts").select(
        "key", "keep", "group_size", "digest", "texts"
    )
    colliding = groups.where("texts > 1").select("digest")
    if colliding.isEmpty():
        return joined.drop("texts")
    several = rows.join(colliding, "digest", "left_semi")
    answers = by_text.join(colliding, "digest", "left_semi").drop("salts")
    exact = several.join(answers, ["digest", "text"]).select("key", "keep", "group_size", "digest")
    return joined.where("texts = 1").drop("texts").unionByName(exact)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without exact copies: of equal texts the row with the largest key stays.

    Null text counts as empty; of rows that also agree in the key, one stays.  The columns are
    those of ``docs``.
    """
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest, salt, copies = (unused_name(docs, name) for name in ("_digest", "_salt", "_copies"))
    winners = (
        duplicate_groups(docs, key, text)
        .where("key <=> keep")
        .groupBy("digest", "keep")
        .agg(F.count("*").alias(copies))
        .withColumns({digest: F.col("digest"), salt: salt_of(F.col("keep")), "_keep": F.col("keep")})
        .select(digest, salt, copies, "_keep")
    )
    rows = docs.withColumns({digest: sha256(content), salt: salt_of(F.col(f"`{key}`"))})
    same = (
        (rows[digest] == winners[digest])
        & (rows[salt] == winners[salt])
        & rows[key].eqNullSafe(winners["_keep"])
    )
    kept = rows.join(winners, same).select(*[rows[c] for c in docs.columns], rows[digest], copies)
    # Only rows that agree in text and key are left more than once.
    repeated = kept.where(F.col(copies) > 1).dropDuplicates([digest])
    return kept.where(F.col(copies) == 1).unionByName(repeated).select(*docs.columns)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
