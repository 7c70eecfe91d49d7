"""Page plans, and checks that all pages of a listing have landed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.plans.ranges import number_rows
from drayage.scratch import stage


def offset_pages(totals: DataFrame, page_size: int, total: str = "total") -> DataFrame:
    """One row per page of every listing whose row count is known: ``page_no``, ``start_at``, ``max_results``."""
    if page_size <= 0:
        raise ValueError("page size must be a positive integer")
    others = [c for c in totals.columns if c != total]
    listed = totals.where(F.col(total) > 0)
    pages = number_rows(listed, F.expr(f"({total} - 1) div {page_size}"), "page_no")
    start_at = F.col("page_no") * page_size
    return pages.select(
        *others,
        "page_no",
        start_at.alias("start_at"),
        F.least(F.lit(page_size), F.col(total) - start_at).cast("int").alias("max_results"),
    )


def missing_pages(landed: DataFrame, has_more: str = "has_more") -> DataFrame:
    """Page numbers that are absent from each listing.

    A gap lies between two landed pages; one more page is missing after the last landed one
    where it announces a successor.
    """
    last = landed.groupBy("request_key").agg(
        F.max("page_no").alias("_last"), F.max_by(F.coalesce(F.col(has_more), F.lit(False)), "page_no").alias("_more")
    )
    final = F.col("_last") + F.col("_more").cast("int")
    expected = number_rows(last, final, "page_no").select("request_key", "page_no")
    # A page may have landed many times; copies are merged before they meet in one task.
    present = landed.select("request_key", "page_no").distinct()
    return expected.join(present, ["request_key", "page_no"], "left_anti")


def broken_links(landed: DataFrame, offset: str = "offset", next_offset: str = "next_offset") -> DataFrame:
    """Pages whose successor did not land: their next offset is no page's own offset."""
    own = landed.select("request_key", F.col(offset).alias(next_offset)).distinct()
    return landed.where(F.col(next_offset).isNotNull()).join(own, ["request_key", next_offset], "left_anti")


def chain_order(
    landed: DataFrame, key: str = "request_key", offset: str = "offset", next_offset: str = "next_offset"
) -> DataFrame:
    """Where every page stands in its chain of pages, by following all links at once.

    Returns ``key``, ``offset``, ``state``, ``last`` (offset of the page the chain ends with), ``following`` (pages
    after this one) and ``position`` (from 0).  ``state`` is ``complete`` where the last page names no successor,
    ``broken`` where that successor has not landed, and ``cycle`` where the links never end; then the
    numbers are null.  Of pages that landed more than once with different successors the largest counts; chains that
    run into each other are numbered from the longest way.

    Each round a page takes over the link of the page it points to and so sees twice as far: a chain
    of n pages takes log2(n) rounds of one join, and only pages that have not seen their end take
    part.  What points nowhere final after as many rounds lies on, or leads into, a cycle.
    """
    pages = stage(
        landed.where(F.col(offset).isNotNull())
        .groupBy(F.col(key).alias("_key"), F.col(offset).alias("_own"))
        .agg(F.max(next_offset).alias("_next")),
        "pages",
    )
    there = pages.select("_key", F.col("_own").alias("_next"), F.lit(True).alias("_there"))
    linked = pages.join(there, ["_key", "_next"], "left")
    ends = F.col("_there").isNull()
    jumps = stage(
        linked.select(
            "_key",
            "_own",
            F.when(ends, F.col("_own")).otherwise(F.col("_next")).alias("_to"),
            F.when(ends, 0).otherwise(1).cast("long").alias("_steps"),
            ends.alias("_done"),
            F.when(ends, F.when(F.col("_next").isNull(), "complete").otherwise("broken")).alias("_state"),
        ),
        "jumps",
    )
    reach, count = 1, jumps.count()
    while reach < count and not (open_ := jumps.where(~F.col("_done"))).isEmpty():
        target = jumps.select(
            "_key",
            F.col("_own").alias("_to"),
            F.col("_to").alias("_further"),
            F.col("_steps").alias("_more"),
            F.col("_done").alias("_ended"),
            F.col("_state").alias("_kind"),
        )
        further = open_.join(target, ["_key", "_to"]).select(
            "_key",
            "_own",
            F.col("_further").alias("_to"),
            (F.col("_steps") + F.col("_more")).alias("_steps"),
            F.col("_ended").alias("_done"),
            F.col("_kind").alias("_state"),
        )
        jumps, reach = stage(jumps.where("_done").unionByName(further), "jumps"), 2 * reach
    ended = jumps.where("_done")
    longest = ended.groupBy("_key", "_to").agg(F.max("_steps").alias("_longest"))
    numbered = jumps.join(longest, ["_key", "_to"], "left")
    known = lambda value: F.when(F.col("_done"), value)
    return numbered.select(
        F.col("_key").alias(key),
        F.col("_own").alias(offset),
        F.when(F.col("_done"), F.col("_state")).otherwise("cycle").alias("state"),
        known(F.col("_to")).alias("last"),
        known(F.col("_steps")).alias("following"),
        known(F.col("_longest") - F.col("_steps")).alias("position"),
    )
