"""Plans and paging."""

import pytest
from pyspark.sql import functions as F

from drayage.plans import paging, point_filter, ranges, regions


def test_ranges_cover_every_row_once(spark):
    df = spark.createDataFrame([(k,) for k in [None, -5, 0, 3, 3, 17, 40, 41]], "k long")
    for pieces in (1, 2, 3, 7, 60):
        plan = ranges.range_plan(df, "k", pieces).orderBy("part_no").collect()
        assert len(plan) == pieces
        counts = [df.where(p["predicate"]).count() for p in plan]
        assert sum(counts) == 8, (pieces, counts)


def test_date_plan(spark):
    df = spark.sql("select timestamp_ntz'2024-02-28 23:00:00' t union all select timestamp_ntz'2024-03-01 01:00:00'")
    assert [str(r[0]) for r in ranges.date_plan(df, "t").collect()] == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_numbers_in_blocks(spark):
    df = spark.createDataFrame([("a", 25_000), ("b", 0), ("c", -1)], "k string, last long")
    numbers = ranges.number_rows(df, F.col("last"), "n")
    found = {r["k"]: (r["n"], r["hi"]) for r in numbers.groupBy("k").agg(F.count("*").alias("n"), F.max("n").alias("hi")).collect()}
    assert found == {"a": (25_001, 25_000), "b": (1, 0)}


def test_symbols(spark):
    df = spark.createDataFrame([(" btc, ETH-eur ,,doge",)], "s string")
    assert [r[0] for r in ranges.symbol_rows(df, "s", pairs=True).collect()] == ["BTC-USD", "ETH-EUR", "DOGE-USD"]
    assert [r[0] for r in ranges.symbol_rows(df, "s").collect()] == ["btc", "ETH-eur", "", "doge"]


def test_offset_pages(spark):
    totals = spark.createDataFrame([("a", 101), ("b", 0), ("c", 50)], "request_key string, total long")
    plan = paging.offset_pages(totals, 50).orderBy("request_key", "page_no")
    assert [tuple(r) for r in plan.collect()] == [("a", 0, 0, 50), ("a", 1, 50, 50), ("a", 2, 100, 1), ("c", 0, 0, 50)]


def test_missing_pages(spark):
    rows = [("a", 0, True), ("a", 1, True), ("a", 4, False), ("b", 2, True), ("c", 0, False)]
    pages = spark.createDataFrame(rows, "request_key string, page_no long, has_more boolean")
    assert {tuple(r) for r in paging.missing_pages(pages).collect()} == {("a", 2), ("a", 3), ("b", 0), ("b", 1), ("b", 3)}


def test_broken_links(spark):
    rows = [("a", None, "10"), ("a", "10", "20"), ("a", "30", None), ("b", "20", None)]
    pages = spark.createDataFrame(rows, "request_key string, offset string, next_offset string")
    assert [r["next_offset"] for r in paging.broken_links(pages).collect()] == ["20"]


def test_regions(spark):
    df = spark.createDataFrame([(50.0, 10.0), (35.0, 45.0), (None, 1.0)], "latitude double, longitude double")
    found = {}
    for r in regions.with_regions(df).collect():
        found.setdefault(r["latitude"], set()).add(r["region"])
    assert found == {50.0: {"EUROPE", "GLOBAL"}, 35.0: {"EUROPE", "ASIA", "AFRICA", "GLOBAL"}}
    assert df.where(regions.in_region("europe", F.col("latitude"), F.col("longitude"))).count() == 2
    with pytest.raises(ValueError, match="no region is called"):
        regions.in_region("moon", F.col("latitude"), F.col("longitude"))


def test_point_filter(spark):
    texts = ['{"c":"books","n":{"k":3}}', '{"c":"tech","n":{"k":3}}', '{"n":{"k":"3"}}', None, "{bad", '{"c":true}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, payload string")

    def ids(*terms):
        condition = {"must": [{"key": k, "match": {"value": v}} for k, v in terms]}
        rows = df.where(point_filter.payload_predicate(condition, F.col("payload"))).collect()
        return [r["i"] for r in rows]

    assert ids(("c", "books")) == [0]
    assert ids(("n.k", 3)) == [0, 1]
    assert ids(("n.k", "3")) == [2]
    assert ids(("c", True)) == [5]
    assert ids(("c", "tech"), ("n.k", 3)) == [1]
    for bad in ({"should": []}, {"must": [{"key": "a", "range": {"gt": 1}}]}, {"must": [{"key": "a", "match": {"value": 1.5}}]}):
        with pytest.raises(ValueError):
            point_filter.payload_predicate(bad, F.col("payload"))
