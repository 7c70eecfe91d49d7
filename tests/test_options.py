"""Connector options: what raises, and with which words."""

import pytest

from drayage import registry
from drayage.options import OptionSpec
from drayage.sources import jdbc
from drayage.sources.weather import parse_locations


@pytest.mark.parametrize(
    ("name", "options", "words"),
    [
        ("github", {}, "path required"),
        ("github", {"path": "a/b", "numPartition": 3}, "unknown option"),
        ("googlesheets", {}, "one of url or path"),
        ("googlesheets", {"url": "https://example.com/x", "path": "id"}, "only one of url, path"),
        ("googlesheets", {"url": "https://example.com/x"}, "not a Google Sheets URL"),
        ("jira", {"url": "u", "username": "n", "token": "t"}, "jql required"),
        ("jsonplaceholder", {"endpoint": "nothing"}, "must be one of: posts"),
        ("notion", {"token": "t"}, "database_id required"),
        ("opensky", {"region": "MOON"}, "must be one of: EUROPE"),
        ("qdrant", {"url": "u"}, "collection required"),
        ("qdrant", {"url": "u", "collection": "c", "limit": 0}, "'limit' must be a positive integer"),
        ("qdrant", {"url": "u", "collection": "c", "filter": "{bad"}, "'filter' must be valid JSON"),
        ("qdrant", {"url": "u", "collection": "c", "filter": "[]"}, "'filter' must be a JSON object"),
        ("robinhood", {}, "path required"),
        ("robinhood", {"path": "BTC"}, "signed"),
        ("stock", {"path": "SPY", "api_key": "k", "function": "HOURLY"}, "is not supported"),
        ("weather", {"locations": "[]", "apikey": "k", "frequency": "yearly"}, "is not supported"),
        ("oracle", {"url": "jdbc:x"}, "one of dbtable or query"),
        ("fake", {"numRows": "-1"}, "positive integer"),
        ("nothing", {}, "no connector called 'nothing'"),
    ],
)
def test_read_options(spark, name, options, words):
    with pytest.raises(ValueError, match=words.replace("(", r"\(")):
        registry.read(spark, name, **options)


@pytest.mark.parametrize(
    ("name", "options", "words"),
    [
        ("meta_capi", {"access_token": "t"}, "pixel_id required"),
        ("meta_capi", {"access_token": "t", "pixel_id": "p", "batch_size": "0"}, "positive integer"),
        ("qdrant", {"url": "u", "collection": "c", "batch_size": "x"}, "positive integer"),
        ("lance", {}, "path required"),
        ("lance", {"path": "p", "mode": "overwrite"}, "only appended to"),
        ("simplejson", {}, "path required"),
        ("salesforce", {"instance_url": "u", "token": "t"}, "does not support batch write"),
        ("sharepoint", {}, "does not support batch write"),
        ("pyspark.datasource.salesforce", {}, "does not support batch write"),
    ],
)
def test_write_options(spark, name, options, words):
    with pytest.raises(ValueError, match=words):
        registry.write(spark.range(1), name, **options)


def test_stream_sink_options(spark):
    rows = spark.readStream.format("rate").load()
    with pytest.raises(ValueError, match="fields required|list_id"):
        registry.write_stream(rows, "sharepoint", "p", "c", site_id="s", token="t")


def test_together_and_flags():
    spec = OptionSpec("x", (), {"on": "YES"}, together=(("username", "key"),), flags=("on",))
    assert spec.check({})["on"] is True
    assert spec.check({"on": "no"})["on"] is False
    with pytest.raises(ValueError, match="must be provided together"):
        spec.check({"username": "me"})


def test_locations():
    assert parse_locations("[(37.7749, -122.4194), (40, -74)]") == [(37.7749, -122.4194), (40.0, -74.0)]
    with pytest.raises(ValueError, match="locations"):
        parse_locations("[1, 2]")


def test_database_options():
    plain = jdbc.read_options("jdbc:x", dbtable="t")
    assert plain == {"url": "jdbc:x", "dbtable": "t"}
    split = jdbc.read_options("jdbc:x", query="select 1", partition_column="id", lower=0, upper=9, partitions=3)
    assert split["dbtable"] == "(select 1) q"
    assert (split["partitionColumn"], split["numPartitions"]) == ("id", "3")
    assert jdbc.read_options("jdbc:x", query="select 1")["query"] == "select 1"
    for bad in ({}, {"dbtable": "t", "query": "q"}, {"dbtable": "t", "partition_column": "id"}):
        with pytest.raises(ValueError):
            jdbc.read_options("jdbc:x", **bad)
    assert jdbc.write_options("jdbc:x", "t")["batchsize"] == "1000"
    with pytest.raises(ValueError, match="dbtable"):
        jdbc.write_options("jdbc:x", "")
