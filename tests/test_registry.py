"""Whole reads and writes by connector name, with functions in place of the network."""

import json

import pytest
from pyspark.sql import functions as F

from drayage import registry
from drayage.operators.deliver import DeliveryFailed
from drayage.plans.paging import missing_pages
from drayage.scratch import new_path


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_github_reads_all_pages(spark):
    def get(request):
        page = int(request["url"].rsplit("=", 1)[1])
        count = 100 if page < 3 else 20
        return 200, json.dumps([{"number": page * 1000 + i, "title": "t"} for i in range(count)])

    df = registry.read(spark, "github", get=get, path="owner/repo")
    assert df.count() == 220 and df.agg(F.max("id")).first()[0] == 3019


def test_jira_pages_are_separate_requests(spark):
    total = 120

    def get(request):
        start, most = (int(request["url"].split(f"{n}=")[1].split("&")[0]) for n in ("startAt", "maxResults"))
        assert "jql=project+%3D+X" in request["url"] and request["page_no"] == start // 50
        found = range(start, min(start + most, total))
        return 200, json.dumps({"total": total, "issues": [{"key": f"X-{i}", "fields": {"summary": "s"}} for i in found]})

    options = {"url": "https://j/", "username": "u", "token": "t", "jql": "project = X"}
    df = registry.read(spark, "jira", get=get, **options)
    assert df.count() == total and df.select("key").distinct().count() == total
    nothing = registry.read(spark, "jira", get=lambda request: (200, '{"total": 0, "issues": []}'), **options)
    assert nothing.count() == 0


def test_qdrant_scrolls(spark):
    def get(request):
        asked = json.loads(request["body"])
        offset = asked.get("offset", 0)
        assert asked["limit"] == 2 and asked["filter"] == {"must": []}
        following = offset + 2 if offset < 4 else None
        points = [{"id": offset + i, "vector": [0.5], "payload": {"a": 1}} for i in range(2)]
        return 200, json.dumps({"result": {"points": points, "next_page_offset": following}})

    df = registry.read(spark, "qdrant", get=get, url="http://q/", collection="c", limit="2", filter='{"must": []}')
    assert [r[0] for r in rows(df.select("id"))] == ["0", "1", "2", "3", "4", "5"]


def test_notion_follows_the_cursor(spark):
    def get(request):
        cursor = json.loads(request["body"]).get("start_cursor")
        more = cursor is None
        return 200, json.dumps({"results": [{"id": cursor or "p0"}], "has_more": more, "next_cursor": "p1"})

    df = registry.read(spark, "notion", get=get, token="t", database_id="d")
    assert [r[0] for r in rows(df.select("id"))] == ["p0", "p1"]


def test_rest_demo(spark):
    def get(request):
        assert request["url"] == "https://jsonplaceholder.typicode.com/posts/7"
        return 200, json.dumps({"userId": 1, "id": 7})

    assert rows(registry.read(spark, "jsonplaceholder", get=get, id="7", limit="3")) == [(1, 7, "", "")]


def test_symbols_are_separate_requests(spark):
    def get(request):
        bar = {"1. open": "1", "2. high": "1", "3. low": "1", "4. close": "1", "5. volume": "5"}
        return 200, json.dumps({"Meta Data": {}, "Weekly Time Series": {"2024-01-05": bar}})

    df = registry.read(spark, "stock", get=get, path="SPY, QQQ", api_key="k", function="TIME_SERIES_WEEKLY")
    assert [r[0] for r in rows(df.select("symbol"))] == ["QQQ", "SPY"]

    def quote(request):
        if "ETH" in request["url"]:
            return 500, "busy"
        return 200, json.dumps({"results": [{"price": "2"}]})

    df = registry.read(spark, "robinhood", get=quote, path="btc, eth,")
    assert rows(df) == [("BTC-USD", 2.0, 0.0, 0.0, "")]


def test_weather_and_aircraft(spark):
    def forecast(request):
        assert request["url"].endswith("location=1.0,2.0")
        return 200, json.dumps({"timelines": {"daily": [{"time": "2024-09-02T00:00:00Z", "values": {}}]}})

    df = registry.read(spark, "weather", get=forecast, locations="[(1, 2)]", apikey="k", frequency="daily")
    assert df.count() == 1

    def states(request):
        assert "lamin=35.0&lamax=72.0&lomin=-25.0&lomax=45.0" in request["url"]
        return 200, json.dumps({"time": 1, "states": [["a", "b", "c", 1, 1, 10.0, 50.0] + [None] * 10]})

    assert registry.read(spark, "opensky", get=states, region="EUROPE").count() == 1


def test_sheet(spark):
    def get(request):
        assert request["url"] == "https://docs.google.com/spreadsheets/d/abc/gviz/tq?tqx=out%3Acsv&gid=5"
        return 200, '"num","name"\n"1","a, b"\n"2","c"\n'

    url = "https://docs.google.com/spreadsheets/d/abc/edit?gid=5#gid=5"
    df = registry.read(spark, "googlesheets", get=get, url=url)
    assert df.columns == ["num", "name"] and ("1", "a, b") in rows(df)
    typed = registry.read(spark, "googlesheets", get=get, path="abc", sheet_id="5", schema="n double, s string")
    assert (2.0, "c") in rows(typed)


def test_failed_read_raises(spark):
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException, match="failed with status 404"):
        registry.read(spark, "github", get=lambda request: (404, "not found"), path="a/b").collect()


def test_listing_is_not_cut_short_unasked(spark):
    def get(request):
        page = int(request["url"].rsplit("=", 1)[1])
        return (200, json.dumps([{"number": i} for i in range(100)])) if page == 1 else (404, "gone")

    with pytest.raises(ValueError, match="page after page"):
        registry.read(spark, "github", get=get, on_error="skip", path="a/b")
    assert registry.read(spark, "github", get=get, on_error="incomplete", path="a/b").count() == 100


def test_failed_answers_can_be_skipped(spark):
    def get(request):
        return (200, json.dumps({"X": {}})) if request["request_key"] == "A" else (429, "slow down")

    options = {"path": "A,B", "api_key": "k", "get": get}
    assert registry.read(spark, "stock", on_error="skip", **options).count() == 0
    with pytest.raises(Exception, match="request B failed with status 429"):
        registry.read(spark, "stock", **options).collect()


def test_http_functions(monkeypatch):
    import requests

    from drayage import wire

    seen = []

    class Answer:
        status_code, text, ok = 200, "body", True

    def request(method, url, **rest):
        seen.append((method, url, rest))
        return Answer()

    monkeypatch.setattr(requests, "request", request)
    get = wire.http_get({"Accept": "x", **wire.bearer("t")}, {"apikey": "k"})
    assert get({"url": "https://x/a", "body": None}) == (200, "body")
    assert get({"url": "https://x/a", "body": "{}"}) == (200, "body")
    send = wire.http_send("https://x/", wire.basic_auth("u", "p"))
    assert send({"method": "PUT", "path": "/a", "body": "ü"}) == {"status": 200, "error": None}
    Answer.ok, Answer.status_code = False, 500
    assert send({"method": "PUT", "path": "/a", "body": ""}) == {"status": 500, "error": "body"}
    assert [(m, u) for m, u, _ in seen[:3]] == [("GET", "https://x/a"), ("POST", "https://x/a"), ("PUT", "https://x/a")]
    assert seen[0][2]["headers"] == {"Accept": "x", "Authorization": "Bearer t"}
    assert seen[0][2]["params"] == {"apikey": "k"} and seen[0][2]["timeout"] == 30
    assert seen[1][2]["headers"]["Content-Type"] == "application/json"
    assert seen[2][2]["headers"]["Authorization"] == "Basic dTpw" and seen[2][2]["data"] == "ü".encode()


def test_files_by_name(spark):
    lines, arrays, vectors = (new_path(spark, n) for n in ("lines", "arrays", "vectors"))
    df = spark.createDataFrame([("a",), ("b",)], "value string")
    registry.write(df, "sftp", path=lines)
    registry.write(df, "sftp", path=lines, mode="overwrite")
    assert rows(registry.read(spark, "sftp", path=lines)) == [("a",), ("b",)]
    registry.write(df, "simplejson", path=arrays, rows_per_file=1)
    assert rows(spark.read.json(arrays, multiLine=True)) == [("a",), ("b",)]
    registry.write(df, "lance", path=vectors)
    registry.write(df, "lance", path=vectors)
    assert registry.read(spark, "lance", path=vectors).count() == 4
    assert registry.read(spark, "lance", path=vectors, version="0").count() == 2


def test_points_are_sent_in_batches(spark):
    df = spark.createDataFrame(
        [
            (1, "[0.1,0.2]", '{"category":"books"}', None),
            (2, "[0.3]", None, "tenant-1"),
            (3, '{"default":[0.5]}', "null", None),
        ],
        "id long, vector string, payload string, shard_key string",
    )
    def send(request):
        points = json.loads(request["body"])["points"]
        assert request["method"] == "PUT" and request["path"] == "/collections/c/points?wait=true"
        assert len(points) == request["n_records"]
        for point in points:
            assert set(point) == {1: {"id", "vector", "payload"}, 2: {"id", "vector", "shard_key"}, 3: {"id", "vector"}}[point["id"]]
        return {"status": 200}

    stats = registry.write(df, "qdrant", send=send, url="http://q", collection="c", batch_size=2).first()
    assert stats.asDict() == {"processed": 3, "succeeded": 3, "failed": 0, "pending": 0}


def test_event_batches_do_not_fail_the_job(spark):
    df = spark.range(2500).selectExpr("'Purchase' event_name", "id event_id", "1600000000L event_time")

    def send(request):
        assert json.loads(request["body"])["test_event_code"] == "T"
        if request["batch_id"].endswith("-1"):
            raise TimeoutError("slow")
        return {"status": 200}

    options = {"access_token": "secret", "pixel_id": "p", "test_event_code": "T"}
    stats = registry.write(df, "meta_capi", send=send, **options).first()
    assert (stats["processed"], stats["succeeded"], stats["failed"]) == (2500, 1500, 1000)


def test_a_repeated_write_sends_only_the_rest(spark):
    df = spark.range(500).selectExpr("'Purchase' event_name", "id event_id", "1600000000L event_time")
    path = new_path(spark, "outcomes")
    options = {"access_token": "t", "pixel_id": "p", "batch_size": 100, "outcomes_path": path}

    def first(request):
        return {"status": 200 if request["batch_id"] in ("events-p-0", "events-p-1") else 500}

    def second(request):
        return {"status": 200 if request["batch_id"] not in ("events-p-0", "events-p-1") else 400}

    assert registry.write(df.repartition(3), "meta_capi", send=first, **options).first()["succeeded"] == 200
    assert registry.write(df.repartition(5), "meta_capi", send=second, **options).first()["succeeded"] == 500
    with pytest.raises(DeliveryFailed):
        registry.write(df, "meta_capi", send=lambda r: {"status": 400}, fail_fast=True, access_token="t", pixel_id="p")


def test_secrets_stay_out_of_the_tables(spark):
    df = spark.createDataFrame([("Purchase",)], "event_name string")
    given = registry._check(registry.WRITE_OPTIONS, "write", "meta_capi", {"access_token": "secret", "pixel_id": "p"})
    assert "secret" not in str(registry.build_outbox(df, "meta_capi", given).collect())

    def get(request):
        return 200, json.dumps({"Meta Data": {}, "X": {}})

    plan = registry._PLANS["stock"](spark, {"path": "SPY", "api_key": "secret", "function": "TIME_SERIES_DAILY"})
    assert "secret" not in str(plan.requests.collect())
    assert registry.read(spark, "stock", get=get, path="SPY", api_key="secret").count() == 0


def test_landed_gaps_show(spark):
    pages = spark.createDataFrame([("d", 0, True), ("d", 2, False)], "request_key string, page_no long, has_more boolean")
    assert rows(missing_pages(pages)) == [("d", 1)]
