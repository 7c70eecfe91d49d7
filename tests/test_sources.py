"""The readers on small fixtures, through Spark."""

import json
import os

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from drayage import registry
from drayage.landed import append, bodies, failures, fetch, fetch_chain, read_landed
from drayage.scratch import new_path
from drayage.streaming.readers import landed_stream
from drayage.sources import aircraft, files, generate, market, pages, points, rest_demo, tracker, weather


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_issues(landed):
    full = {
        "key": "PROJ-1",
        "fields": {
            "summary": "Issue 1", "status": {"name": "Open"}, "description": "Desc", "created": "2023-01-01",
            "updated": "2023-01-02", "assignee": {"displayName": "User A"}, "reporter": {"displayName": "User B"},
            "priority": {"name": "High"}, "issuetype": {"name": "Bug"}, "project": {"key": "PROJ"},
        },
    }
    partial = {"key": "PROJ-2", "fields": {**full["fields"], "assignee": None}}
    del partial["fields"]["status"]
    found = tracker.issues(landed(json.dumps({"issues": [full, partial]}))).orderBy("key").collect()
    assert tuple(found[0]) == (
        "PROJ-1", "Issue 1", "Open", "Desc", "2023-01-01", "2023-01-02", "User A", "User B", "High", "Bug", "PROJ",
    )
    assert found[1]["status"] is None and found[1]["assignee"] is None and found[1]["priority"] == "High"


def test_pulls_with_missing_user(landed):
    body = json.dumps([{"number": 1, "title": "t", "user": {"login": "me"}}, {"number": 2, "user": None}])
    assert rows(tracker.pull_requests(landed(body))) == [(1, "t", "me", None, None), (2, None, None, None, None)]


def test_failed_response_raises_or_is_skipped(landed):
    answers = landed(("a", 0, 200, "[]"), ("b", 0, 500, "oops"), ("c", 0, 200, "{bad"), ("d", 0, None, None))
    with pytest.raises(PySparkException, match="request [bd] failed with status (500|unknown)"):
        bodies(answers).collect()
    assert [r["request_key"] for r in bodies(answers, "skip").collect()] == ["a"]
    assert [r["request_key"] for r in failures(answers).collect()] == ["b", "c", "d"]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        tracker.pull_requests(landed("{bad")).collect()
    with pytest.raises(ValueError, match="on_error"):
        bodies(answers, "ignore")


def test_landed_table_is_pruned(spark, landed):
    path = new_path(spark, "landed")
    day = F.lit("2024-05-01 10:00:00").cast("timestamp")
    append(landed("[1]").withColumn("source", F.lit("a")).withColumn("fetched_at", day), path)
    append(landed("[2]", "[3]").withColumn("source", F.lit("b")).withColumn("fetched_at", day), path)
    append(landed("[4]").withColumn("source", F.lit("b")).withColumn("fetched_at", F.expr("timestamp'2024-05-02'")), path)
    assert read_landed(spark, path).count() == 4
    late = read_landed(spark, path, "b", since="2024-05-02")
    assert rows(late.select("source", "body")) == [("b", "[4]")]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan
    streamed = landed_stream(spark, path)
    assert streamed.columns == late.columns


def test_database_pages(landed):
    page = {
        "id": "page1", "created_time": "2023-01-01T00:00:00.000Z", "last_edited_time": "2023-01-02T00:00:00.000Z",
        "url": "https://x/page1",
        "properties": {
            "Status": {"type": "select", "select": {"name": "Done"}},
            "Name": {"type": "title", "title": [{"plain_text": "Test Page 1"}]},
        },
    }
    bare = {"id": "page2", "properties": {}}
    untitled = {"id": "page3", "properties": {"Name": {"type": "title", "title": []}}}
    body = json.dumps({"results": [page, bare, untitled], "has_more": False})
    found = pages.database_pages(landed(body)).orderBy("id").collect()
    assert [r["title"] for r in found] == ["Test Page 1", "", ""]
    assert "Status" in json.loads(found[0]["properties"]) and json.loads(found[1]["properties"]) == {}
    assert str(found[0]["last_edited_time"]) == "2023-01-02 00:00:00" and found[1]["created_time"] is None


def test_points(landed):
    first = {"id": 1, "vector": [0.1, 0.2], "payload": {"category": "books"}, "order_value": 10}
    second = {"id": "2", "vector": {"default": [0.3, 0.4]}, "payload": {"category": "tech"}, "shard_key": "tenant-1"}
    answers = landed(
        json.dumps({"result": {"points": [first], "next_page_offset": 1}}),
        json.dumps({"result": {"points": [second], "next_page_offset": None}}),
    )
    found = points.points(answers).orderBy("id").collect()
    assert found[0] == Row(id="1", vector="[0.1,0.2]", payload='{"category":"books"}', shard_key=None, order_value=10)
    assert json.loads(found[1]["vector"]) == {"default": [0.3, 0.4]} and found[1]["shard_key"] == "tenant-1"
    assert points.typed_points(points.points(answers)).where("id = '1'").first()["vector"][0] == pytest.approx(0.1)
    bare = points.points(answers, with_payload=False, with_vector=False).first()
    assert bare["vector"] is None and bare["payload"] is None
    tech = {"must": [{"key": "category", "match": {"value": "tech"}}]}
    assert [r["id"] for r in points.points(answers, condition=tech).collect()] == ["2"]
    assert [r["next_offset"] for r in points.scroll_pages(answers).orderBy("page_no").collect()] == ["1", None]


def test_rest_endpoints(landed):
    user = {"id": 1, "name": "n", "address": {"street": "s", "geo": {"lat": "1", "lng": "2"}}, "company": {"bs": "b"}}
    found = rest_demo.rest_rows(landed(json.dumps([user, {"id": 2}])), "users").orderBy("id").collect()
    assert found[0]["address_geo_lat"] == "1" and found[0]["company_bs"] == "b" and found[0]["phone"] == ""
    assert found[1]["address_street"] == "" and len(found[0]) == 15
    post = rest_demo.rest_rows(landed(json.dumps({"userId": 1, "id": 5, "title": "t", "body": "b"})), "posts")
    assert rows(post) == [(1, 5, "t", "b")]
    todos = rest_demo.rest_rows(landed('[{"userId":1,"id":1,"completed":true},{"id":2}]'), "todos")
    assert rows(todos) == [(1, 1, "", True), (None, 2, "", False)]
    assert rows(rest_demo.by_id(todos, 2)) == [(None, 2, "", False)]
    photo = rest_demo.rest_rows(landed('[{"albumId":1,"id":1,"url":"u"}]'), "photos")
    assert rows(photo) == [(1, 1, "", "u", "")]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        rest_demo.rest_rows(landed("7"), "posts").collect()
    with pytest.raises(ValueError, match="unknown endpoint"):
        rest_demo.endpoint_schema("nothing")


def test_quotes(landed):
    quote = {"price": "1.5", "bid_inclusive_of_sell_spread": "", "ask_inclusive_of_buy_spread": "x", "timestamp": "t"}
    answers = landed(("BTC-USD", 0, 200, json.dumps({"results": [quote, {}]})), ("ETH-USD", 0, 500, "busy"))
    assert rows(market.quotes(answers)) == [("BTC-USD", 1.5, 0.0, 0.0, "t"), ("BTC-USD", 0.0, 0.0, 0.0, "")]
    asked = answers.select(F.col("request_key").alias("symbol"))
    assert rows(market.unanswered(asked, answers)) == [("ETH-USD",)]


def test_price_bars(landed):
    bar = {"1. open": "1.0", "2. high": "4.0", "3. low": "0.5", "4. close": "2.0", "5. volume": "33898396"}
    later = {**bar, "1. open": "9.0", "4. close": "3.0"}
    body = json.dumps({"Meta Data": {"2. Symbol": "SPY"}, "Time Series (Daily)": {"2024-06-04": later, "2024-06-03": bar}})
    bars = market.price_bars(landed(("SPY", 0, 200, body)))
    assert ("2024-06-03", 1.0, 4.0, 0.5, 2.0, 33898396, "SPY") in rows(bars) and bars.count() == 2
    assert rows(market.rollup_bars(bars, "week")) == [("2024-06-04", 1.0, 4.0, 0.5, 3.0, 2 * 33898396, "SPY")]
    with pytest.raises(ValueError):
        market.rollup_bars(bars, "year")


def test_aircraft(landed):
    state = ["abc123", "CALL  ", "X", 1700000000, 1700000001, 10.0, 50.0, 100, True, 1.5, 90, None, [1, 2], 99.5, "7700", False, 3]
    unplaced = [*state[:5], None, *state[6:]]
    no_time = [*state[:3], None, *state[4:]]
    body = json.dumps({"time": 1700000005, "states": [state, state[:16], unplaced, no_time]})
    found = aircraft.aircraft_states(landed(body)).collect()
    assert len(found) == 2 and len(found[0]) == 18
    assert str(found[0]["time_ingest"]) == "2023-11-14 22:13:25" and found[0]["sensors"] == [1, 2]
    assert found[0]["on_ground"] is True and found[0]["spi"] is False and found[0]["category"] == 3
    assert found[0]["vertical_rate"] is None and found[1]["time_position"] is None
    assert aircraft.aircraft_states(landed(body), "EUROPE").count() == 2
    assert aircraft.aircraft_states(landed(body), "australia").count() == 0
    assert aircraft.aircraft_states(landed('{"time":1,"states":null}')).count() == 0
    assert aircraft.aircraft_states(landed(body)).schema.simpleString() == "struct<" + ",".join(
        f.replace(" ", ":") for f in aircraft.SCHEMA.split(", ")
    ) + ">"


def test_weather(spark, landed):
    entry = [{"time": f"2024-09-01T00:0{m}:00Z", "values": {"temperature": m}} for m in range(3)]
    locations = weather.location_frame(spark, "[(1.5, -2)]")
    answers = landed(("1.5,-2.0", 0, 200, json.dumps({"timelines": {"minutely": entry}})))
    entries = weather.timeline_entries(answers)
    assert rows(entries.orderBy("timestamp"))[1] == ("1.5,-2.0", 1.5, -2.0, '{"temperature":1}', "2024-09-01T00:01:00Z")
    start = weather.initial_offsets(locations)
    fresh = weather.newer_than(entries, start, "location", "timestamp")
    assert sorted(r["timestamp"] for r in fresh.collect()) == ["2024-09-01T00:01:00Z", "2024-09-01T00:02:00Z"]
    moved = weather.next_offsets(entries, start, "location", "timestamp")
    assert rows(moved) == [("1.5,-2.0", "2024-09-01T00:02:00Z")]
    assert rows(weather.next_offsets(entries.limit(0), moved, "location", "timestamp")) == rows(moved)
    assert weather.timeline_entries(answers, "hourly").count() == 0


def csv_file(spark, *lines):
    path = new_path(spark, "sheet")
    text = "\n".join(lines)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    return path


def test_sheets(spark):
    path = csv_file(spark, "num,name", "1,a", "2,b")
    assert files.read_sheet(spark, path).schema.simpleString() == "struct<num:string,name:string>"
    typed = files.read_sheet(spark, path, "a double, b string")
    assert rows(typed.orderBy("a")) == [(1.0, "a"), (2.0, "b")]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        files.read_sheet(spark, path, "a double").collect()
    assert rows(files.read_sheet(spark, csv_file(spark, '"",1,""', "a,b,c")))[0] == ("a", "b", "c")
    assert files.read_sheet(spark, csv_file(spark, '"",1,""', "a,b,c")).columns == ["Unnamed: 0", "1", "Unnamed: 2"]
    assert files.read_sheet(spark, csv_file(spark, "a,a", "1,2")).columns == ["a", "a.1"]
    raw = files.read_sheet(spark, csv_file(spark, "1,2,3", "4,5,6"), "a int, b int, c int", has_header=False)
    assert raw.count() == 2
    with pytest.raises(ValueError, match="needs a schema"):
        files.read_sheet(spark, path, has_header=False)
    with pytest.raises(ValueError, match="no header"):
        files.read_sheet(spark, csv_file(spark, ""))


def test_lines(spark):
    path = new_path(spark, "lines")
    df = spark.createDataFrame([("line1\r",), ("line2",)], "value string").coalesce(1)
    df.write.text(path)
    df.write.text(f"{path}/inner/deeper")
    assert sorted(rows(files.read_lines(spark, path))) == [("line1",), ("line2",)]
    assert files.read_lines(spark, path, recursive=True).count() == 4
    assert files.read_lines(spark, path, recursive=True, pattern="*.csv").count() == 0
    with pytest.raises(PySparkException, match="PATH_NOT_FOUND"):
        files.read_lines(spark, f"{path}/nowhere")


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def write_ipc(path, table, rows_per_batch=None):
    with pa.OSFile(path, "wb") as sink, pa.ipc.new_file(sink, table.schema) as out:
        out.write_table(table, max_chunksize=rows_per_batch)


@pytest.fixture
def arrow_folder(spark, tmp_path):
    write_ipc(f"{tmp_path}/b.arrow", pa.table({"id": [3, 4], "name": ["Charlie", "Diana"], "department": ["M", "HR"]}))
    write_ipc(f"{tmp_path}/a.arrow", pa.table({"id": [1, 2], "name": ["Alice", "Bob"], "department": ["E", "S"]}))
    (tmp_path / "notes.txt").write_text("not arrow")
    return str(tmp_path)


def test_arrow_folder(spark, arrow_folder):
    df = registry.read(spark, "arrow", path=arrow_folder)
    assert df.rdd.getNumPartitions() == 2
    assert {r["name"] for r in df.collect()} == {"Alice", "Bob", "Charlie", "Diana"}
    assert df.schema.simpleString() == "struct<id:bigint,name:string,department:string>"
    single = spark.read.format("arrow").load(f"{arrow_folder}/a.arrow")
    assert single.first()["name"] == "Alice" and single.count() == 2
    assert spark.read.format("arrow").load(f"{arrow_folder}/[ab].arrow").count() == 4
    assert df.filter(df.id > 1).groupBy("department").count().count() == 3


def test_arrow_errors(spark, arrow_folder):
    with pytest.raises(PySparkException, match="no Arrow file"):
        spark.read.format("arrow").load(f"{arrow_folder}/*.feather").collect()
    with pytest.raises(PySparkException, match="option path"):
        spark.read.format("arrow").load().collect()
    with pytest.raises(PySparkException, match="notes.txt"):
        spark.read.schema("id long").format("arrow").load(f"{arrow_folder}/notes.txt").collect()


def test_arrow_splits_large_files(spark, tmp_path):
    write_ipc(f"{tmp_path}/big.arrow", pa.table({"id": list(range(1000))}), rows_per_batch=100)
    df = registry.read(spark, "arrow", path=str(tmp_path), splitBytes=2000)
    assert df.rdd.getNumPartitions() > 3
    assert sorted(r[0] for r in df.collect()) == list(range(1000))


def test_arrow_write_modes(spark):
    path = new_path(spark, "arrow")
    df = spark.range(10).selectExpr("id", "timestamp_ntz'2024-01-01' t", "array(id) a", "named_struct('x', id) s")
    registry.write(df, "arrow", path=path)
    registry.write(df, "arrow", path=path)
    assert registry.read(spark, "arrow", path=path).count() == 20
    registry.write(df.limit(3), "arrow", path=path, mode="overwrite")
    back = registry.read(spark, "arrow", path=path)
    assert back.count() == 3 and back.schema == df.schema
    registry.write(df.limit(0), "arrow", path=path, mode="overwrite")
    assert registry.read(spark, "arrow", path=path).count() == 0


def test_arrow_abort_leaves_nothing(spark):
    path = new_path(spark, "arrow")
    registry.write(spark.range(5), "arrow", path=path)
    bad = spark.range(0, 100, 1, 4).selectExpr("if(id = 99, raise_error('no'), id) id").selectExpr("cast(id as long) id")
    with pytest.raises(PySparkException):
        registry.write(bad, "arrow", path=path, mode="overwrite")
    assert registry.read(spark, "arrow", path=path).count() == 5
    # A task killed late may leave its staging folder, which is never read.
    assert all(n.endswith((".arrow", ".arrow.crc")) or n == "_log" or n.startswith("_staging-") for n in os.listdir(local(path)))


def test_generator(spark):
    df = registry.read(spark, "fake")
    assert df.columns == ["name", "date", "zipcode", "state"] and df.count() == 3
    wide = registry.read(spark, "fake", numRows="50", schema=", ".join(f"{p} string" for p in generate.PROVIDERS))
    assert wide.where(" or ".join(f"{p} is null or {p} = ''" for p in generate.PROVIDERS)).count() == 0
    assert wide.count() == 50 and wide.select("name").distinct().count() > 30
    one, many = generate.generate(spark, 100, partitions=1), generate.generate(spark, 100, partitions=7)
    assert sorted(rows(one)) == sorted(rows(many)) and many.rdd.getNumPartitions() == 7
    assert sorted(rows(generate.generate(spark, 100, seed=1))) != sorted(rows(one))
    with pytest.raises(ValueError, match="`nonsense`"):
        generate.generate(spark, 1, "nonsense string")
    with pytest.raises(ValueError, match="must be a string column"):
        generate.generate(spark, 1, "name int")


def test_fetch(spark):
    requests = spark.createDataFrame([(f"k{i}", i) for i in range(5)], "request_key string, page_no long")
    landed = fetch(requests, "src", lambda request: (200 + int(request["page_no"]), request["request_key"] * 2), 3)
    assert sorted((r["request_key"], r["page_no"], r["status"], r["body"]) for r in landed.collect()) == [
        (f"k{i}", i, 200 + i, f"k{i}" * 2) for i in range(5)
    ]


def test_fetch_chain_follows_to_the_end(spark):
    starts = spark.createDataFrame([("a", 0, 3), ("b", 0, 1)], "request_key string, page_no long, left int")

    def follow(request, status, body):
        return {**request, "left": request["left"] - 1} if request["left"] > 1 else None

    landed = fetch_chain(starts, "src", lambda request: (200, str(request["left"])), follow)
    assert sorted((r["request_key"], r["page_no"], r["body"]) for r in landed.collect()) == [
        ("a", 0, "3"), ("a", 1, "2"), ("a", 2, "1"), ("b", 0, "1"),
    ]


def test_files_with_line_breaks_do_not_grow_with_the_table(spark):
    from catalog.files import messy_texts

    path = new_path(spark, "csv")
    messy_texts(spark, "/root/testdata/sf0.1", "number", path, ";")
    found = files.read_dataset_csv(spark, path, {"sep": "';'"})
    rows = found.groupBy(F.input_file_name()).count().collect()
    assert sum(r["count"] for r in rows) == 10_000 and max(r["count"] for r in rows) <= 2000
