"""The sinks on small fixtures: payloads, requests, files and versions."""

import hashlib
import json
import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Row
from pyspark.sql import functions as F

from drayage.scratch import new_path
from drayage.sinks import events, files, issues, list_items, pages, points, records
from drayage.sinks.versions import VersionConflict, append_version, latest_version, read_version


def event_of(df):
    return [json.loads(r[0]) for r in df.select(events.event_json(df.schema)).collect()]


def test_flat_event(spark):
    df = spark.createDataFrame(
        [("Purchase", "test@example.com", 50.0, 1600000000)], "event_name string, email string, value double, event_time long"
    )
    assert event_of(df) == [
        {
            "event_name": "Purchase",
            "event_time": 1600000000,
            "action_source": "website",
            "user_data": {"em": hashlib.sha256(b"test@example.com").hexdigest()},
            "custom_data": {"value": 50.0},
        }
    ]


def test_struct_event_is_taken_as_it_is(spark):
    df = spark.sql(
        "select 'Lead' event_name, 1L event_time, named_struct('em', 'raw', 'ph', cast(null as string)) user_data, "
        "named_struct('status', 'x') custom_data, 'ignored@x.org' email, 5 value"
    )
    event = event_of(df)[0]
    assert event["user_data"] == {"em": "raw", "ph": None} and event["custom_data"] == {"status": "x"}


def test_event_aliases_and_empty_parts(spark):
    df = spark.createDataFrame(
        [("a", "", "e@x.org", 0, "", "1.2.3.4", "UA", "fb"), ("b", None, None, 7, "app", None, None, None)],
        "event_name string, email string, em string, event_id int, action_source string, ip string, user_agent string, fbc string",
    )
    first, second = event_of(df)
    assert set(first["user_data"]) == {"em", "client_ip_address", "client_user_agent", "fbc"}
    assert "event_id" not in first and first["action_source"] == "website" and "custom_data" not in first
    assert second["event_id"] == "7" and second["action_source"] == "app" and "user_data" not in second
    assert second["event_time"] > 1_700_000_000


def test_events_need_a_name(spark):
    good, bad = events.split_events(spark.range(2))
    assert good.count() == 0 and bad.count() == 2
    assert events.event_outbox(spark.range(2), "p").count() == 0


def test_event_rejects(spark):
    df = spark.createDataFrame([("a", "5"), ("", "5"), (None, "5"), ("b", "x")], "event_name string, event_time string")
    good, bad = events.split_events(df)
    assert good.count() == 1
    assert sorted(r["reject_reason"] for r in bad.collect()) == ["event_name missing"] * 2 + ["event_time unreadable"]


def issue(spark, rows, **options):
    found = issues.issue_outbox(rows, **options).collect()
    return [(r["method"], r["path"], json.loads(r["body"])["fields"]) for r in found]


def test_issue_create(spark):
    df = spark.createDataFrame(
        [Row(summary="New", description="D", project="PROJ", issuetype="Task", key=None)],
        "summary string, description string, project string, issuetype string, key string",
    )
    expected = {"summary": "New", "description": "D", "project": {"key": "PROJ"}, "issuetype": {"name": "Task"}}
    assert issue(spark, df) == [("POST", "/rest/api/2/issue", expected)]
    bare = spark.createDataFrame([("New",)], "summary string")
    assert issue(spark, bare, project="P")[0][2] == {"summary": "New", "project": {"key": "P"}, "issuetype": {"name": "Task"}}


def test_issue_update(spark):
    df = spark.createDataFrame(
        [("PROJ-1", "Updated Summary", "In Progress"), ("PROJ-2", None, "Done")], "key string, summary string, status string"
    )
    assert issue(spark, df) == [("PUT", "/rest/api/2/issue/PROJ-1", {"summary": "Updated Summary"})]


def test_page_create(spark):
    text = '{"Name":{"title":[{"text":{"content":"New Page"}}]}}'
    df = spark.createDataFrame([(text,), ("{}",), ("",), (None,), ("{bad",), ("[1]",)], "properties string")
    made = pages.page_outbox(df, "db").collect()
    assert [json.loads(r["body"]) for r in made] == [{"parent": {"database_id": "db"}, "properties": json.loads(text)}]
    good, bad = pages.split_pages(df)
    assert good.count() + bad.count() == 6


def test_points(spark):
    named = spark.createDataFrame([("p1", [0.5], {"k": "v"})], "id string, vector array<double>, payload map<string,string>")
    body = json.loads(points.point_outbox(named, "c", wait=False).first()["body"])
    assert body == {"points": [{"id": "p1", "vector": [0.5], "payload": {"k": "v"}}]}
    bad = spark.createDataFrame([(1, "{bad-json}")], "id int, vector string")
    with pytest.raises(PySparkException, match="vector"):
        points.point_outbox(bad, "c", "id").collect()


def test_records(spark):
    df = spark.sql(
        "select 'A' Name, 1.5D Revenue, 3 Employees, true Active, timestamp_ntz'2024-01-02 03:04:05' Seen, "
        "date'2024-01-02' Since, cast(null as string) Phone, 2.50BD Price"
    )
    body = json.loads(records.record_outbox(df, "Account").first()["body"])
    assert body == {
        "records": [
            {
                "attributes": {"type": "Account", "referenceId": "ref0"},
                "Name": "A",
                "Revenue": 1.5,
                "Employees": 3,
                "Active": True,
                "Seen": "2024-01-02T03:04:05",
                "Since": "2024-01-02",
                "Price": "2.50",
            }
        ]
    }
    empty = spark.createDataFrame([(None,), ("x",)], "Name string")
    assert records.record_outbox(empty, "Account").first()["n_records"] == 1
    assert len(records.target_schema().fields) == 11 and not records.target_schema()["Name"].nullable


def test_same_rows_give_the_same_outbox(spark):
    df = spark.range(1000).selectExpr("id", "concat('n', id) Name")
    first = records.record_outbox(df.repartition(3), "Account", "id", batch_size=64)
    second = records.record_outbox(df.repartition(8), "Account", "id", batch_size=64)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_list_items(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (2, None)], "n int, s string")
    fields = {"n": "Number", "s": "Title"}
    made = list_items.resource_outbox(df, "list", site_id="s", list_id="l", fields=fields).collect()
    assert sorted(r["body"] for r in made) == ['{"fields":{"Number":1,"Title":"a"}}', '{"fields":{"Number":2}}']
    assert list_items.mapped_records(df, fields).columns == ["Number", "Title"]
    with pytest.raises(ValueError, match="no column missing; theirs are n, s"):
        list_items.resource_outbox(df, "list", site_id="s", list_id="l", fields={"missing": "X"})
    with pytest.raises(ValueError, match="resources are list"):
        list_items.resource_outbox(df, "drive")


def test_copies_are_requests_of_their_own(spark):
    df = spark.range(25_100).select(F.when(F.col("id") < 25_000, "same").otherwise(F.col("id").cast("string")).alias("s"))
    made = list_items.list_item_outbox(df, "s", "l", {"s": "Title"})
    assert made.count() == 25_100 and made.select("idem_key").distinct().count() == 25_100
    again = list_items.list_item_outbox(df.repartition(3), "s", "l", {"s": "Title"})
    assert made.select("idem_key").subtract(again.select("idem_key")).count() == 0
    batches = records.record_outbox(spark.range(1000).select(F.lit("same").alias("Name")), "Account", batch_size=100)
    assert batches.select("idem_key").distinct().count() == 10


def test_resources_can_be_added(spark):
    list_items.register_resource("echo", lambda rows, **options: rows.withColumn("option", F.lit(options["x"])))
    try:
        assert list_items.resource_outbox(spark.range(1), "echo", x="y").first()["option"] == "y"
    finally:
        del list_items.RESOURCES["echo"]


def listing(path):
    folder = path.removeprefix("file://").removeprefix("file:")
    return sorted(n for n in os.listdir(folder) if not n.startswith((".", "_")))


def test_text_overwrite_removes_old_files(spark):
    path = new_path(spark, "text")
    files.write_lines(spark.createDataFrame([("old",)], "v string"), path)
    old = listing(path)
    files.write_lines(spark.createDataFrame([("new",), ("er",)], "v string").coalesce(1), path, "overwrite")
    assert len(listing(path)) == 1 and not set(old) & set(listing(path))
    with pytest.raises(ValueError, match="mode"):
        files.write_lines(spark.range(1), path, "replace")


def test_json_arrays_are_bounded(spark):
    path = new_path(spark, "arrays")
    files.write_json_arrays(spark.range(0, 25, 1, 2).selectExpr("id", "cast(null as string) n"), path, rows_per_file=10)
    folder = path.removeprefix("file://").removeprefix("file:")
    arrays = [json.load(open(f"{folder}/{name}")) for name in listing(path)]
    assert sorted(len(a) for a in arrays) == [2, 3, 10, 10]
    assert sorted(item["id"] for a in arrays for item in a) == list(range(25)) and arrays[0][0]["n"] is None
    assert os.path.exists(f"{folder}/_SUCCESS")


def test_json_lines_totals(spark):
    path = new_path(spark, "lines")
    assert files.write_json_lines(spark.range(17), path) == {"total_count": 17}
    assert spark.read.schema("id long").json(path).count() == 17


def test_versions(spark):
    path = new_path(spark, "versions")
    df = spark.createDataFrame([(1, [0.5, 1.5])], "id long, vector array<double>")
    assert latest_version(spark, path) is None
    assert append_version(df, path, None) == 0
    with pytest.raises(VersionConflict):
        append_version(df, path, None)
    assert append_version(df, path, 0) == 1
    with pytest.raises(VersionConflict):
        append_version(df, path, 0)
    assert read_version(spark, path).count() == 2 and read_version(spark, path, 0).count() == 1
    with pytest.raises(ValueError, match="schema differs"):
        append_version(spark.range(1), path, 1)
    with pytest.raises(ValueError, match="only appended to"):
        append_version(df, path, 1, mode="overwrite")
    with pytest.raises(ValueError, match="no dataset"):
        read_version(spark, new_path(spark, "versions"))


def test_untimed_events_keep_their_keys(spark):
    rows = spark.createDataFrame([("view", "a@now"), ("click", None)], "event_name string, event_id string")
    first = events.event_outbox(rows, "p", "event_name").collect()
    time.sleep(1.1)
    second = events.event_outbox(rows, "p", "event_name").collect()
    assert [r.idem_key for r in first] == [r.idem_key for r in second]
    for r in first:
        assert all(isinstance(e["event_time"], int) for e in json.loads(r.body)["data"])
        assert '"event_id":"a@now"' in r.body


def test_last_version_of_a_point_is_sent(spark):
    rows = spark.createDataFrame(
        [(1, "[1]"), (2, "[2]"), (1, "[3]"), (None, "[4]"), (None, "[4]")], "id long, vector string"
    ).coalesce(1)
    sent = [p for r in points.point_outbox(rows, "c").collect() for p in json.loads(r.body)["points"]]
    assert sorted((p.get("id", 0), p["vector"][0]) for p in sent) == [(0, 4), (0, 4), (1, 3), (2, 2)]
    assert points.point_outbox(rows.limit(0), "c").count() == 0


def test_tree_answers_tell_what_was_accepted():
    assert records.accepted_records('{"hasErrors": false}', 7) == 7
    assert records.accepted_records('{"hasErrors": true, "results": [{"id": "x"}, {"errors": []}]}', 2) == 1
    assert records.accepted_records('{"hasErrors": true}', 2) == 0
