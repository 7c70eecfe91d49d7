"""Streams with checkpoints: exact batches, restarts and replays."""

import json

import pytest
from pyspark.sql import functions as F

from drayage import registry
from drayage.landed import LANDED_SCHEMA
from drayage.operators.deliver import deliver
from drayage.operators.outcomes import delivery_stats
from drayage.outbox import write_batch
from drayage.scratch import batch_numbers, new_path
from drayage.sinks import records
from drayage.sources import weather
from drayage.streaming.outboxes import read_outbox
from drayage.streaming.readers import aircraft_stream, incremental_stream, landed_stream, new_file_stream


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def to_memory(spark, stream, name):
    run(stream.writeStream.format("memory").queryName(name).option("checkpointLocation", new_path(spark, "checkpoint")))
    return spark.sql(f"SELECT * FROM {name}")


def test_generator_stream(spark):
    stream = registry.read_stream(spark, "fake")
    query = stream.writeStream.format("memory").queryName("fakes").trigger(once=True).start()
    query.awaitTermination()
    made = spark.sql("SELECT * FROM fakes")
    assert made.count() == 3 and made.columns == ["name", "date", "zipcode", "state"]
    counted = registry.read_stream(spark, "counter", batchSize=4)
    query = counted.writeStream.format("memory").queryName("counted").trigger(once=True).start()
    query.awaitTermination()
    assert sorted(r[0] for r in spark.sql("SELECT value FROM counted").collect()) == [0, 1, 2, 3]
    assert registry.read_stream(spark, "rate", rowsPerSecond=5).isStreaming
    with pytest.raises(ValueError, match="no connector called 'nothing' to stream"):
        registry.read_stream(spark, "nothing")


def land(spark, path, *rows):
    spark.createDataFrame([("s", k, p, None, st, b) for k, p, st, b in rows], LANDED_SCHEMA).write.mode("append").parquet(path)


def state(icao, seconds):
    return [icao, "C", "X", seconds, seconds, 10.0, 50.0] + [None] * 5 + [[1]] + [None] * 4


def test_aircraft_stream(spark):
    path = new_path(spark, "landed")
    land(
        spark, path,
        ("p", 0, 200, json.dumps({"time": 100, "states": [state("a", 90), state("b", 95)]})),
        ("p", 1, 503, "busy"),
        ("p", 2, 200, json.dumps({"time": 110, "states": [state("a", 90), state("b", 105)]})),
    )
    all_states = to_memory(spark, aircraft_stream(landed_stream(spark, path)), "polls")
    assert all_states.count() == 4 and len(all_states.columns) == 18
    once = to_memory(spark, aircraft_stream(landed_stream(spark, path), "EUROPE", "1 hour"), "once")
    assert sorted((r["icao24"], r["last_contact"].second) for r in once.collect()) == [("a", 30), ("b", 35), ("b", 45)]
    assert registry.read_stream(spark, "opensky", path=path, region="EUROPE").isStreaming


def timeline(*minutes):
    entries = [{"time": f"2024-09-01T00:{m:02d}:00Z", "values": {"t": m}} for m in minutes]
    return json.dumps({"timelines": {"minutely": entries}})


def test_weather_stream_resumes_per_location(spark):
    path, out, offsets, checkpoint = (new_path(spark, n) for n in ("landed", "out", "offsets", "checkpoint"))
    first = spark.createDataFrame([("1,1", "2024-09-01T00:01:00Z"), ("2,2", "2024-09-01T00:00:00Z")], "location string, last_time string")

    def step():
        entries = weather.timeline_entries(landed_stream(spark, path), on_error="skip")
        run(incremental_stream(entries, first, "location", "timestamp", out, offsets, checkpoint))
        return sorted((r["location"], r["timestamp"][14:16]) for r in spark.read.parquet(out).collect())

    land(spark, path, ("1,1", 0, 200, timeline(0, 1, 2)), ("2,2", 0, 200, timeline(1)))
    expected = [("1,1", "02"), ("2,2", "01")]
    assert step() == expected
    # Entries at or before the last time seen are old, whether they come again or come late.
    land(spark, path, ("1,1", 1, 200, timeline(1, 2, 3)), ("2,2", 1, 200, timeline(0, 4)), ("3,3", 0, 200, timeline(9)))
    expected = sorted([*expected, ("1,1", "03"), ("2,2", "04"), ("3,3", "09")])
    assert step() == expected
    assert step() == expected
    latest = spark.read.parquet(f"{offsets}/stream_batch={max(batch_numbers(spark, offsets))}")
    assert {r["location"]: r["last_time"][14:16] for r in latest.collect()} == {"1,1": "03", "2,2": "04", "3,3": "09"}


CSV_SCHEMA = "id int, name string, industry string, revenue double"


def test_csv_drops_reach_the_outbox_once(spark):
    path, outbox, checkpoint = (new_path(spark, n) for n in ("csv", "outbox", "checkpoint"))

    def drop(*ids):
        data = [(i, f"name {i}", "x", float(i)) for i in ids]
        spark.createDataFrame(data, CSV_SCHEMA).coalesce(1).write.mode("append").csv(path)

    def step():
        rows = spark.readStream.schema(CSV_SCHEMA).csv(path).selectExpr("name Name", "industry Industry", "revenue AnnualRevenue")
        options = {"instance_url": "https://x", "token": "t"}
        return run(registry.write_stream(rows, "pyspark.datasource.salesforce", outbox, checkpoint, **options))

    drop(1, 2, 3)
    assert step().lastProgress["sources"][0]["numInputRows"] == 3
    drop(4, 5)
    step()
    requests = read_outbox(spark, outbox)
    assert sorted(r["n_records"] for r in requests.collect()) == [2, 3]
    names = [r["Name"] for q in requests.collect() for r in json.loads(q["body"])["records"]]
    assert sorted(names) == [f"name {i}" for i in range(1, 6)]
    sent = deliver(requests, lambda request: {"status": 201}, new_path(spark, "outcomes"))
    assert delivery_stats(requests, sent).first()["succeeded"] == 5


def test_wrong_schema_is_refused_by_the_stream_sink(spark):
    path = new_path(spark, "csv")
    spark.createDataFrame([(1,)], "a int").write.csv(path)
    rows = spark.readStream.schema("Other int").csv(path)
    writer = registry.write_stream(
        rows, "salesforce", new_path(spark, "o"), new_path(spark, "c"), instance_url="https://x", token="t"
    )
    with pytest.raises(Exception, match="mandatory column 'Name'"):
        run(writer)


def test_replayed_batch_leaves_the_outbox_as_it_was(spark):
    path = new_path(spark, "outbox")
    rows = spark.range(500).selectExpr("id", "concat('n', id) Name")
    for attempt in range(2):
        write_batch(records.record_outbox(rows.repartition(2 + attempt), "Account", "id"), path, 7)
    requests = read_outbox(spark, path)
    assert requests.count() == 3 and requests.select("idem_key").distinct().count() == 3
    assert requests.agg(F.sum("n_records")).first()[0] == 500
    # The same rows in the next micro-batch are new requests.
    write_batch(records.record_outbox(rows, "Account", "id"), path, 8)
    assert read_outbox(spark, path).select("idem_key").distinct().count() == 6


def test_only_new_files(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("watched", "out", "checkpoint"))

    def step():
        files = new_file_stream(spark, path, "*.txt").select("path", F.decode("content", "UTF-8").alias("content"))
        run(files.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))
        return sorted(r["content"] for r in spark.read.parquet(out).collect())

    spark.createDataFrame([("one",)], "v string").write.mode("append").text(path)
    assert step() == ["one\n"]
    spark.createDataFrame([("two",)], "v string").write.mode("append").text(path)
    assert step() == ["one\n", "two\n"]
