"""Streams with keyed state, polls and senders: restarts, replays and crashes."""

import json
import sys
from datetime import datetime

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from test_delivery import Log, numbers, record_requests

from drayage import registry
from drayage.landed import LANDED_COLUMNS, LANDED_SCHEMA, _framed
from drayage.operators.outcomes import record_outcomes
from drayage.outbox import write_batch
from drayage.scratch import delete, make_folder, new_path, path_exists, publish
from drayage.sources.weather import FIRST_OFFSET
from drayage.streaming.keyed import KEY, Newest, newest_stream
from drayage.streaming.pollers import CUT_OFF, polling_stream
from drayage.streaming.readers import latest_polls, weather_stream
from drayage.streaming.senders import sending_stream, sent

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers cannot import tests


def run(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def into(stream, path, checkpoint):
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)


def land(spark, path, *rows):
    """(location, minute of the poll, status, body)"""
    rows = [("weather", k, 0, m and datetime(2024, 10, 1, 0, m), st, b) for k, m, st, b in rows]
    spark.createDataFrame(rows, LANDED_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def timeline(value, *minutes):
    return json.dumps({"timelines": {"minutely": [{"time": f"2024-10-01T00:{m:02}:00Z", "values": {"v": value}} for m in minutes]}})


def test_weather_stream_keeps_the_last_time_of_each_place(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("landed", "out", "checkpoint"))
    make_folder(spark, path)

    def step():
        stream = registry.read_stream(spark, "weather", path=path, locations="[(1, 1), (2.5, 2)]")
        assert stream.columns == ["latitude", "longitude", "weather", "timestamp"]
        run(into(stream, out, checkpoint))
        rows = spark.read.parquet(out).collect()
        return sorted((r.latitude, r.timestamp[14:16], json.loads(r.weather)["v"]) for r in rows)

    # Two polls of one micro-batch overlap, and their rows come in no order: the later poll counts.
    land(spark, path, ("1.0,1.0", 9, 200, timeline("late", 2, 3)), ("1.0,1.0", 5, 200, timeline("early", 1, 2)),
         ("9.0,9.0", 5, 200, timeline("elsewhere", 1)), ("2.5,2.0", 5, 503, "busy"), ("2.5,2.0", None, 200, timeline("a", 4)))
    wanted = [(1.0, "01", "early"), (1.0, "02", "late"), (1.0, "03", "late"), (2.5, "04", "a")]
    assert step() == wanted
    # Old entries come again with other values, a failed poll moves nothing.
    land(spark, path, ("1.0,1.0", 12, 200, timeline("again", 1, 3, 4)), ("2.5,2.0", 12, 500, None))
    wanted = sorted([*wanted, (1.0, "04", "again")])
    assert step() == wanted
    assert step() == wanted
    land(spark, path, ("2.5,2.0", 13, 200, timeline("b", 3, 4, 5)))
    assert step() == sorted([*wanted, (2.5, "05", "b")])


def test_entries_before_the_first_offset_are_old(spark):
    path, out = new_path(spark, "landed"), new_path(spark, "out")
    body = {"timelines": {"hourly": [{"time": t, "values": {}} for t in (FIRST_OFFSET, "2024-09-01T00:00:01Z")]}}
    land(spark, path, ("1.0,1.0", 1, 200, json.dumps(body)))
    run(into(weather_stream(spark, path, "hourly"), out, new_path(spark, "checkpoint")))
    assert [r.timestamp for r in spark.read.parquet(out).collect()] == ["2024-09-01T00:00:01Z"]


def test_forgotten_keys_start_anew(spark):
    path, out, checkpoint = (new_path(spark, n) for n in ("rows", "out", "checkpoint"))
    schema = "k long, t string, polled long, v long"

    def step(*rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(path)
        stream = newest_stream(spark.readStream.schema(schema).parquet(path), "k", "t", "polled", "", forget_after=3600)
        into(stream, out, checkpoint).trigger(once=True).start().awaitTermination()
        return sorted(tuple(r) for r in spark.read.parquet(out).collect())

    first = [(1, "b", 1), (2, "a", 3)]
    assert step((1, "b", 0, 1), (2, "a", 5, 3), (2, "a", 4, 9), (None, "z", 0, 0), (3, None, 0, 0)) == first
    assert step((1, "a", 9, 2), (1, "c", 9, 2)) == sorted([*first, (1, "c", 2)])


class FakeState:
    """What a processor asks of its handle, counted."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


def test_state_is_asked_for_once_for_many_keys():
    newest, state = Newest("t", "polled", ["k", "t", "v"], "", None), FakeState()
    newest.init(state)

    def step(*rows):
        frame = pd.DataFrame([(str(k), k, t, p, v) for k, t, p, v in rows], columns=[KEY, "k", "t", "polled", "v"])
        frames = list(newest.handleInputRows((0,), iter([frame[i : i + 300] for i in range(0, len(frame), 300)]), None))
        return [tuple(r) for frame in frames for r in frame.itertuples(index=False)]

    rows = [(k, t, p, 10 * p) for t in "ba" for p in (1, 2) for k in range(500)]
    assert sorted(step(*rows)) == sorted((k, t, 20) for t in "ab" for k in range(500))
    assert state.calls == 2
    assert step((1, "b", 9, 9), (2, "c", 9, 9), (777, "a", 9, 9)) == [(2, "c", 9), (777, "a", 9)]
    assert step((1, "b", 9, 9), (2, "c", 9, 9)) == [] and state.calls == 5


def test_answers_land_in_frames_of_bounded_size():
    frames = list(_framed((("s", str(i), 0, None, 200, "x" * 10) for i in range(2500)), 1000, 1 << 20))
    assert [len(f) for f in frames] == [1000, 1000, 500] and list(frames[0].columns) == LANDED_COLUMNS
    assert [len(f) for f in _framed((("s", "k", 0, None, 200, "x" * 40) for _ in range(5)), 1000, 80)] == [2, 2, 1]
    assert list(_framed(iter(()))) == []


def test_latest_polls_are_the_same_on_every_run(spark):
    rows = [("k", "t", 2, "x"), ("k", "t", 2, "y"), ("k", "t", 1, "z"), ("k", "u", None, "w")]
    frame = spark.createDataFrame(rows, "key string, time string, polled long, v string")
    assert sorted(map(tuple, latest_polls(frame, "key", "time", "polled").collect())) == [("k", "t", "y"), ("k", "u", "w")]
    assert latest_polls(frame.drop("polled"), "key", "time").where("time = 't'").first()["v"] == "z"


def asked(spark, n=2):
    rows = [(f"{i}.0,0.0", 0) for i in range(n)]
    return spark.createDataFrame(rows, "request_key string, page_no long")


def test_polls_land_once(spark, tmp_path):
    path, checkpoint, log = new_path(spark, "landed"), new_path(spark, "checkpoint"), Log(tmp_path)

    def get(request):
        log(request["request_key"])
        return 200, timeline("x", 1)

    def step():
        run(polling_stream(spark, asked(spark), "weather", get, path, checkpoint))
        return spark.read.schema(LANDED_SCHEMA).parquet(path).groupBy("status").count().collect(), len(log.entries())

    assert step() == ([(200, 2)], 2)
    # The driver dies before its commit: the answers are there, so only the next poll asks.
    delete(spark, f"{checkpoint}/commits/0")
    assert step() == ([(200, 4)], 4)
    # It dies after asking and before landing: nobody is asked again for that poll.
    delete(spark, f"{path}/poll=1")
    delete(spark, f"{checkpoint}/commits/1")
    counts, calls = step()
    assert {r["status"]: r["count"] for r in counts} == {200: 4, 0: 2} and calls == 6
    assert spark.read.schema(LANDED_SCHEMA).parquet(path).where("status = 0").first()["body"] == CUT_OFF


def test_polls_keep_gap_and_quota(spark, tmp_path):
    path, checkpoint, log = new_path(spark, "landed"), new_path(spark, "checkpoint"), Log(tmp_path)

    def get(request):
        log(request["request_key"])
        return 200, "{}"

    for _ in range(4):
        run(polling_stream(spark, asked(spark, 1), "opensky", get, path, checkpoint, gap_seconds=4, daily_quota=3))
    times = [at for at, _ in log.entries()]
    assert len(times) == 3 and min(b - a for a, b in zip(times, times[1:])) >= 3.9


def test_polls_and_streams_by_name(spark):
    path = new_path(spark, "landed")
    state = ["a", "C", "X", 90, 90, 10.0, 50.0] + [None] * 5 + [[1]] + [None] * 4
    get = lambda request: (200, json.dumps({"time": 100, "states": [state]}))
    checkpoint, out, reader = (new_path(spark, n) for n in ("polls", "out", "reader"))
    for _ in range(2):
        run(registry.poll_stream(spark, "opensky", path, checkpoint, get, region="EUROPE", gap_seconds=0))
    stream = registry.read_stream(spark, "opensky", path=path, region="EUROPE", dedupe_within="1 hour")
    run(into(stream, out, reader))
    assert [r.icao24 for r in spark.read.parquet(out).collect()] == ["a"]
    with pytest.raises(ValueError, match="polled"):
        registry.poll_stream(spark, "github", path, checkpoint)


def test_every_record_is_accepted_once(spark, tmp_path):
    outbox, outcomes, checkpoint, log = *(new_path(spark, n) for n in ("outbox", "outcomes", "sender")), Log(tmp_path)

    def send(request):
        if request["attempt"] == 1 and request["batch_id"].endswith("1"):
            return {"status": 503}
        if 4 in numbers(request):
            return {"status": 400, "error": "four"}
        log([request["batch_id"], numbers(request)])
        return {"status": 201}

    def step(*batches):
        for number in batches:
            write_batch(record_requests(spark, 20), outbox, number)
        run(sending_stream(spark, outbox, outcomes, checkpoint, send, base_seconds=0.01))
        return sorted(n for _, (_, taken) in log.entries() for n in taken)

    once = sorted(set(range(20)) - {4})
    assert step(0) == once
    delete(spark, f"{checkpoint}/commits/0")
    assert step(0) == once  # the same micro-batch, and the same outbox batch, again
    assert step(1, 2) == sorted(once * 3)
    found = record_outcomes(spark.read.parquet(outbox).drop("stream_batch"), sent(spark, outcomes))
    assert {r["verdict"]: r["count"] for r in found.groupBy("verdict").count().collect()} == {"accepted": 57, "refused": 3}
    assert path_exists(spark, f"{outcomes}/stream_batch=2")
    with pytest.raises(ValueError, match="no streaming sink"):
        registry.send_stream(spark, "lance", outbox, outcomes, checkpoint, path="x")


def test_a_folder_is_published_once(spark):
    path = f"{new_path(spark, 'published')}/part=1"
    assert publish(spark.range(3), path) and not publish(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    assert spark.read.parquet(path.rpartition("/")[0]).agg(F.max("part")).first()[0] == 1
