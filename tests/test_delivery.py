"""Delivery to the end: splitting, due times, slots."""

import json
import os
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from drayage.operators.deliver import DeliveryFailed, deliver, open_work, read_outcomes, settle
from drayage.operators.outcomes import delivery_stats, record_outcomes
from drayage.operators.pacing import Pace, lease, queued, slotted
from drayage.outbox import part_body
from drayage.scratch import new_path, stage
from drayage.sinks import records

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the workers cannot import tests


def record_requests(spark, n, batch=10):
    rows = spark.range(n).selectExpr("id AS Number", "concat('ü', id) AS Name")
    return stage(records.record_outbox(rows, "Account", "Number", batch_size=batch), "outbox")


def numbers(request):
    return [r["Number"] for r in json.loads(request["body"])["records"]]


class Log:
    """Who was sent what and when, from any task: a file each."""

    def __init__(self, path):
        self.path = str(path)

    def __call__(self, what):
        with open(f"{self.path}/{time.time():.6f}-{os.getpid()}-{time.monotonic_ns()}", "w") as file:
            json.dump(what, file)

    def entries(self):
        names = sorted(os.listdir(self.path))
        return [(float(n.split("-")[0]), json.load(open(f"{self.path}/{n}"))) for n in names]


def test_part_bodies():
    body = '{"records":[{"a":1},"ü,",{}]}'
    assert part_body(body, 12, [7, 4, 2], [0, 1, 2]) == body
    assert part_body(body, 12, [7, 4, 2], [1]) == '{"records":["ü,"]}'
    assert part_body(body, 12, [7, 4, 2], [0, 2]) == '{"records":[{"a":1},{}]}'


@pytest.mark.parametrize("told", [True, False])
def test_refused_records_stand_alone_and_taken_ones_are_sent_once(spark, tmp_path, told):
    """10 records, 6 refused: told by the answer, or the whole request refused."""
    bad, log = {0, 2, 3, 5, 8, 9}, Log(tmp_path)

    def send(request):
        sent = numbers(request)
        refused = [i for i, n in enumerate(sent) if n in bad]
        if told:
            log([n for n in sent if n not in bad])
            return {"status": 200, "refused": refused, "error": "no" if refused else None}
        if refused:
            return {"status": 400, "error": "no"}
        log(sent)
        return {"status": 201}

    outbox = record_requests(spark, 10)
    path = new_path(spark, "outcomes")
    found = settle(outbox, send, path, 2)
    verdicts = {r.position: r for r in record_outcomes(outbox, found).collect()}
    assert {p for p, r in verdicts.items() if r.verdict == "refused"} == bad and len(verdicts) == 10
    alone = found.where("size(positions) = 1 AND (status >= 400 OR size(refused) = 1)")
    assert sorted(r.positions[0] for r in alone.collect()) == sorted(bad)
    taken = [n for _, what in log.entries() for n in what]
    assert sorted(taken) == sorted(set(range(10)) - bad)
    assert delivery_stats(outbox, found).first()["succeeded"] == 4
    before = found.count()
    assert settle(outbox, send, path, 2).count() == before  # nothing is left open


def test_a_crashed_run_is_taken_up(spark, tmp_path):
    outbox, path, log = record_requests(spark, 40), new_path(spark, "outcomes"), Log(tmp_path)

    def refuse(request):
        if 7 in numbers(request):
            return {"status": 422, "error": "seven"}
        log(numbers(request))
        return {"status": 200}

    deliver(outbox, refuse, path)  # one pass only: the first request is refused as a whole
    settle(outbox, refuse, path)
    assert sorted(n for _, what in log.entries() for n in what) == sorted(set(range(40)) - {7})
    assert [r.position for r in record_outcomes(outbox, read_outcomes(spark, path)).where("verdict = 'refused'").collect()] == [7]


def test_parts_are_sent_with_their_own_records_alone(spark):
    """What is carried from round to round is no larger than the records that are still open."""
    outbox = record_requests(spark, 40, batch=40)
    path = new_path(spark, "outcomes")

    def send(request):
        parts = request.get("positions")
        whole = 40 if parts is None else len(parts)
        assert len(numbers(request)) == request["n_records"] == len(request["sizes"]) == whole
        assert parts is None or numbers(request) == [int(p) for p in parts]
        return {"status": 400, "error": "no"} if 17 in numbers(request) else {"status": 200}

    first = deliver(outbox, send, path)
    work = open_work(outbox, first)
    bodies = work.selectExpr("sum(length(body)) AS n").first().n
    assert work.count() == 2 and bodies < outbox.selectExpr("length(body) AS n").first().n + 40
    second = deliver(outbox, send, path, split=True)
    assert second.where("status = 0").isEmpty()
    assert sorted(len(r.sizes) for r in open_work(outbox, second).collect()) == [10, 10]
    settled = settle(outbox, send, path)
    assert settled.where("status = 0").isEmpty()
    verdicts = record_outcomes(outbox, settled).collect()
    assert [r.position for r in verdicts if r.verdict == "refused"] == [17] and len(verdicts) == 40


def test_counts_without_names_are_final(spark):
    outbox = record_requests(spark, 10)
    found = settle(outbox, lambda request: {"status": 200, "n_accepted": 4}, new_path(spark, "outcomes"))
    assert found.count() == 1 and delivery_stats(outbox, found).first()["failed"] == 6
    whole = outbox.drop("sizes", "head")
    assert settle(whole, lambda request: {"status": 400}, new_path(spark, "outcomes")).count() == 1


def test_nothing_is_sent_before_it_is_due(spark, tmp_path):
    log = Log(tmp_path)

    def send(request):
        log([request["batch_id"], int(request["attempt"])])
        return {"status": 503 if request["attempt"] < 3 else 200}

    found = settle(record_requests(spark, 20), send, new_path(spark, "outcomes"), base_seconds=0.5)
    times = {tuple(what): at for at, what in log.entries()}
    assert len(times) == 6 and found.where("status = 200").count() == 2
    for batch in ("tree-Account-0", "tree-Account-1"):
        assert times[batch, 2] - times[batch, 1] >= 1 and times[batch, 3] - times[batch, 2] >= 2


def test_sends_keep_their_distance(spark, tmp_path):
    log, gap = Log(tmp_path), 0.15

    def send(request):
        number = numbers(request)[0]
        log(number)
        if number % 3 == 0:
            time.sleep(0.7)  # slower than the gap: slots that come too late lapse
        return {"status": 429 if request["attempt"] == 1 and number == 2 else 200}

    outbox = record_requests(spark, 12, batch=1)
    found = settle(outbox, send, new_path(spark, "outcomes"), 3, 0.2, Pace(gap, slack_seconds=0.1, lead_seconds=0.5))
    times = [at for at, _ in log.entries()]
    assert len(times) == 13 and min(b - a for a, b in zip(times, times[1:])) >= gap * 0.98
    assert found.where("status = 200").select("request_key").distinct().count() == 12


def test_leases_follow_due_times_quota_and_days(spark):
    day = 20_000 * 86_400.0
    rows = [(f"k{i:02}", due) for i, due in enumerate([None, None, day + 100, None, day + 100, day + 90])]
    work = spark.createDataFrame(rows, "idem_key string, due double").withColumn("due", F.expr("timestamp_seconds(due)"))
    pace = Pace(4, daily_quota=5, slack_seconds=1)
    found = slotted(queued(work, 5, 2, pace), day, day + 86_400, pace).orderBy("send_at").collect()
    assert [(r.idem_key, r.send_at - day, r.lane) for r in found] == [
        ("k00", 0, 0), ("k01", 5, 1), ("k03", 10, 0), ("k05", 90, 1), ("k02", 100, 0)]
    assert all(r.send_until - r.send_at == 1 for r in found)
    assert slotted(queued(work, 9, 2, pace), day, day + 7, pace).count() == 2  # the rest is for another day
    # With today's quota used up the next slot is at midnight UTC.
    outcomes = spark.range(5).selectExpr("current_timestamp() AS finished_at")
    at = lease(work, outcomes, pace, 2).agg(F.min("send_at")).first()[0]
    assert at % 86_400 == 0 and 0 < at - time.time() <= 86_400
    soon = lease(work, outcomes.limit(2), pace, 2)
    assert soon.count() == 3 and soon.agg(F.min("send_at")).first()[0] - time.time() > 1
    for wrong in ({"gap_seconds": 0}, {"gap_seconds": 1, "daily_quota": 0}, {"gap_seconds": 1, "slack_seconds": 0}):
        with pytest.raises(ValueError):
            Pace(**wrong)


def test_a_pace_no_task_can_keep_ends(spark):
    outbox = record_requests(spark, 3)
    with pytest.raises(DeliveryFailed, match="too little time"):
        settle(outbox, lambda r: {"status": 200}, new_path(spark, "o"), 2, pace=Pace(0.1, slack_seconds=1e-6, lead_seconds=-9))


def test_refused_records_of_an_answer():
    body = json.dumps({"records": [{"attributes": {"referenceId": f"ref{n}"}} for n in (4, 5, 6)]})
    told = lambda **answer: records.refused_records(json.dumps(answer), {"body": body})
    assert told(hasErrors=False) == [] and told() == [0, 1, 2]
    assert told(hasErrors=True, results=[{"id": 1}, {"errors": []}, {"id": 2}]) == [1]
    assert told(hasErrors=True, results=[{"id": 1, "referenceId": "ref6"}, {"referenceId": "ref4"}]) == [0, 1]
