"""Batching, joins, rejects, routing and delivery against brute force on small frames."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.operators import outcomes
from drayage.operators.batching import batch_assign, collect_batches, dense_index, orderable
from drayage.operators.contract import ColumnRule, check_against, contract_report
from drayage.operators.deliver import DeliveryFailed, deliver, read_outcomes
from drayage.operators.joins import hot_keys, is_bounded, join_keyed
from drayage.operators.rejects import apply_rules, split_valid
from drayage.operators.upsert import last_per_key, route_create_update
from drayage.scratch import new_path


def test_dense_index_follows_the_order(spark):
    keys = list(range(1000))
    random.Random(1).shuffle(keys)
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(7)
    assert dense_index(df, "k").where("idx <> k").count() == 0


@pytest.fixture
def full_partitions(spark):
    """No merging of small partitions, as if data filled them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_dense_index_spreads_a_hot_key(spark, full_partitions):
    df = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") < 20_000, 0).otherwise(F.col("id")).alias("k"))
    indexed = dense_index(df, "k")
    assert indexed.select("idx").distinct().count() == 30_000
    assert indexed.agg(F.max("idx")).first()[0] == 29_999
    files = indexed.where("k = 0").select(F.input_file_name().alias("file")).groupBy("file").count().collect()
    assert len(files) >= 4 and max(f["count"] for f in files) < 10_000


def test_dense_index_without_order(spark):
    df = spark.range(0, 1000, 1, 5).selectExpr("map('a', id) m")
    assert orderable(df.schema) == []
    indexed = dense_index(df, *orderable(df.schema))
    assert sorted(r[0] for r in indexed.select("idx").collect()) == list(range(1000))
    assert "Exchange" not in indexed._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")


def test_dense_index_of_nothing(spark):
    assert dense_index(spark.range(0), "id").collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(total=st.integers(0, 300), size=st.integers(1, 70))
def test_batches_are_full_but_the_last(spark, total, size):
    batched = batch_assign(spark.range(0, total, 1, 3), size, "id")
    batches = collect_batches(batched, F.col("id").cast("string")).orderBy("batch_no").collect()
    assert [b["n_records"] for b in batches] == [size] * (total // size) + ([total % size] if total % size else [])
    assert [int(p) for b in batches for p in b["payloads"]] == list(range(total))


def test_batch_size_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        batch_assign(spark.range(1), 0, "id")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_keyed_takes_every_row_once(spark, how):
    rng = random.Random(2)
    rows = [(rng.choice([0] * 20 + list(range(12))), i) for i in range(3000)] + [(None, -1)]
    big = spark.createDataFrame(rows, "k int, v int").repartition(5)
    keyed = spark.createDataFrame([(k, f"name {k}") for k in range(10)], "k int, name string")
    names = {k: f"name {k}" for k in range(10)}
    expected = sorted(
        (v, names.get(k)) for k, v in rows if how == "left" or k in names
    )
    small = join_keyed(big, keyed, "k", how)
    assert sorted((r["v"], r["name"]) for r in small.collect()) == expected
    # With no room for a broadcast, the frequent key goes its own way.
    assert 0 in hot_keys(big, "k")
    split = join_keyed(big, keyed, "k", how, max_rows=0)
    assert sorted((r["v"], r["name"]) for r in split.collect()) == expected


def test_is_bounded(spark):
    df = spark.range(100).selectExpr("repeat('x', 100) s")
    assert is_bounded(df, 100) and not is_bounded(df, 99)
    assert not is_bounded(df, 100, max_bytes=5000)


def test_split_valid_keeps_everything(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c"), (-1, None)], "n int, s string")
    good, bad = split_valid(df, {"n negative": F.col("n") < 0, "s missing": F.col("s").isNull()})
    assert {tuple(r) for r in good.collect()} == {(1, "a"), (None, "c")}
    assert {tuple(r) for r in bad.collect()} == {(2, None, "s missing"), (-1, None, "n negative")}


def test_fail_fast(spark):
    df = spark.createDataFrame([(1,), (-1,)], "n int")
    rules = {"n negative": F.col("n") < 0}
    assert [r[0] for r in apply_rules(df, rules, fail_fast=False).collect()] == [1]
    with pytest.raises(PySparkException, match="n negative"):
        apply_rules(df, rules, fail_fast=True).collect()


def test_contract(spark):
    df = spark.createDataFrame([(1, "a"), (None, "{")], "n int, s string")
    report = contract_report(df, {"n": ColumnRule("int", required=True), "s": ColumnRule(json=True)}).first()
    assert report.asDict() == {"n_rows": 2, "n_missing": 1, "s_bad_json": 2}
    with pytest.raises(ValueError, match="'x' not found"):
        contract_report(df, {"x": ColumnRule()})
    with pytest.raises(ValueError, match="must be string, not int"):
        contract_report(df, {"n": ColumnRule("string")})


def test_target_schema(spark):
    target = T.StructType.fromDDL("Name STRING NOT NULL, Industry STRING")
    check_against(spark.sql("select 'a' Name"), target)
    for sql, words in (
        ("select 'a' Industry", "mandatory column 'Name'"),
        ("select 1 Name", "must be string"),
        ("select 'a' Name, 1 Other", "Other not in the target"),
    ):
        with pytest.raises(ValueError, match=words):
            check_against(spark.sql(sql), target)


def test_last_write_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, None), ("b", 2, "y"), ("a", 2, "z")], "k string, n int, v string")
    assert {tuple(r) for r in last_per_key(df, "k", "n").collect()} == {("a", 3, None), ("b", 2, "y")}
    current = spark.createDataFrame([("b",), ("b",)], "k string")
    routed = route_create_update(df, current, "k", "n")
    assert {(r["k"], r["action"]) for r in routed.collect()} == {("a", "create"), ("b", "update")}
    assert routed.count() == 2


def outbox_of(spark, n):
    return spark.range(n).selectExpr("concat('key', id) idem_key", "concat('b-', id) batch_id", "2 n_records")


def test_deliver_resumes(spark):
    path = new_path(spark, "outcomes")
    outbox = outbox_of(spark, 6)

    def first(request):
        return {"status": 200 if request["batch_id"] in ("b-0", "b-1") else 503}

    def second(request):
        if request["batch_id"] in ("b-0", "b-1"):
            raise AssertionError("sent twice")
        return {"status": 200, "n_accepted": 1}

    deliver(outbox, first, path, 2)
    all_outcomes = deliver(outbox, second, path, 2)
    assert all_outcomes.count() == 10
    stats = outcomes.delivery_stats(outbox, all_outcomes).first()
    assert stats.asDict() == {"processed": 12, "succeeded": 8, "failed": 4, "pending": 0}
    assert {r["attempt"] for r in read_outcomes(spark, path).collect()} == {1, 2}


def test_deliver_in_waves_and_fail_fast(spark):
    outbox = outbox_of(spark, 20)
    path = new_path(spark, "outcomes")
    assert deliver(outbox, lambda request: {"status": 200}, path, waves=3).count() == 20

    def refuse(request):
        return {"status": 400, "error": "no"}

    path = new_path(spark, "outcomes")
    with pytest.raises(DeliveryFailed, match="no"):
        deliver(outbox, refuse, path, waves=2, fail_fast=True)
    assert 0 < read_outcomes(spark, path).count() < 20


def test_pending_requests_are_counted(spark):
    outbox = outbox_of(spark, 4)
    none_yet = spark.createDataFrame([], outcomes.OUTCOME_SCHEMA)
    assert outcomes.delivery_stats(outbox, none_yet).first()["pending"] == 8


def test_dispatch_schedule(spark):
    rows = spark.range(250).withColumnRenamed("id", "idx")
    planned = outcomes.dispatch_schedule(rows, gap_seconds=5, daily_quota=100)
    assert planned.where("day_no = 2").count() == 50
    assert planned.agg(F.max("second_of_day")).first()[0] == 495
    # A day has room for 144 requests ten minutes apart, whatever the quota.
    tight = outcomes.dispatch_schedule(rows, gap_seconds=600, daily_quota=1000)
    assert tight.where("day_no = 0").count() == 144
    with pytest.raises(ValueError):
        outcomes.dispatch_schedule(rows, 0, 1)
