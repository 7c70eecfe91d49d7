"""Rows to requests, and what became of them."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import ntz, query, table
from drayage.operators.batching import batch_assign as assign, dense_index
from drayage.operators.deliver import Send, deliver, settle
from drayage.operators.joins import join_keyed
from drayage.operators.outcomes import (
    OUTCOME_SCHEMA,
    delivery_stats as stats,
    record_outcomes,
    dispatch_schedule as schedule,
    retry_plan as plan_retries,
    retry_singletons as singletons,
)
from drayage.operators.upsert import route_create_update as route
from drayage.scratch import new_path, stage
from drayage.sinks import events as event_sink, issues, list_items, pages, points, records

EVENT_DDL = (
    "event_name STRING, event_time BIGINT, action_source STRING, event_id STRING, "
    "user_data STRUCT<em: STRING, ph: STRING, client_ip_address: STRING, external_id: STRING>, "
    "custom_data STRUCT<value: DOUBLE, currency: STRING>"
)


def conversion_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their customer's contact data; errors have no name, some e-mails are hashed already."""
    events = table(spark, sf_dir, "events")
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_name", "c_mktsegment", "c_nationkey"
    )
    plain = F.concat(F.lit(" "), F.upper("c_name"), F.lit("@X.org "))
    hashed = F.when(F.col("c_mktsegment") == "BUILDING", F.sha2(F.lower("c_name"), 256)).otherwise(plain)
    return join_keyed(events, customer, "user_id").select(
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(F.col("event_type")).alias("event_name"),
        F.col("ts").alias("event_time"),
        "event_id",
        F.when(F.col("c_mktsegment") != "MACHINERY", hashed).alias("email"),
        F.concat(F.lit("+"), "c_nationkey").alias("ph"),
        F.when(F.col("event_type") == "click", "app").otherwise("").alias("action_source"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
        F.when(F.col("event_type") == "purchase", "EUR").alias("currency"),
        F.col("user_id").alias("external_id"),
    )


def parse_events(outbox: DataFrame) -> DataFrame:
    body = F.from_json("body", f"data ARRAY<STRUCT<{EVENT_DDL.replace(' STRING', ': STRING', 1)}>>")
    return outbox.select("batch_id", "n_records", F.explode(body["data"]).alias("e"))


def event_fields(outbox: DataFrame) -> DataFrame:
    return parse_events(outbox).select(
        "e.event_name",
        "e.event_time",
        "e.action_source",
        "e.event_id",
        "e.user_data.em",
        "e.user_data.ph",
        "e.user_data.external_id",
        "e.custom_data.value",
        "e.custom_data.currency",
    )


EVENTS_SQL = """
SELECT event_type AS event_name, CAST(floor(epoch(ts)) AS BIGINT) AS event_time,
       CASE WHEN event_type = 'click' THEN 'app' ELSE 'website' END AS action_source,
       CASE WHEN event_id <> 0 THEN CAST(event_id AS VARCHAR) END AS event_id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN sha256(lower(c_name))
            WHEN c_mktsegment <> 'MACHINERY' THEN sha256(lower(c_name) || '@x.org') END AS em,
       sha256('+' || c_nationkey) AS ph,
       CASE WHEN user_id <> 0 THEN CAST(user_id AS VARCHAR) END AS external_id,
       CASE WHEN event_type <> 'view' THEN value END AS value,
       CASE WHEN event_type = 'purchase' THEN 'EUR' END AS currency
FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error'"""


@query(EVENTS_SQL)
def capi_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_fields(event_sink.event_outbox(conversion_rows(spark, sf_dir), "pixel", "event_id"))


@query("""
WITH e AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx
           FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error')
SELECT 'events-pixel-' || (idx // 1000) AS batch_id, CAST(count(*) AS INTEGER) AS n_records,
       CAST(nullif(min(event_id), 0) AS VARCHAR) AS first_event
FROM e GROUP BY idx // 1000""")
def capi_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = event_sink.event_outbox(
        conversion_rows(spark, sf_dir), "pixel", "event_id", test_event_code="TEST1"
    )
    return outbox.select("batch_id", "n_records", F.get_json_object("body", "$.data[0].event_id").alias("first_event"))


@query("""
WITH e AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events WHERE event_type <> 'error')
SELECT 'events-pixel-' || (idx // 1000) AS batch_id, CAST(2 AS BIGINT) AS n_builds, CAST(1 AS BIGINT) AS n_keys,
       CAST(count(*) AS INTEGER) AS n_timed
FROM e GROUP BY idx // 1000""")
def capi_untimed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without a time, built twice: every event gets one, and the keys stay."""
    rows = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_name"), "event_id"
    )
    built = [stage(event_sink.event_outbox(rows, "pixel", "event_id"), "build") for _ in range(2)]
    both = built[0].unionByName(built[1])
    timed = F.from_json("body", "data ARRAY<STRUCT<event_time: BIGINT>>")["data"]["event_time"]
    return both.groupBy("batch_id").agg(
        F.count("*").alias("n_builds"),
        F.count_distinct("idem_key").alias("n_keys"),
        F.min(F.size(F.filter(timed, lambda t: t > 1_700_000_000))).alias("n_timed"),
    )


@query("""
SELECT 'event_name missing' AS reject_reason, event_id FROM events JOIN customer ON user_id = c_custkey
WHERE event_type = 'error'""")
def capi_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = event_sink.split_events(conversion_rows(spark, sf_dir))
    return rejects.select("reject_reason", "event_id")


@query("""
SELECT event_id, 'em-' || user_id AS em, CASE WHEN event_type <> 'view' THEN 'done' END AS status,
       CASE WHEN event_type = 'view' THEN value END AS value
FROM events""")
def capi_struct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        F.lit("seen").alias("event_name"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("event_time"),
        F.struct(F.concat(F.lit("em-"), "user_id").alias("em"), F.lit(None).cast("string").alias("ph")).alias("user_data"),
        F.when(F.col("event_type") != "view", F.struct(F.lit("done").alias("status"))).alias("custom_data"),
        "value",
    )
    event = event_sink.event_json(rows.schema)
    return rows.select("event_id", event.alias("event")).select(
        "event_id",
        F.get_json_object("event", "$.user_data.em").alias("em"),
        F.get_json_object("event", "$.custom_data.status").alias("status"),
        F.get_json_object("event", "$.custom_data.value").cast("double").alias("value"),
    )


@query("""
SELECT batch_no, count(*) AS n_records, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
       CAST(max(seq) AS INTEGER) AS last_seq
FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch_no,
             (row_number() OVER (ORDER BY o_orderkey) - 1) % 1000 AS seq FROM orders)
GROUP BY batch_no""")
def batch_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    batched = assign(table(spark, sf_dir, "orders"), 1000, "o_orderkey")
    return batched.groupBy("batch_no").agg(
        F.count("*").alias("n_records"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.max("seq").alias("last_seq"),
    )


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as CRM records with fields of every kind, some of them empty."""
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        F.col("c_custkey").alias("Number"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_name")).alias("Name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("AnnualRevenue"),
        (F.col("c_mktsegment") == "BUILDING").alias("Active"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).alias("Since"),
        F.timestamp_micros(F.col("c_custkey") * 500_000).cast("timestamp_ntz").alias("Seen"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("Balance"),
    )


@query("""
SELECT CAST(c_custkey AS BIGINT) AS number, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END AS name,
       CASE WHEN c_acctbal > 0 THEN c_acctbal END AS annual_revenue, c_mktsegment = 'BUILDING' AS active,
       strftime(DATE '2024-01-01' + c_nationkey, '%Y-%m-%d') AS since,
       CASE WHEN c_custkey % 2 = 0 THEN strftime(make_timestamp(c_custkey * 500000), '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(make_timestamp(c_custkey * 500000), '%Y-%m-%dT%H:%M:%S.%f') END AS seen,
       CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) AS balance
FROM customer""")
def sobject_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = records.record_outbox(customer_records(spark, sf_dir), "Account", "Number")
    record = (
        "Number BIGINT, Name STRING, AnnualRevenue DOUBLE, Active BOOLEAN, Since STRING, Seen STRING, Balance STRING"
    )
    parsed = outbox.select(F.inline(F.from_json("body", f"records ARRAY<STRUCT<{record}>>")["records"]))
    return parsed.toDF("number", "name", "annual_revenue", "active", "since", "seen", "balance")


@query("""
SELECT 'tree-Account-' || (idx // 200) AS batch_id, CAST(count(*) AS INTEGER) AS n_records,
       'ref' || min(idx % 200) AS first_ref, 'ref' || max(idx % 200) AS last_ref, 'Account' AS type
FROM (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS idx FROM customer) GROUP BY idx // 200""")
def tree_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = records.record_outbox(customer_records(spark, sf_dir), "Account", "Number")
    ddl = "records ARRAY<STRUCT<attributes: STRUCT<type: STRING, referenceId: STRING>>>"
    attributes = F.transform(F.from_json("body", ddl)["records"], lambda r: r["attributes"])
    return outbox.select(
        "batch_id",
        "n_records",
        F.get(attributes, F.lit(0))["referenceId"].alias("first_ref"),
        F.element_at(attributes, -1)["referenceId"].alias("last_ref"),
        F.element_at(attributes, -1)["type"].alias("type"),
    )


LIST_FIELDS = {"c_name": "Title", "c_acctbal": "Balance", "segment": "Segment"}


def list_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return customer.select("c_custkey", "c_name", "c_acctbal", segment.alias("segment"))


def list_fields(outbox: DataFrame) -> DataFrame:
    parsed = F.from_json("body", "fields STRUCT<Title: STRING, Balance: DOUBLE, Segment: STRING>")
    return outbox.select("path", parsed.alias("b")).select("path", "b.fields.*")


LIST_SQL = """
SELECT '/sites/s/lists/l/items' AS path, c_name AS "Title", c_acctbal AS "Balance",
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS "Segment"
FROM customer"""


@query(LIST_SQL)
def mapped_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = list_items.resource_outbox(
        list_rows(spark, sf_dir), "list", site_id="s", list_id="l", fields=LIST_FIELDS
    )
    return list_fields(outbox)


@query("""
WITH latest AS (SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey,
                       arg_max(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1),
     state AS (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
SELECT o_custkey, o_orderkey, o_orderstatus, CASE WHEN c_custkey IS NULL THEN 'create' ELSE 'update' END AS action
FROM latest LEFT JOIN state ON o_custkey = c_custkey""")
def route_create_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    current = table(spark, sf_dir, "customer").where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
    return route(orders, current.select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "o_orderkey")


@query("""
SELECT CASE WHEN o_orderstatus = 'O' THEN 'POST' ELSE 'PUT' END AS method,
       CASE WHEN o_orderstatus = 'O' THEN '/rest/api/2/issue' ELSE '/rest/api/2/issue/PROJ-' || o_orderkey END AS path,
       o_orderpriority AS summary,
       CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_totalprice > 200000 THEN 'BIG' ELSE 'SMALL' END END AS project_key,
       CASE WHEN o_orderstatus = 'O' THEN 'Bug' END AS type_name, CAST(NULL AS VARCHAR) AS status,
       CASE WHEN o_totalprice > 100000 THEN 'text ' || o_orderkey END AS description
FROM orders WHERE o_orderstatus = 'O' OR o_orderpriority IS NOT NULL""")
def issue_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = F.col("o_orderstatus") == "O"
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(~new, F.concat(F.lit("PROJ-"), "o_orderkey")).otherwise("").alias("key"),
        F.col("o_orderpriority").alias("summary"),
        F.col("o_orderstatus").alias("status"),
        F.when(new & (F.col("o_totalprice") > 200000), "BIG").alias("project"),
        F.when(F.col("o_totalprice") > 100000, F.concat(F.lit("text "), "o_orderkey")).alias("description"),
        F.col("o_orderdate").alias("created"),
    )
    outbox = issues.issue_outbox(rows.drop("o_orderkey"), project="SMALL", issuetype="Bug")
    ddl = (
        "fields STRUCT<summary: STRING, project: STRUCT<key: STRING>, issuetype: STRUCT<name: STRING>, "
        "status: STRING, description: STRING>"
    )
    return outbox.select("method", "path", F.from_json("body", ddl)["fields"].alias("f")).select(
        "method",
        "path",
        "f.summary",
        F.col("f.project.key").alias("project_key"),
        F.col("f.issuetype.name").alias("type_name"),
        "f.status",
        "f.description",
    )


def part_property_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as pages to create; some without properties, some with damaged or empty ones."""
    good = F.concat(F.lit('{"Name":{"title":[{"text":{"content":"'), "p_name", F.lit('"}}]}}'))
    text = (
        F.when(F.col("p_size") == 1, F.lit(None).cast("string"))
        .when(F.col("p_size") == 2, "{}")
        .when(F.col("p_size") == 3, F.concat(good, F.lit("]")))
        .otherwise(good)
    )
    return table(spark, sf_dir, "part").select("p_partkey", text.alias("properties"))


@query("""
SELECT '/v1/pages' AS path, 'db' AS database_id, p_name AS title FROM part WHERE p_size > 3""")
def page_creates(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = pages.page_outbox(part_property_rows(spark, sf_dir), "db", "p_partkey")
    return outbox.select(
        "path",
        F.get_json_object("body", "$.parent.database_id").alias("database_id"),
        F.get_json_object("body", "$.properties.Name.title[0].text.content").alias("title"),
    )


@query("""
SELECT p_partkey, CASE p_size WHEN 1 THEN 'properties missing' WHEN 2 THEN 'properties empty'
                              ELSE 'properties not valid JSON' END AS reject_reason
FROM part WHERE p_size <= 3""")
def page_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejects = pages.split_pages(part_property_rows(spark, sf_dir))
    return rejects.select("p_partkey", "reject_reason")


def point_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        F.col("vec_id").alias("id"),
        F.to_json("embedding").alias("vector"),
        F.when(F.col("label") != 9, F.struct("label")).alias("payload"),
        F.when(F.col("label") > 4, F.concat(F.lit("tenant-"), "label")).alias("shard_key"),
    )


@query("""
SELECT vec_id AS id, CAST(len(embedding) AS INTEGER) AS dimensions, CAST(embedding[1] AS DOUBLE) AS first_element,
       CASE WHEN label <> 9 THEN label END AS label, CASE WHEN label > 4 THEN 'tenant-' || label END AS shard_key
FROM embeddings""")
def vector_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = points.point_outbox(point_rows(spark, sf_dir), "c", "id")
    point = "id: BIGINT, vector: ARRAY<FLOAT>, payload: STRUCT<label: INT>, shard_key: STRING"
    parsed = outbox.select(F.inline(F.from_json("body", f"points ARRAY<STRUCT<{point}>>")["points"]))
    return parsed.select(
        "id",
        F.size("vector").alias("dimensions"),
        F.element_at("vector", 1).cast("double").alias("first_element"),
        "payload.label",
        "shard_key",
    )


@query("""
SELECT 'PUT' AS method, '/collections/c/points?wait=true' AS path, CAST(count(*) AS INTEGER) AS n_records,
       min(vec_id) AS first_id
FROM (SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // 100 AS batch_no FROM embeddings)
GROUP BY batch_no""")
def vector_upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = points.point_outbox(point_rows(spark, sf_dir), "c", "id")
    first = F.get_json_object("body", "$.points[0].id").cast("long")
    return outbox.select("method", "path", "n_records", first.alias("first_id"))


@query("""
SELECT user_id AS id, count(*) AS n_versions, CAST(1 AS BIGINT) AS n_sent FROM events GROUP BY user_id""")
def vector_upserts_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a version of its user's point: one version of each is sent."""
    events = table(spark, sf_dir, "events")
    rows = events.select(F.col("user_id").alias("id"), F.to_json(F.array("value")).alias("vector"))
    outbox = points.point_outbox(rows, "c")
    parsed = outbox.select(F.inline(F.from_json("body", "points ARRAY<STRUCT<id: BIGINT, vector: STRING>>")["points"]))
    sent = parsed.groupBy("id").agg(F.count("*").alias("n_sent"))
    return events.groupBy(F.col("user_id").alias("id")).agg(F.count("*").alias("n_versions")).join(sent, "id", "left")


def partial_receiver() -> Send:
    """A receiver that answers as the tree service does, and refuses records with a large total."""

    def send(request: dict[str, Any]) -> dict[str, Any]:
        import json

        sent = json.loads(request["body"])["records"]
        bad = [r["Total"] > 200_000 for r in sent]
        results = [{"errors": [{"message": "too large"}]} if b else {"id": str(r["Number"])} for b, r in zip(bad, sent)]
        answer = json.dumps({"hasErrors": any(bad), "results": results})
        return {"status": 200, "n_accepted": records.accepted_records(answer, request["n_records"])}

    return send


def scripted_receiver() -> Send:
    """A receiver without a network: the answer follows from the priority of a batch's first order."""

    def send(request: dict[str, Any]) -> dict[str, Any]:
        import json

        priority = json.loads(request["body"])["records"][0]["Name"]
        if priority == "1-URGENT":
            return {"status": 503, "error": "busy"}
        if priority == "2-HIGH":
            return {"status": 400, "error": "bad request"}
        if priority == "3-MEDIUM":
            return {"status": 200, "n_accepted": request["n_records"] - 1}
        if priority == "5-LOW":
            raise ConnectionError("no answer")
        return {"status": 200}

    return send


def record_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Number"), F.col("o_orderpriority").alias("Name"), F.col("o_totalprice").alias("Total")
    )
    return stage(records.record_outbox(orders, "Order", "Number"), "outbox")


# Orders in batches of 200, with the priority that decides what becomes of each.
BATCHES_SQL = """
SELECT o_orderkey // 200 AS b, count(*) AS n, arg_min(o_orderpriority, o_orderkey) AS p FROM orders GROUP BY 1"""


@query(f"""
SELECT 'tree-Order-' || b AS batch_id, CAST(1 AS INTEGER) AS attempt,
       CAST(CASE p WHEN '1-URGENT' THEN 503 WHEN '2-HIGH' THEN 400 WHEN '5-LOW' THEN 0 ELSE 200 END AS INTEGER) AS status,
       CAST(CASE p WHEN '3-MEDIUM' THEN n - 1 END AS INTEGER) AS n_accepted,
       CASE p WHEN '1-URGENT' THEN 'busy' WHEN '2-HIGH' THEN 'bad request'
              WHEN '5-LOW' THEN 'ConnectionError: no answer' END AS error
FROM ({BATCHES_SQL})""")
def delivery_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    outcomes = deliver(record_batches(spark, sf_dir), scripted_receiver(), new_path(spark, "outcomes"))
    return outcomes.select("batch_id", "attempt", "status", "n_accepted", "error")


@query(f"""
SELECT CAST(sum(n) AS BIGINT) AS processed,
       CAST(sum(CASE p WHEN '3-MEDIUM' THEN n - 1 WHEN '4-NOT SPECIFIED' THEN n ELSE 0 END) AS BIGINT) AS succeeded,
       CAST(sum(CASE p WHEN '3-MEDIUM' THEN 1 WHEN '4-NOT SPECIFIED' THEN 0 ELSE n END) AS BIGINT) AS failed,
       CAST(0 AS BIGINT) AS pending, 'POST' AS method
FROM ({BATCHES_SQL})""")
def delivery_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = record_batches(spark, sf_dir)
    path = new_path(spark, "outcomes")
    deliver(outbox, scripted_receiver(), path)
    # A second run skips what was accepted and tries the rest again.
    outcomes = deliver(outbox, scripted_receiver(), path, base_seconds=0)
    return stats(outbox, outcomes, "method")


def moody_receiver() -> Send:
    """Whole batches, the first try of some, all of others, and single records are refused, by the number of the batch."""

    def send(request: dict[str, Any]) -> dict[str, Any]:
        import json

        mood = int(request["batch_id"].rsplit("-", 1)[1]) % 5
        bad = [r["Total"] > 350_000 for r in json.loads(request["body"])["records"]]
        if mood == 1 and request["attempt"] == 1:
            return {"status": 503, "error": "busy"}
        if mood == 2:
            raise ConnectionError("no answer")
        if mood == 3 and any(bad):
            return {"status": 400, "error": "too large"}
        if mood == 4:
            return {"status": 200, "refused": [n for n, b in enumerate(bad) if b], "error": "too large" if any(bad) else None}
        return {"status": 201}

    return send


@query("""
SELECT o_orderkey AS record, CASE WHEN mood = 2 THEN 'failed' WHEN mood >= 3 AND o_totalprice > 350000 THEN 'refused'
                                  ELSE 'accepted' END AS verdict,
       CAST(CASE mood WHEN 2 THEN 0 WHEN 4 THEN 200 WHEN 3 THEN CASE WHEN o_totalprice > 350000 THEN 400 ELSE 201 END
                      ELSE 201 END AS INTEGER) AS status,
       CAST(CASE WHEN mood = 2 OR mood >= 3 AND o_totalprice > 350000 THEN 0 ELSE 1 END AS BIGINT) AS times_accepted
FROM (SELECT *, o_orderkey // 200 % 5 AS mood FROM orders)""")
def settled_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Busy, dead, refusing and partly refusing receivers: every record ends with one outcome of its own."""
    outbox = record_batches(spark, sf_dir)
    outcomes = settle(outbox, moody_receiver(), new_path(spark, "outcomes"), base_seconds=0.01)
    found = record_outcomes(outbox, outcomes)
    numbers = F.from_json("body", "records ARRAY<STRUCT<Number: BIGINT>>")["records"]["Number"]
    ids = outbox.select("idem_key", numbers.alias("numbers"))
    # What the receiver has taken, answer by answer.  All that is joined has a row for each request.
    taken = outcomes.where("status BETWEEN 200 AND 299").select(
        F.col("request_key").alias("idem_key"),
        F.array_except(
            F.coalesce("positions", F.sequence(F.lit(0), F.lit(199))),
            F.coalesce("refused", F.array().cast("array<int>")),
        ).alias("positions"),
    )
    taken = taken.groupBy("idem_key").agg(F.flatten(F.collect_list("positions")).alias("taken"))
    verdicts = found.groupBy("idem_key").agg(F.collect_list(F.struct("position", "verdict", "status")).alias("found"))
    joined = ids.join(verdicts, "idem_key").join(taken, "idem_key", "left")
    each = joined.select("numbers", "taken", F.explode("found").alias("f")).withColumn("position", F.col("f.position"))
    times = F.size(F.filter("taken", lambda p: p == F.col("position"))).cast("long")
    return each.select(
        F.get("numbers", F.col("position")).alias("record"),
        "f.verdict",
        "f.status",
        F.when(F.col("taken").isNull(), 0).otherwise(times).cast("long").alias("times_accepted"),
    )


@query("""
SELECT 'tree-Order-' || (o_orderkey // 200) AS batch_id, CAST(count(*) AS BIGINT) AS processed,
       CAST(count(*) FILTER (o_totalprice <= 200000) AS BIGINT) AS succeeded,
       CAST(count(*) FILTER (o_totalprice > 200000) AS BIGINT) AS failed
FROM orders GROUP BY 1""")
def tree_partial_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox = record_batches(spark, sf_dir)
    outcomes = deliver(outbox, partial_receiver(), new_path(spark, "outcomes"))
    return stats(outbox, outcomes, "batch_id").drop("pending")


def event_requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One request per event, and up to three attempts at each."""
    events = table(spark, sf_dir, "events")
    outbox = events.select(
        F.col("event_id").cast("string").alias("idem_key"),
        F.concat(F.lit("b"), "event_id").alias("batch_id"),
        F.lit(1).alias("n_records"),
    )
    status = (
        F.when(F.col("event_type") == "error", 503)
        .when(F.col("event_type") == "signup", 429)
        .when(F.col("event_type") == "view", 400)
        .otherwise(200)
    )
    attempts = F.sequence(F.lit(1), F.when(F.col("value") < 10, 1).when(F.col("value") < 40, 2).otherwise(3))
    outcomes = events.select(
        F.col("event_id").cast("string").alias("idem_key"),
        F.concat(F.lit("b"), "event_id").alias("batch_id"),
        F.explode(attempts).alias("attempt"),
        status.alias("status"),
        F.lit(None).cast("int").alias("n_accepted"),
        F.col("ts").cast("timestamp").alias("t"),
        F.lit(None).cast("string").alias("error"),
    )
    finished = F.timestamp_micros(F.unix_micros("t") + F.col("attempt") * 1_000_000)
    whole = {"request_key": F.col("idem_key"), "positions": F.lit(None), "refused": F.lit(None)}
    outcomes = outcomes.withColumns({"finished_at": finished, **whole})
    return outbox, outcomes.select(*[f.split()[0] for f in OUTCOME_SCHEMA.split(", ")])


@query("""
SELECT CAST(event_id AS VARCHAR) AS idem_key, CAST(a + 1 AS INTEGER) AS next_attempt,
       CAST(CASE event_type WHEN 'error' THEN 503 ELSE 429 END AS INTEGER) AS status,
       ts + a * INTERVAL 1 SECOND + (2 ** a)::INTEGER * INTERVAL 1 SECOND AS next_at
FROM (SELECT *, CASE WHEN value < 10 THEN 1 WHEN value < 40 THEN 2 ELSE 3 END AS a FROM events)
WHERE event_type IN ('error', 'signup') AND a < 3""")
def retry_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    outbox, outcomes = event_requests(spark, sf_dir)
    planned = plan_retries(outbox, outcomes)
    return planned.select("idem_key", "next_attempt", "status", ntz("next_at").alias("next_at"))


@query(f"""
SELECT o_orderkey AS record, '/sobjects/Order' AS path, CAST(1 AS INTEGER) AS n_records, o_orderpriority AS name
FROM orders JOIN ({BATCHES_SQL}) ON o_orderkey // 200 = b WHERE p IN ('1-URGENT', '2-HIGH', '5-LOW')""")
def retry_singletons(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Number"), F.col("o_orderpriority").alias("Name"), F.col("o_totalprice").alias("Total")
    )
    outcomes = deliver(record_batches(spark, sf_dir), scripted_receiver(), new_path(spark, "outcomes"))
    batched = records.assigned_records(orders, "Number").withColumn(
        "batch_id", F.concat(F.lit("tree-Order-"), F.col("batch_no").cast("string"))
    )
    failed = singletons(batched, outcomes, F.col("Number"))
    single = records.single_record_outbox(failed, orders.schema, "Order", "Number")
    return single.select(
        F.get_json_object("body", "$.Number").cast("long").alias("record"),
        "path",
        "n_records",
        F.get_json_object("body", "$.Name").alias("name"),
    )


@query("""
SELECT event_id, idx // 4000 AS day_no, idx % 4000 * 5 AS second_of_day
FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS idx FROM events)""")
def dispatch_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = dense_index(table(spark, sf_dir, "events").select("event_id"), "event_id")
    return schedule(indexed, gap_seconds=5, daily_quota=4000).drop("idx")
