"""Connectors by name: ``read``, ``write``, ``read_stream``, ``poll_stream``, ``write_stream``, ``send_stream``.

Options carry the names users know.  ``get`` and ``send`` replace the HTTP functions, for
tests or for clients of one's own.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from drayage import wire
from drayage.functions.sheets import csv_export_url, is_sheet_url, spreadsheet_id, worksheet_id
from drayage.landed import Follow, Get, bodies, fetch, fetch_chain, parsed
from drayage.operators.batching import row_order
from drayage.operators.contract import check_against
from drayage.operators.deliver import Send, deliver
from drayage.operators.outcomes import delivery_stats
from drayage.operators.pacing import Pace
from drayage.options import OptionSpec
from drayage.plans.cursors import fetch_split, next_page_offset
from drayage.plans.paging import offset_pages
from drayage.plans.ranges import symbol_rows
from drayage.plans.regions import DEFAULT_REGION, REGIONS
from drayage.scratch import new_path, stage
from drayage.sinks import events, issues, list_items, records, versions
from drayage.sinks import files as file_sinks
from drayage.sinks import pages as page_sink
from drayage.sinks import points as point_sink
from drayage.sources import aircraft, arrow_ipc, files, generate, jdbc, market, pages, points, rest_demo, tracker, weather
from drayage.sources.arrow_schema import merged_schema
from drayage.streaming.outboxes import outbox_stream
from drayage.streaming.pollers import polling_stream
from drayage.streaming.readers import (
    aircraft_stream,
    counter_stream,
    landed_stream,
    new_file_stream,
    rate_stream,
    weather_stream,
)
from drayage.streaming.senders import sending_stream

PULLS_PER_PAGE = 100
ISSUES_PER_PAGE = 50
PAGES_PER_QUERY = 100
NOTION_VERSION = {"Notion-Version": "2022-06-28"}

DATABASE_OPTIONS = dict.fromkeys(
    ("dbtable", "query", "partition_column", "lower", "upper", "partitions", "custom_schema")
)

READ_OPTIONS = {
    "arrow": OptionSpec("arrow", ("path",), {"splitBytes": None, "mergeSchema": "false"}, flags=("mergeSchema",)),
    "fake": OptionSpec(
        "fake", (), {"numRows": 3, "numPartitions": None, "seed": 0, "schema": None}, positive=("numRows",)
    ),
    "github": OptionSpec("github", ("path",), {"token": None}),
    "googlesheets": OptionSpec(
        "googlesheets",
        (),
        {"sheet_id": None, "has_header": "true", "schema": None},
        any_of=(("url", "path"),),
        exclusive=(("url", "path"),),
        flags=("has_header",),
    ),
    "huggingface": OptionSpec("huggingface", ("path",), {"split": "train", "schema": None}),
    "jira": OptionSpec("jira", ("url", "username", "token", "jql")),
    "jsonplaceholder": OptionSpec(
        "jsonplaceholder",
        (),
        {"endpoint": "posts", "limit": None, "id": None},
        choices={"endpoint": tuple(rest_demo.ENDPOINTS)},
    ),
    "kaggle": OptionSpec("kaggle", ("path",), {"csv_options": None}),
    "lance": OptionSpec("lance", ("path",), {"version": None}),
    "notion": OptionSpec("notion", ("token", "database_id")),
    "opensky": OptionSpec(
        "opensky", (), {"region": DEFAULT_REGION, "token": None}, choices={"region": tuple(REGIONS)}
    ),
    "oracle": OptionSpec(
        "oracle",
        ("url",),
        {**DATABASE_OPTIONS, "user": None, "password": None, "driver": None},
        any_of=(("dbtable", "query"),),
    ),
    "qdrant": OptionSpec(
        "qdrant",
        ("url", "collection"),
        {"api_key": None, "limit": 100, "with_payload": "true", "with_vector": "true", "filter": None},
        positive=("limit",),
        flags=("with_payload", "with_vector"),
        json_objects=("filter",),
    ),
    "robinhood": OptionSpec("robinhood", ("path",), {"base_url": "https://trading.robinhood.com"}),
    "sftp": OptionSpec("sftp", ("path",), {"recursive": "false", "pattern": None}, flags=("recursive",)),
    "stock": OptionSpec(
        "stock", ("path", "api_key"), {"function": market.SERIES[0]}, choices={"function": market.SERIES}
    ),
    "weather": OptionSpec(
        "weather", ("locations", "apikey"), {"frequency": "minutely"}, choices={"frequency": weather.FREQUENCIES}
    ),
}

WRITE_OPTIONS = {
    "arrow": OptionSpec("arrow", ("path",), {"mode": "append"}, choices={"mode": file_sinks.MODES}),
    "jira": OptionSpec("jira", ("url", "username", "token"), {"project": None, "issuetype": issues.DEFAULT_TYPE}),
    "lance": OptionSpec("lance", ("path",), {"mode": "append"}),
    "meta_capi": OptionSpec(
        "meta_capi",
        ("access_token", "pixel_id"),
        {
            "api_version": events.DEFAULT_API_VERSION,
            "batch_size": events.DEFAULT_BATCH,
            "test_event_code": None,
            "base_url": "https://graph.facebook.com",
        },
        positive=("batch_size",),
    ),
    "notion": OptionSpec("notion", ("token", "database_id")),
    "oracle": OptionSpec(
        "oracle",
        ("url", "dbtable"),
        {"mode": "append", "user": None, "password": None, "driver": None},
        choices={"mode": jdbc.SAVE_MODES},
    ),
    "qdrant": OptionSpec(
        "qdrant",
        ("url", "collection"),
        {"api_key": None, "batch_size": point_sink.DEFAULT_BATCH, "wait": "true"},
        positive=("batch_size",),
        flags=("wait",),
    ),
    "salesforce": OptionSpec(
        "salesforce",
        ("instance_url", "token"),
        {"salesforce_object": records.DEFAULT_OBJECT, "schema": None, "batch_size": records.DEFAULT_BATCH},
        positive=("batch_size",),
    ),
    "sftp": OptionSpec("sftp", ("path",), {"mode": "append"}, choices={"mode": file_sinks.MODES}),
    "sharepoint": OptionSpec(
        "sharepoint",
        ("site_id", "list_id", "fields", "token"),
        {"resource": "list", "base_url": "https://graph.microsoft.com/v1.0"},
        json_objects=("fields",),
    ),
    "simplejson": OptionSpec(
        "simplejson",
        ("path",),
        {"mode": "append", "rows_per_file": 100_000},
        choices={"mode": file_sinks.MODES},
        positive=("rows_per_file",),
    ),
}
STREAM_OPTIONS = {
    "fake": OptionSpec("fake", (), {"numRows": 3, "seed": 0, "schema": None}, positive=("numRows",)),
    "opensky": OptionSpec(
        "opensky",
        ("path",),
        {"region": DEFAULT_REGION, "dedupe_within": None},
        choices={"region": tuple(REGIONS)},
    ),
    "weather": OptionSpec(
        "weather",
        ("path",),
        {"frequency": "minutely", "locations": None, "forget_after": None},
        choices={"frequency": weather.FREQUENCIES},
    ),
    "files": OptionSpec("files", ("path",), {"pattern": "*"}),
    "rate": OptionSpec("rate", ("rowsPerSecond",), positive=("rowsPerSecond",)),
    "counter": OptionSpec("counter", ("batchSize",), positive=("batchSize",)),
}
STREAM_ONLY_SINKS = ("salesforce", "sharepoint")
ALIASES = {"pyspark.datasource.salesforce": "salesforce"}


def register(spark: SparkSession) -> None:
    """Make ``spark.read.format("arrow")`` and ``df.write.format("arrow")`` known.

    The source travels with its code, so executors need not have this package installed.
    """
    cloudpickle.register_pickle_by_value(arrow_ipc)
    spark.dataSource.register(arrow_ipc.ArrowFiles)


def read(
    spark: SparkSession,
    name: str,
    get: Get | None = None,
    max_in_flight: int | None = None,
    on_error: str | None = None,
    **options: Any,
) -> DataFrame:
    """A batch frame from a connector.

    A response that failed raises, or with ``on_error="skip"`` adds no rows; quotes skip by default.
    A listing that is read page after page ends at a failed page, so there leaving out the rest
    must be asked for with ``on_error="incomplete"``.
    """
    given = _check(READ_OPTIONS, "read", name, options)
    if name in _FILE_READERS:
        return _FILE_READERS[name](spark, given)
    plan = _PLANS[name](spark, given)
    paged = plan.follow is not None or plan.split is not None
    if paged and on_error == "skip":
        raise ValueError(f"{name} is read page after page; on_error must be: fail, incomplete")
    if paged and on_error == "incomplete":
        on_error = "skip"
    if get is None:
        if name == "robinhood":
            raise ValueError("robinhood requests are signed with your private key; pass a `get` that signs them")
        get = wire.http_get(plan.headers, _secret_params(name, given))
    # Responses are staged, so that no later action asks the service again.
    requests = plan.requests
    if plan.expand is not None:
        requests = plan.expand(stage(fetch(requests, name, get, max_in_flight), f"landed-{name}"))
    if plan.split is not None:
        staged = plan.split(get, max_in_flight)
        return plan.shape(staged) if on_error is None else plan.shape(staged, on_error=on_error)
    if plan.follow is None:
        landed = fetch(requests, name, get, max_in_flight)
    else:
        landed = fetch_chain(requests, name, get, plan.follow, max_in_flight)
    staged = stage(landed, f"landed-{name}")
    return plan.shape(staged) if on_error is None else plan.shape(staged, on_error=on_error)


def write(
    df: DataFrame,
    name: str,
    send: Send | None = None,
    max_in_flight: int | None = None,
    outcomes_path: str | None = None,
    fail_fast: bool = False,
    **options: Any,
) -> DataFrame | None:
    """Write a batch frame.  Service sinks return one row of delivery totals, file sinks nothing.

    With ``outcomes_path`` the outcomes are kept there, rows are batched in an order of their
    own, and writing the same rows again sends only what was not accepted: refused requests in
    halves, where they can be split.
    """
    name = ALIASES.get(name, name)
    if name in STREAM_ONLY_SINKS:
        raise ValueError(f"{name} does not support batch write; use write_stream")
    given = _check(WRITE_OPTIONS, "write", name, options)
    if name in _FILE_WRITERS:
        return _FILE_WRITERS[name](df, given)
    order_by = row_order(df.schema) if outcomes_path else []
    outbox = stage(build_outbox(df, name, given, *order_by), f"outbox-{name}")
    send = send or service_sender(name, given)
    path = outcomes_path or new_path(df.sparkSession, f"outcomes-{name}")
    return delivery_stats(outbox, deliver(outbox, send, path, max_in_flight, fail_fast=fail_fast, split=True))


def read_stream(spark: SparkSession, name: str, **options: Any) -> DataFrame:
    """A streaming frame.  Service streams read responses that ``poll_stream`` or another job lands under ``path``."""
    given = _check(STREAM_OPTIONS, "stream", name, options)
    if name == "fake":
        schema = given["schema"] or generate.DEFAULT_SCHEMA
        return generate.generate_stream(spark, given["numRows"], schema, int(given["seed"]))
    if name == "opensky":
        return aircraft_stream(landed_stream(spark, given["path"]), given["region"], given["dedupe_within"])
    if name == "weather":
        forget = None if given["forget_after"] is None else int(given["forget_after"])
        return weather_stream(spark, given["path"], given["frequency"], given["locations"], forget)
    if name == "files":
        return new_file_stream(spark, given["path"], given["pattern"])
    if name == "rate":
        return rate_stream(spark, given["rowsPerSecond"])
    return counter_stream(spark, given["batchSize"])


def write_stream(rows: DataFrame, name: str, path: str, checkpoint: str, **options: Any) -> DataStreamWriter:
    """A stream writer into the outbox at ``path``; ``send_stream`` sends what is there."""
    name = ALIASES.get(name, name)
    given = _check(WRITE_OPTIONS, "write_stream", name, options)
    if name in _FILE_WRITERS:
        raise ValueError(f"{name} is no streaming sink")
    # Ordered, so that a replayed micro-batch fills the same requests with the same rows.
    order_by = row_order(rows.schema)
    return outbox_stream(rows, lambda batch: build_outbox(batch, name, given, *order_by), path, checkpoint)


def poll_stream(
    spark: SparkSession,
    name: str,
    path: str,
    checkpoint: str,
    get: Get | None = None,
    max_in_flight: int | None = None,
    gap_seconds: float | None = None,
    daily_quota: int | None = None,
    **options: Any,
) -> DataStreamWriter:
    """A stream that asks a service once for each trigger and lands the answers under ``path``.

    Aircraft polls keep the service's own gap and quota unless others are given.
    """
    if name not in ("opensky", "weather"):
        raise ValueError("only opensky and weather are polled")
    given = _check(READ_OPTIONS, "poll", name, options)
    plan = _PLANS[name](spark, given)
    if name == "opensky":
        gap_seconds = aircraft.MINIMUM_GAP_SECONDS if gap_seconds is None else gap_seconds
        own = aircraft.DAILY_QUOTA["authenticated" if given["token"] else "anonymous"]
        daily_quota = own if daily_quota is None else daily_quota
    get = get or wire.http_get(plan.headers, _secret_params(name, given))
    requests = stage(plan.requests, f"requests-{name}")
    return polling_stream(
        spark, requests, name, get, path, checkpoint, max_in_flight, gap_seconds or 0.0, daily_quota
    )


def send_stream(
    spark: SparkSession,
    name: str,
    outbox_path: str,
    outcomes_path: str,
    checkpoint: str,
    send: Send | None = None,
    max_in_flight: int | None = None,
    pace: Pace | None = None,
    **options: Any,
) -> DataStreamWriter:
    """A stream that sends what ``write_stream`` puts into the outbox at ``outbox_path``."""
    name = ALIASES.get(name, name)
    given = _check(WRITE_OPTIONS, "send_stream", name, options)
    if name in _FILE_WRITERS:
        raise ValueError(f"{name} is no streaming sink")
    send = send or service_sender(name, given)
    return sending_stream(spark, outbox_path, outcomes_path, checkpoint, send, max_in_flight, pace=pace)


def build_outbox(df: DataFrame, name: str, given: dict[str, Any], *order_by: Column) -> DataFrame:
    if name == "meta_capi":
        return events.event_outbox(
            df,
            given["pixel_id"],
            *order_by,
            batch_size=given["batch_size"],
            api_version=given["api_version"],
            test_event_code=given["test_event_code"],
        )
    if name == "jira":
        return issues.issue_outbox(df, project=given["project"], issuetype=given["issuetype"])
    if name == "notion":
        return page_sink.page_outbox(df, given["database_id"])
    if name == "qdrant":
        return point_sink.point_outbox(
            df, given["collection"], *order_by, batch_size=given["batch_size"], wait=given["wait"]
        )
    if name == "salesforce":
        check_against(df, records.target_schema(given["schema"]))
        return records.record_outbox(df, given["salesforce_object"], *order_by, batch_size=given["batch_size"])
    return list_items.resource_outbox(
        df, given["resource"], site_id=given["site_id"], list_id=given["list_id"], fields=given["fields"]
    )


def service_sender(name: str, given: dict[str, Any]) -> Send:
    """The HTTP function for an outbox of the named service."""
    if name == "meta_capi":
        return wire.http_send(given["base_url"], secret_params={"access_token": given["access_token"]})
    if name == "jira":
        return wire.http_send(given["url"], wire.basic_auth(given["username"], given["token"]))
    if name == "notion":
        return wire.http_send("https://api.notion.com", {**wire.bearer(given["token"]), **NOTION_VERSION})
    if name == "qdrant":
        return wire.http_send(given["url"], {"api-key": given["api_key"]} if given["api_key"] else {})
    if name == "salesforce":
        base_url = given["instance_url"].rstrip("/") + "/services/data/v59.0"
        return wire.http_send(base_url, wire.bearer(given["token"]), refused=records.refused_records)
    return wire.http_send(given["base_url"], wire.bearer(given["token"]))


def _check(specs: dict[str, OptionSpec], verb: str, name: str, options: dict[str, Any]) -> dict[str, Any]:
    if name not in specs:
        raise ValueError(f"no connector called '{name}' to {verb}; connectors are {', '.join(specs)}")
    return specs[name].check(options)


def _secret_params(name: str, given: dict[str, Any]) -> dict[str, str]:
    if name == "stock":
        return {"apikey": given["api_key"]}
    return {"apikey": given["apikey"]} if name == "weather" else {}


# File and database connectors -------------------------------------------------------------


def _read_arrow(spark: SparkSession, given: dict[str, Any]) -> DataFrame:
    register(spark)
    reader = spark.read.format("arrow")
    if given["splitBytes"] is not None:
        reader = reader.option("splitBytes", given["splitBytes"])
    if given["mergeSchema"]:
        reader = reader.schema(merged_schema(spark, given["path"]))
    return reader.load(given["path"])


def _read_fake(spark: SparkSession, given: dict[str, Any]) -> DataFrame:
    partitions = given["numPartitions"]
    return generate.generate(
        spark,
        given["numRows"],
        given["schema"] or generate.DEFAULT_SCHEMA,
        int(given["seed"]),
        None if partitions is None else int(partitions),
    )


def _connection(given: dict[str, Any]) -> dict[str, str]:
    return {k: given[k] for k in ("user", "password", "driver") if given.get(k)}


def _read_oracle(spark: SparkSession, given: dict[str, Any]) -> DataFrame:
    what = {k: v for k, v in given.items() if k not in ("user", "password", "driver")}
    return jdbc.read_database(spark, _connection(given), **what)


def _write_arrow(df: DataFrame, given: dict[str, Any]) -> None:
    register(df.sparkSession)
    df.write.format("arrow").mode(given["mode"]).save(given["path"])


def _write_lance(df: DataFrame, given: dict[str, Any]) -> None:
    based_on = versions.latest_version(df.sparkSession, given["path"])
    versions.append_version(df, given["path"], based_on, given["mode"])


_FILE_READERS: dict[str, Callable[[SparkSession, dict[str, Any]], DataFrame]] = {
    "arrow": _read_arrow,
    "fake": _read_fake,
    "huggingface": lambda spark, o: files.read_split(spark, o["path"], o["split"], o["schema"]),
    "kaggle": lambda spark, o: files.read_dataset_csv(spark, o["path"], o["csv_options"]),
    "lance": lambda spark, o: versions.read_version(
        spark, o["path"], None if o["version"] is None else int(o["version"])
    ),
    "oracle": _read_oracle,
    "sftp": lambda spark, o: files.read_lines(spark, o["path"], o["recursive"], o["pattern"]),
}

_FILE_WRITERS: dict[str, Callable[[DataFrame, dict[str, Any]], None]] = {
    "arrow": _write_arrow,
    "lance": _write_lance,
    "oracle": lambda df, o: jdbc.write_database(df, o["mode"], _connection(o), url=o["url"], dbtable=o["dbtable"]),
    "sftp": lambda df, o: file_sinks.write_lines(df, o["path"], o["mode"]),
    "simplejson": lambda df, o: file_sinks.write_json_arrays(df, o["path"], o["mode"], o["rows_per_file"]),
}


# Service connectors -----------------------------------------------------------------------


@dataclass(frozen=True)
class Plan:
    """What to ask, and the shape of the rows in the answers.

    ``follow`` names the next request of a chain.  ``expand`` turns the answers to
    ``requests`` into the requests proper, which then run all at once.  ``split`` fetches a listing that is read
    by many cursors, and stages it.
    """

    requests: DataFrame
    shape: Callable[..., DataFrame]
    headers: dict[str, str] = field(default_factory=dict)
    follow: Follow | None = None
    expand: Callable[[DataFrame], DataFrame] | None = None
    split: Callable[[Get, int | None], DataFrame] | None = None


def _one_request(spark: SparkSession, key: str, url: str, body: str | None = None) -> DataFrame:
    return spark.createDataFrame(
        [(key, 0, url, body)], "request_key string, page_no long, url string, body string"
    )


def _github(spark: SparkSession, given: dict[str, Any]) -> Plan:
    repo, size = given["path"], PULLS_PER_PAGE
    base = f"https://api.github.com/repos/{repo}/pulls?per_page={size}&page="

    def follow(request: dict[str, Any], status: int, body: str) -> dict[str, Any] | None:
        if status != 200 or len(json.loads(body)) < size:
            return None
        page = int(request["url"].rsplit("=", 1)[1]) + 1
        return {**request, "url": f"{base}{page}"}

    headers = {"Accept": "application/vnd.github+json", **wire.bearer(given["token"])}
    return Plan(_one_request(spark, repo, f"{base}1"), tracker.pull_requests, headers, follow)


def _jira(spark: SparkSession, given: dict[str, Any]) -> Plan:
    """The number of hits is asked first; then every page is a request of its own."""
    query = F.concat(F.lit(f"{given['url'].rstrip('/')}/rest/api/2/search?jql="), F.url_encode(F.lit(given["jql"])))
    no_body = F.lit(None).cast("string").alias("body")
    count = spark.range(1).select(
        F.lit(given["jql"]).alias("request_key"),
        F.lit(0).cast("long").alias("page_no"),
        F.concat(query, F.lit("&startAt=0&maxResults=0")).alias("url"),
        no_body,
    )

    def expand(counted: DataFrame) -> DataFrame:
        totals = parsed(counted, "total BIGINT").select("request_key", "doc.total")
        bounds = F.concat(F.lit("&startAt="), "start_at", F.lit(f"&maxResults={ISSUES_PER_PAGE}"))
        return offset_pages(totals, ISSUES_PER_PAGE).select(
            "request_key", "page_no", F.concat(query, bounds).alias("url"), no_body
        )

    return Plan(count, tracker.issues, wire.basic_auth(given["username"], given["token"]), expand=expand)


def _jsonplaceholder(spark: SparkSession, given: dict[str, Any]) -> Plan:
    endpoint = given["endpoint"]
    url = f"https://jsonplaceholder.typicode.com/{endpoint}"
    if given["id"]:
        url += f"/{given['id']}"
    elif given["limit"]:
        url += f"?_limit={given['limit']}"
    return Plan(_one_request(spark, endpoint, url), partial(rest_demo.rest_rows, endpoint=endpoint))


def _notion(spark: SparkSession, given: dict[str, Any]) -> Plan:
    size = PAGES_PER_QUERY

    def follow(request: dict[str, Any], status: int, body: str) -> dict[str, Any] | None:
        answer = json.loads(body) if status == 200 else {}
        if not answer.get("has_more"):
            return None
        return {**request, "body": json.dumps({"page_size": size, "start_cursor": answer["next_cursor"]})}

    url = f"https://api.notion.com/v1/databases/{given['database_id']}/query"
    first = _one_request(spark, given["database_id"], url, json.dumps({"page_size": size}))
    return Plan(first, pages.database_pages, {**wire.bearer(given["token"]), **NOTION_VERSION}, follow)


def _qdrant(spark: SparkSession, given: dict[str, Any]) -> Plan:
    """Scrolled in ranges of ids; see ``plans.cursors``."""
    ask = {"limit": given["limit"], "with_payload": given["with_payload"], "with_vector": given["with_vector"]}
    if given["filter"]:
        ask["filter"] = given["filter"]

    def body_of(cursor: Any) -> str:
        return json.dumps(ask if cursor is None else {**ask, "offset": cursor})

    url = f"{given['url'].rstrip('/')}/collections/{given['collection']}/points/scroll"
    headers = {"api-key": given["api_key"]} if given["api_key"] else {}

    def split(get: Get, max_in_flight: int | None) -> DataFrame:
        return fetch_split(
            spark, given["collection"], url, body_of, next_page_offset, "qdrant", get, max_in_flight
        )

    return Plan(_one_request(spark, given["collection"], url, body_of(None)), points.points, headers, split=split)


def _per_symbol(spark: SparkSession, text: str, url: str, pairs: bool) -> DataFrame:
    listed = symbol_rows(spark.createDataFrame([(text,)], "symbols string"), "symbols", pairs)
    return listed.select(
        F.col("symbol").alias("request_key"),
        F.lit(0).cast("long").alias("page_no"),
        F.concat(F.lit(url), F.url_encode("symbol")).alias("url"),
        F.lit(None).cast("string").alias("body"),
    )


def _stock(spark: SparkSession, given: dict[str, Any]) -> Plan:
    url = f"https://www.alphavantage.co/query?function={given['function']}&symbol="
    return Plan(_per_symbol(spark, given["path"], url, False), market.price_bars)


def _robinhood(spark: SparkSession, given: dict[str, Any]) -> Plan:
    url = f"{given['base_url']}/api/v1/crypto/marketdata/best_bid_ask/?symbol="
    return Plan(_per_symbol(spark, given["path"], url, True), market.quotes)


def _opensky(spark: SparkSession, given: dict[str, Any]) -> Plan:
    south, north, west, east = REGIONS[given["region"]]
    box = f"lamin={south}&lamax={north}&lomin={west}&lomax={east}"
    first = _one_request(spark, given["region"], f"https://opensky-network.org/api/states/all?{box}")
    return Plan(first, partial(aircraft.aircraft_states, region=given["region"]), wire.bearer(given["token"]))


def _weather(spark: SparkSession, given: dict[str, Any]) -> Plan:
    asked = weather.location_frame(spark, given["locations"]).select(
        F.col("location").alias("request_key"),
        F.lit(0).cast("long").alias("page_no"),
        F.concat(F.lit("https://api.tomorrow.io/v4/weather/forecast?location="), "location").alias("url"),
        F.lit(None).cast("string").alias("body"),
    )
    return Plan(asked, partial(weather.timeline_entries, frequency=given["frequency"]))


def _googlesheets(spark: SparkSession, given: dict[str, Any]) -> Plan:
    if given.get("url"):
        url = F.lit(given["url"])
        if not spark.range(1).select(is_sheet_url(url)).first()[0]:
            raise ValueError("URL is not a Google Sheets URL")
        book, sheet = spreadsheet_id(url), worksheet_id(url)
    else:
        book, sheet = F.lit(given["path"]), F.lit(given["sheet_id"]).cast("string")
    export = csv_export_url(book, sheet, F.lit(None).cast("string"))
    asked = spark.range(1).select(
        book.alias("request_key"),
        F.lit(0).cast("long").alias("page_no"),
        export.alias("url"),
        F.lit(None).cast("string").alias("body"),
    )

    def shape(landed: DataFrame, on_error: str = "fail") -> DataFrame:
        if on_error != "fail":
            raise ValueError("a sheet is one response; on_error must be: fail")
        folder = new_path(spark, "sheet")
        file_sinks.write_lines(bodies(landed).select("body"), folder)
        return files.read_sheet(spark, folder, given["schema"], given["has_header"])

    return Plan(asked, shape)


_PLANS: dict[str, Callable[[SparkSession, dict[str, Any]], Plan]] = {
    "github": _github,
    "googlesheets": _googlesheets,
    "jira": _jira,
    "jsonplaceholder": _jsonplaceholder,
    "notion": _notion,
    "opensky": _opensky,
    "qdrant": _qdrant,
    "robinhood": _robinhood,
    "stock": _stock,
    "weather": _weather,
}
