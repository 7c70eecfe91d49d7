"""Landed bodies to typed rows."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import body, landed, ntz, obj, paged, query, table
from drayage.landed import fetch
from drayage.operators.joins import join_keyed
from drayage.scratch import stage
from drayage.sources import aircraft, generate, market, pages, points, rest_demo, tracker, weather


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS id, o_orderpriority || ' "' || o_orderstatus || '"' AS title,
       CASE WHEN o_orderstatus <> 'P' THEN 'user' || o_custkey END AS author,
       strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
       CASE WHEN o_orderpriority <> '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%dT12:00:00Z') END AS updated_at
FROM orders""")
def github_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    user = F.when(F.col("o_orderstatus") != "P", F.struct(F.concat(F.lit("user"), "o_custkey").alias("login")))
    updated = F.when(F.col("o_orderpriority") != "5-LOW", F.date_format("o_orderdate", "yyyy-MM-dd'T12:00:00Z'"))
    item = obj(
        F.col("o_orderkey").alias("number"),
        F.concat("o_orderpriority", F.lit(' "'), "o_orderstatus", F.lit('"')).alias("title"),
        user.alias("user"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        updated.alias("updated_at"),
        F.lit(1).alias("unread_field"),
    )
    responses = paged(orders, "o_orderkey", 30, item).withColumn("body", F.col("items"))
    return tracker.pull_requests(landed(responses, "github"))


@query("""
SELECT 'PROJ-' || o_orderkey AS key, o_orderpriority AS summary,
       CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END AS status,
       CASE WHEN o_totalprice >= 100000 THEN 'line "1"' || chr(10) || 'line 2' END AS description,
       strftime(o_orderdate, '%Y-%m-%d') AS created, strftime(o_orderdate, '%Y-%m-%d') AS updated,
       CASE WHEN o_orderstatus <> 'F' THEN 'user ' || o_custkey END AS assignee,
       'user ' || o_custkey AS reporter, o_orderpriority AS priority, 'Bug' AS issuetype, 'PROJ' AS project
FROM orders""")
def jira_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    person = F.struct(F.concat(F.lit("user "), "o_custkey").alias("displayName"))
    fields = F.struct(
        F.col("o_orderpriority").alias("summary"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.struct(F.col("o_orderstatus").alias("name"))).alias("status"),
        F.when(F.col("o_totalprice") >= 100000, F.lit('line "1"\nline 2')).alias("description"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("created"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("updated"),
        F.when(F.col("o_orderstatus") != "F", person).alias("assignee"),
        person.alias("reporter"),
        F.struct(F.col("o_orderpriority").alias("name")).alias("priority"),
        F.struct(F.lit("Bug").alias("name")).alias("issuetype"),
        F.struct(F.lit("PROJ").alias("key")).alias("project"),
    )
    item = obj(F.concat(F.lit("PROJ-"), "o_orderkey").alias("key"), fields.alias("fields"))
    responses = paged(orders, "o_orderkey", 50, item).withColumn("body", body('{"issues":', F.col("items"), "}"))
    return tracker.issues(landed(responses, "jira"))


def customer_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the users endpoint serves them; some without an address or a company."""
    customer = table(spark, sf_dir, "customer")
    geo = F.struct(F.col("c_acctbal").cast("string").alias("lat"), F.col("c_nationkey").cast("string").alias("lng"))
    address = F.struct(
        F.concat(F.lit("Street "), "c_nationkey").alias("street"),
        F.col("c_mktsegment").alias("city"),
        F.when(F.col("c_acctbal") > 0, geo).alias("geo"),
    )
    company = F.struct(F.col("c_name").alias("name"), F.lit("bs").alias("bs"))
    item = obj(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("username"),
        F.when(F.col("c_mktsegment") != "MACHINERY", address).alias("address"),
        F.when(F.col("c_mktsegment") != "FURNITURE", company).alias("company"),
    )
    responses = paged(customer, "c_custkey", 50, item).withColumn("body", F.col("items"))
    return rest_demo.rest_rows(landed(responses, "rest"), "users")


def order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    item = obj(
        F.col("o_custkey").alias("userId"),
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("title"),
        F.col("o_orderstatus").alias("body"),
    )
    responses = paged(orders, "o_orderkey", 100, item).withColumn("body", F.col("items"))
    return rest_demo.rest_rows(landed(responses, "rest"), "posts")


def order_albums(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    item = obj(
        F.col("o_custkey").alias("userId"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title")
    )
    responses = paged(orders, "o_orderkey", 100, item).withColumn("body", F.col("items"))
    return rest_demo.rest_rows(landed(responses, "rest"), "albums")


def line_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items, each answered by a body that is one object instead of a list."""
    lines = table(spark, sf_dir, "lineitem")
    item = obj(
        F.col("l_orderkey").alias("albumId"),
        F.col("l_partkey").alias("id"),
        F.concat("l_returnflag", "l_linestatus").alias("title"),
        F.concat(F.lit("http://x/"), "l_suppkey").alias("url"),
    )
    responses = lines.select(F.lit(0).alias("page_no"), item.alias("body"))
    return rest_demo.rest_rows(landed(responses, "rest"), "photos")


@query("""
SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, lower(c_name) AS username, '' AS email, '' AS phone,
       '' AS website,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'Street ' || c_nationkey ELSE '' END AS address_street,
       '' AS address_suite,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment ELSE '' END AS address_city,
       '' AS address_zipcode,
       CASE WHEN c_mktsegment <> 'MACHINERY' AND c_acctbal > 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END
           AS address_geo_lng,
       CASE WHEN c_mktsegment <> 'MACHINERY' AND c_acctbal > 0 THEN c_acctbal END AS latitude,
       CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_name ELSE '' END AS company_name,
       '' AS "company_catchPhrase", CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'bs' ELSE '' END AS company_bs
FROM customer""")
def rest_users_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = customer_users(spark, sf_dir)
    return users.withColumn("latitude", F.col("address_geo_lat").try_cast("double")).drop("address_geo_lat")


@query("""
SELECT CAST(o_orderkey AS INTEGER) AS id, CAST(o_custkey AS INTEGER) AS "userId",
       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE '' END AS title, o_orderstatus AS body,
       c_name AS user_name
FROM orders JOIN customer ON o_custkey = c_custkey""")
def rest_posts_users_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = customer_users(spark, sf_dir).select(F.col("id").alias("userId"), F.col("name").alias("user_name"))
    posts = order_posts(spark, sf_dir)
    return join_keyed(posts, users, "userId").select("id", "userId", "title", "body", "user_name")


@query("""
SELECT CAST(o_custkey AS INTEGER) AS "userId", CAST(l_orderkey AS INTEGER) AS "albumId",
       count(*) AS n_photos, min(l_partkey) AS first_photo,
       max(l_returnflag || l_linestatus) AS last_title
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY o_custkey, l_orderkey""")
def rest_user_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Photos are counted per album before the join, so a crowded album shuffles as one row.
    photos = (
        line_photos(spark, sf_dir)
        .groupBy("albumId")
        .agg(
            F.count("*").alias("n_photos"),
            F.min("id").cast("long").alias("first_photo"),
            F.max("title").alias("last_title"),
        )
    )
    albums = order_albums(spark, sf_dir).select("userId", F.col("id").alias("albumId"))
    users = customer_users(spark, sf_dir).select(F.col("id").alias("userId"))
    return join_keyed(photos.join(albums, "albumId"), users, "userId").select(
        "userId", "albumId", "n_photos", "first_photo", "last_title"
    )


@query("""
SELECT CAST(o_custkey AS INTEGER) AS "userId", CAST(o_orderkey AS INTEGER) AS id, o_orderpriority AS title,
       coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus = 'F' END, FALSE) AS completed
FROM orders ORDER BY o_orderkey LIMIT 200""")
def rest_todos_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    item = obj(
        F.col("o_custkey").alias("userId"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("title"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus") == "F").alias("completed"),
    )
    responses = paged(orders, "o_orderkey", 100, item).withColumn("body", F.col("items"))
    return rest_demo.first_rows(rest_demo.rest_rows(landed(responses, "rest"), "todos"), 200)


@query("""
SELECT CAST(conv_id AS INTEGER) AS "postId", CAST(turn AS INTEGER) AS id, role AS name, '' AS email, text AS body
FROM conversations""")
def rest_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    item = obj(
        F.col("conv_id").alias("postId"), F.col("turn").alias("id"), F.col("role").alias("name"), F.col("text").alias("body")
    )
    responses = turns.select(F.col("turn").alias("page_no"), F.concat(F.lit(" ["), item, F.lit("]")).alias("body"))
    return rest_demo.rest_rows(landed(responses, "rest"), "comments")


def part_properties():
    """A property bag whose title property goes by a varying name, first or last in the bag."""
    text = F.when(F.col("p_size") != 1, F.array(F.struct(F.col("p_name").alias("plain_text")))).otherwise(
        F.array().cast("array<struct<plain_text:string>>")
    )
    title = body('"Title ', F.col("p_brand"), '":', obj(F.lit("title").alias("type"), text.alias("title")))
    size = body('"Size":', obj(F.lit("number").alias("type"), F.col("p_size").alias("number")))
    tag = F.lit('"title":{"type":"select","select":{"name":"no title"}}')
    bag = F.when(F.col("p_type") == "ECONOMY", F.concat_ws(",", title, size)).otherwise(
        F.when(F.col("p_type") == "SMALL", F.concat_ws(",", size, tag)).otherwise(F.concat_ws(",", size, tag, title))
    )
    return F.concat(F.lit("{"), bag, F.lit("}"))


def part_pages(spark: SparkSession, sf_dir: str, size: int = 100) -> DataFrame:
    part = table(spark, sf_dir, "part")
    last = part.agg(F.max(F.expr(f"p_partkey div {size}")).alias("last_no"))
    marked = part.withColumn("last_no", last.scalar())
    item = F.concat(
        F.lit('{"id":"'), F.col("p_partkey"), F.lit('","created_time":"2024-01-02T03:04:05.000Z","last_edited_time":"'),
        F.date_format(F.timestamp_seconds(F.col("p_partkey") * 60), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        F.lit('","url":"https://x/'), F.col("p_partkey"), F.lit('","properties":'), part_properties(), F.lit("}"),
    )
    answers = paged(
        marked, "p_partkey", size, item, last_no=F.max("last_no"), lost=F.max((F.col("p_size") == 50).cast("int"))
    )
    more = F.col("page_no") < F.col("last_no")
    tail = F.when(more, body(',"has_more":true,"next_cursor":"', F.col("page_no") + 1, '"}')).otherwise(
        F.lit(',"has_more":false,"next_cursor":null}')
    )
    return answers.withColumn("body", body('{"results":', F.col("items"), tail))


@query("""
SELECT CAST(p_partkey AS VARCHAR) AS id,
       CASE WHEN p_type = 'SMALL' OR p_size = 1 THEN '' ELSE p_name END AS title,
       TIMESTAMP '2024-01-02 03:04:05' AS created_time,
       TIMESTAMP '1970-01-01 00:00:00' + p_partkey * INTERVAL 1 MINUTE AS last_edited_time,
       'https://x/' || p_partkey AS url, p_size AS size_property
FROM part""")
def notion_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pages.database_pages(landed(part_pages(spark, sf_dir), "notion"))
    size = F.get_json_object("properties", "$.Size.number").cast("int")
    return rows.select(
        "id",
        "title",
        ntz("created_time").alias("created_time"),
        ntz("last_edited_time").alias("last_edited_time"),
        "url",
        size.alias("size_property"),
    )


def embedding_points(spark: SparkSession, sf_dir: str, size: int = 100) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    last = vectors.agg(F.max(F.expr(f"vec_id div {size}")).alias("last_no"))
    marked = vectors.withColumn("last_no", last.scalar())
    sign = F.when(F.element_at("embedding", 1) > 0, "plus").otherwise("minus")
    payload = F.struct(F.col("label").alias("label"), F.struct(sign.alias("sign")).alias("tags"))
    item = obj(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("vector"),
        F.when(F.col("label") != 9, payload).alias("payload"),
        F.concat(F.lit("tenant-"), "label").alias("shard_key"),
        F.when(F.col("label") != 0, F.col("vec_id") * 10).alias("order_value"),
    )
    answers = paged(marked, "vec_id", size, item, last_no=F.max("last_no"), threes=F.count_if(F.col("label") == 3))
    next_offset = F.when(
        F.col("page_no") < F.col("last_no"), ((F.col("page_no") + 1) * size).cast("string")
    ).otherwise("null")
    return answers.withColumn(
        "body", body('{"result":{"points":', F.col("items"), ',"next_page_offset":', next_offset, "}}")
    )


@query("""
SELECT CAST(vec_id AS VARCHAR) AS id, 'tenant-' || label AS shard_key,
       CASE WHEN label <> 0 THEN vec_id * 10 END AS order_value,
       CASE WHEN label <> 9 THEN CAST(label AS VARCHAR) END AS payload_label,
       CAST(len(embedding) AS INTEGER) AS dimensions, CAST(embedding[1] AS DOUBLE) AS first_element,
       CAST(embedding[64] AS DOUBLE) AS last_element
FROM embeddings""")
def vector_points_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = points.typed_points(points.points(landed(embedding_points(spark, sf_dir), "points")))
    return rows.select(
        "id",
        "shard_key",
        "order_value",
        F.get_json_object("payload", "$.label").alias("payload_label"),
        F.size("vector").alias("dimensions"),
        F.element_at("vector", 1).cast("double").alias("first_element"),
        F.element_at("vector", 64).cast("double").alias("last_element"),
    )


@query("""
SELECT CAST(vec_id AS VARCHAR) AS id, 'tenant-' || label AS shard_key
FROM embeddings WHERE label = 3 AND embedding[1] > 0""")
def json_filter_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = {
        "must": [{"key": "label", "match": {"value": 3}}, {"key": "tags.sign", "match": {"value": "plus"}}]
    }
    rows = points.points(landed(embedding_points(spark, sf_dir), "points"), with_vector=False, condition=condition)
    return rows.select("id", "shard_key")


def quote_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes per event type and user; requests for sign-ups were turned away."""
    events = table(spark, sf_dir, "events")
    text = F.col("value").cast("string")
    price = F.when(F.col("event_type") == "click", "").when(F.col("event_type") == "error", "n/a").otherwise(text)
    item = obj(
        price.alias("price"),
        F.when(F.col("value") > 10, text).alias("bid_inclusive_of_sell_spread"),
        F.concat(F.lit(" "), text).alias("ask_inclusive_of_buy_spread"),
        F.when(F.col("event_type") != "view", F.col("event_id").cast("string")).alias("timestamp"),
    )
    answers = paged(events, "event_id", 100, item, "event_type", "user_id")
    answers = answers.withColumn("body", body('{"results":', F.col("items"), "}"))
    refused = F.when(F.col("event_type") == "signup", 429).otherwise(200)
    return landed(answers, "quotes", F.concat(F.upper("event_type"), F.lit("-"), "user_id"), refused)


@query("""
SELECT upper(event_type) || '-' || user_id AS symbol,
       CASE WHEN event_type IN ('click', 'error') THEN 0.0 ELSE value END AS price,
       CASE WHEN value > 10 THEN value ELSE 0.0 END AS bid_price, value AS ask_price,
       CASE WHEN event_type <> 'view' THEN CAST(event_id AS VARCHAR) ELSE '' END AS updated_at
FROM events WHERE event_type <> 'signup'""")
def quotes_best_bid_ask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.quotes(quote_responses(spark, sf_dir))


@query("""
SELECT DISTINCT upper(event_type) || '-' || user_id AS symbol FROM events WHERE event_type = 'signup'""")
def quotes_unanswered(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = quote_responses(spark, sf_dir)
    asked = responses.select(F.col("request_key").alias("symbol")).distinct()
    return market.unanswered(asked, responses)


def price_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One body per user with a bar per day; the number of days bounds its size."""
    events = table(spark, sf_dir, "events")
    when = F.struct("ts", "event_id")
    days = events.groupBy("user_id", F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(
        F.min_by("value", when).alias("o"),
        F.max("value").alias("h"),
        F.min("value").alias("l"),
        F.max_by("value", when).alias("c"),
        F.count("*").alias("n"),
    )
    bar = obj(
        F.col("o").cast("string").alias("1. open"),
        F.col("h").cast("string").alias("2. high"),
        F.col("l").cast("string").alias("3. low"),
        F.col("c").cast("string").alias("4. close"),
        (F.col("n") * 100).cast("string").alias("5. volume"),
    )
    entry = body('"', F.col("day"), '":', bar)
    bodies = days.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_list(entry)), ",").alias("bars"))
    return landed(
        bodies.select(
            "user_id",
            F.lit(0).alias("page_no"),
            body('{"Meta Data":{"1. Information":"x"},"Time Series (Daily)":{', F.col("bars"), "}}").alias("body"),
        ),
        "stock",
        F.concat(F.lit("U"), "user_id"),
    )


BARS_SQL = """
SELECT strftime(max(ts), '%Y-%m-%d') AS date, first(value ORDER BY ts, event_id) AS open, max(value) AS high,
       min(value) AS low, last(value ORDER BY ts, event_id) AS close, CAST(count(*) * 100 AS BIGINT) AS volume,
       'U' || user_id AS symbol
FROM events GROUP BY user_id, date_trunc('{unit}', ts)"""


@query(BARS_SQL.format(unit="day"))
def ohlcv_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.price_bars(price_responses(spark, sf_dir))


@query(BARS_SQL.format(unit="week"))
def ohlcv_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.rollup_bars(market.price_bars(price_responses(spark, sf_dir)), "week")


@query(BARS_SQL.format(unit="month"))
def ohlcv_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.rollup_bars(market.price_bars(price_responses(spark, sf_dir)), "month")


def state_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional states of mixed type: short after a sign-up, without longitude after an error."""
    events = table(spark, sf_dir, "events")
    kind, seconds = F.col("event_type"), F.unix_seconds(F.col("ts").cast("timestamp"))

    def null_when(name: str, col: Column) -> Column:
        return F.when(kind == name, "null").otherwise(col.cast("string"))

    slots = [
        F.concat(F.lit('"'), F.lpad(F.lower(F.hex("user_id")), 6, "0"), F.lit('"')),
        F.lit('"CALL  "'),
        F.concat(F.lit('"'), kind, F.lit('"')),
        null_when("click", seconds),
        (seconds + 5).cast("string"),
        null_when("error", F.col("event_id") * 7 % 360 - 180.5),
        (F.col("event_id") % 180 - 90).cast("string"),
        F.col("value").cast("string"),
        F.when(F.col("value") > 50, "true").otherwise("false"),
        null_when("view", F.col("value")),
        F.lit("90"),
        F.lit('"climbing"'),
        null_when("purchase", F.concat(F.lit("[1,"), F.col("user_id"), F.lit("]"))),
        F.lit("1000.5"),
        F.lit('"7700"'),
        F.lit("false"),
    ]
    short = F.concat_ws(",", *slots)
    full = F.concat_ws(",", short, F.col("user_id"))
    state = body("[", F.when(kind == "signup", short).otherwise(full), "]")
    answers = paged(events, "event_id", 100, state)
    polled = 1704067200 + F.col("page_no") * 10
    return landed(answers.withColumn("body", body('{"time":', polled, ',"states":', F.col("items"), "}")), "aircraft")


STATES_SQL = """
SELECT TIMESTAMP '2024-01-01 00:00:00' + (event_id // 100) * INTERVAL 10 SECOND AS time_ingest,
       lower(lpad(printf('%X', user_id), 6, '0')) AS icao24, 'CALL  ' AS callsign, event_type AS origin_country,
       CASE WHEN event_type <> 'click' THEN date_trunc('second', ts) END AS time_position,
       date_trunc('second', ts) + INTERVAL 5 SECOND AS last_contact,
       CAST(event_id * 7 % 360 - 180.5 AS DOUBLE) AS longitude, CAST(event_id % 180 - 90 AS DOUBLE) AS latitude,
       value AS geo_altitude, value > 50 AS on_ground, CASE WHEN event_type <> 'view' THEN value END AS velocity,
       CAST(90 AS DOUBLE) AS true_track, CAST(NULL AS DOUBLE) AS vertical_rate,
       CASE WHEN event_type <> 'purchase' THEN CAST(user_id AS INTEGER) END AS second_sensor,
       CAST(1000.5 AS DOUBLE) AS baro_altitude, '7700' AS squawk, FALSE AS spi, CAST(user_id AS INTEGER) AS category
FROM events WHERE event_type NOT IN ('signup', 'error')"""


def flat_states(states: DataFrame) -> DataFrame:
    return (
        states.withColumn("second_sensor", F.get("sensors", F.lit(1)))
        .drop("sensors")
        .withColumns({c: ntz(c) for c in ("time_ingest", "time_position", "last_contact")})
    )


@query(STATES_SQL)
def aircraft_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_states(aircraft.aircraft_states(state_responses(spark, sf_dir)))


@query(f"""
SELECT * FROM ({STATES_SQL}) WHERE latitude BETWEEN 35 AND 72 AND longitude BETWEEN -25 AND 45""")
def aircraft_in_europe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_states(aircraft.aircraft_states(state_responses(spark, sf_dir), region="europe"))


def timeline_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timelines of each user's location, at most 100 entries a response."""
    events = table(spark, sf_dir, "events")
    item = obj(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
        F.struct(F.col("value").alias("temperature"), F.col("event_type").alias("code")).alias("values"),
    )
    answers = paged(events, "event_id", 100, item, "user_id")
    answers = answers.withColumn("body", body('{"timelines":{"hourly":[],"minutely":', F.col("items"), "}}"))
    return landed(answers, "weather", F.concat("user_id", F.lit(".5,-"), "user_id", F.lit(".25")))


def user_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A starting time for every user's location, some after the last event."""
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    start = F.timestamp_seconds(F.lit(1704844800) + F.col("user_id") * 14400)
    return users.select(
        F.concat("user_id", F.lit(".5,-"), "user_id", F.lit(".25")).alias("location"),
        F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("last_time"),
    )


OFFSET_SQL = "strftime(TIMESTAMP '2024-01-10' + user_id * INTERVAL 4 HOUR, '%Y-%m-%dT%H:%M:%SZ')"


@query(f"""
SELECT user_id || '.5,-' || user_id || '.25' AS location, CAST(user_id + 0.5 AS DOUBLE) AS latitude,
       CAST(-(user_id + 0.25) AS DOUBLE) AS longitude, value AS temperature, event_type AS code,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp
FROM events WHERE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') > {OFFSET_SQL}""")
def incremental_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = weather.timeline_entries(timeline_responses(spark, sf_dir))
    fresh = weather.newer_than(entries, user_offsets(spark, sf_dir), "location", "timestamp")
    values = F.from_json("weather", "temperature DOUBLE, code STRING")
    return fresh.select("location", "latitude", "longitude", values.alias("v"), "timestamp").select(
        "location", "latitude", "longitude", "v.temperature", "v.code", "timestamp"
    )


@query(f"""
SELECT user_id || '.5,-' || user_id || '.25' AS location,
       greatest({OFFSET_SQL}, max(strftime(ts, '%Y-%m-%dT%H:%M:%SZ'))) AS last_time
FROM events GROUP BY user_id""")
def next_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = weather.timeline_entries(timeline_responses(spark, sf_dir))
    return weather.next_offsets(entries, user_offsets(spark, sf_dir), "location", "timestamp")


@query("""
SELECT CAST(o_custkey AS INTEGER) AS "userId", CAST(o_orderkey AS INTEGER) AS id, o_orderpriority AS title,
       '' AS body, o_orderkey // 50 AS page_no
FROM orders""")
def rest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    item = obj(
        F.col("o_custkey").alias("userId"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title")
    )
    requests = paged(orders, "o_orderkey", 50, item).select(
        F.concat(F.lit("posts?page="), "page_no").alias("request_key"), "page_no", F.col("items").alias("answer")
    )

    def get(request: dict[str, Any]) -> tuple[int, str]:
        return 200, request["answer"]

    responses = stage(fetch(requests, "rest", get), "rest-pages")
    rows = rest_demo.rest_rows(responses, "posts")
    return rows.withColumn("page_no", F.expr("CAST(id AS BIGINT) div 50"))


WORD_LISTS = {
    name: "[" + ", ".join(f"'{w}'" for w in generate.WORDS[name]) + "]"
    for name in ("first_name", "last_name", "state", "company_suffix", "domain")
}


def draw_sql(stream: str, bound: int) -> str:
    """The generator's draw of a number below ``bound``, as SQL."""
    digest = f"md5('7:{stream}:' || c_custkey)"
    return f"CAST(CAST('0x' || substr({digest}, 1, 8) AS BIGINT) % {bound} AS INTEGER)"


def word_sql(stream: str, words: str) -> str:
    return f"({WORD_LISTS[words]})[{draw_sql(stream, len(generate.WORDS[words]))} + 1]"


@query(f"""
SELECT c_custkey, {word_sql('first_name', 'first_name')} || ' ' || {word_sql('last_name', 'last_name')} AS name,
       strftime(DATE '{generate.FIRST_DAY}' + {draw_sql('date', generate.DAY_SPAN)}, '%Y-%m-%d') AS date,
       lpad(CAST({draw_sql('zipcode', 100_000)} AS VARCHAR), 5, '0') AS zipcode,
       {word_sql('state', 'state')} AS state,
       {word_sql('company', 'last_name')} || ' ' || {word_sql('company_suffix', 'company_suffix')} AS company,
       lower({word_sql('first_name', 'first_name')}) || '.' || lower({word_sql('last_name', 'last_name')}) || '@' ||
           {word_sql('domain', 'domain')} AS email
FROM customer""")
def fake_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = f"{generate.DEFAULT_SCHEMA}, company string, email string"
    return generate.fake_columns(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", schema, seed=7)


@query("""
WITH n AS (SELECT count(*) AS total FROM orders),
     p AS (SELECT i, total, i * total // 8 AS lo, (i + 1) * total // 8 AS hi
           FROM n, (SELECT unnest(generate_series(0, 7)) AS i))
SELECT CAST(i AS INTEGER) AS partition_no, hi - lo AS n_rows, lo AS first_id, hi - 1 AS last_id FROM p""")
def range_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = table(spark, sf_dir, "orders").count()
    ids = generate.counted_ranges(spark, total, 8)
    return ids.groupBy("partition_no").agg(
        F.count("*").alias("n_rows"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )
