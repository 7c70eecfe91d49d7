"""Plans, predicates, checks and scalar functions on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import landed, query, table
from catalog.reads import embedding_points, part_pages
from drayage.functions import convert, sheets
from drayage.functions.nested import is_json, json_text
from drayage.operators.contract import ColumnRule, contract_report as report
from drayage.operators.rejects import REASON, with_reason
from drayage.plans import paging, ranges, regions
from drayage.sources import pages, points


@query("""
SELECT count(*) AS n_rows, count(*) FILTER (event_id IS NULL) AS event_id_missing,
       count(*) FILTER (event_type NOT IN ('click', 'view', 'purchase', 'signup')) AS event_type_not_allowed,
       count(*) FILTER (value < 1) AS value_below_min, count(*) FILTER (value > 100) AS value_above_max,
       count(*) FILTER (event_type = 'error') AS props_bad_json
FROM events""")
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("props", damaged_props())
    return report(
        events,
        {
            "event_id": ColumnRule(type="bigint", required=True),
            "event_type": ColumnRule(type="string", allowed=("click", "view", "purchase", "signup")),
            "value": ColumnRule(type="double", minimum=1.0, maximum=100.0),
            "props": ColumnRule(json=True),
        },
    )


def damaged_props():
    """The properties, with the closing brace cut off for errors."""
    return F.when(F.col("event_type") == "error", F.expr("substr(props, 1, length(props) - 1)")).otherwise(
        F.col("props")
    )


@query("""
SELECT event_id, event_type = 'error' AS rejected,
       CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k
FROM events""")
def json_or_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("props", damaged_props())
    checked = json_text(events, "props", on_bad="null")
    return events.withColumn("checked", checked).select(
        "event_id",
        F.col("checked").isNull().alias("rejected"),
        F.get_json_object("checked", "$.k").cast("int").alias("k"),
    )


@query("""
SELECT CASE WHEN value < 1 THEN 'value too small' WHEN event_type = 'error' THEN 'props not valid JSON'
            ELSE 'good' END AS side,
       count(*) AS n_rows, min(event_id) AS first_id, max(event_id) AS last_id
FROM events GROUP BY 1""")
def reject_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("props", damaged_props())
    rules = {"value too small": F.col("value") < 1, "props not valid JSON": ~is_json(F.col("props"))}
    side = F.coalesce(REASON, F.lit("good")).alias("side")
    return (
        with_reason(events, rules)
        .groupBy(side)
        .agg(F.count("*").alias("n_rows"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"))
    )


SHEET_URL_SQL = """
SELECT page_id, CASE WHEN url LIKE 'https:%' THEN 'https://docs.google.com/spreadsheets/d/key' || page_id || '/edit'
                       || CASE WHEN contains(url, '?') THEN '?gid=' || page_id ELSE '' END || '#gid=0'
                     ELSE url END AS url
FROM pages"""


def sheet_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    address = F.concat(
        F.lit("https://docs.google.com/spreadsheets/d/key"),
        F.col("page_id"),
        F.lit("/edit"),
        F.when(F.contains("url", F.lit("?")), F.concat(F.lit("?gid="), "page_id")).otherwise(""),
        F.lit("#gid=0"),
    )
    url = F.when(F.startswith("url", F.lit("https:")), address).otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


@query(f"""
SELECT page_id, url LIKE 'https://docs.google.com/spreadsheets/d/%' AS is_sheet,
       CASE WHEN url LIKE 'https://docs.google.com/spreadsheets/d/%' THEN 'key' || page_id END AS spreadsheet,
       CASE WHEN url LIKE 'https://docs.google.com/spreadsheets/d/%' AND contains(url, '?gid=')
            THEN CAST(page_id AS VARCHAR) END AS worksheet
FROM ({SHEET_URL_SQL})""")
def sheet_url_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return sheet_urls(spark, sf_dir).select(
        "page_id",
        sheets.is_sheet_url(url).alias("is_sheet"),
        sheets.spreadsheet_id(url).alias("spreadsheet"),
        sheets.worksheet_id(url).alias("worksheet"),
    )


@query(f"""
SELECT page_id, 'https://docs.google.com/spreadsheets/d/key' || page_id || '/gviz/tq?tqx=out%3Acsv'
       || CASE WHEN contains(url, '?gid=') THEN '&gid=' || page_id ELSE '' END
       || '&tq=select+*+limit+' || page_id || '+offset+%26+%22x%22' AS export_url
FROM ({SHEET_URL_SQL}) WHERE url LIKE 'https://docs.google.com/spreadsheets/d/%'""")
def sheet_query_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    wanted = F.concat(F.lit("select * limit "), "page_id", F.lit(' offset & "x"'))
    export = sheets.csv_export_url(sheets.spreadsheet_id(url), sheets.worksheet_id(url), wanted)
    return sheet_urls(spark, sf_dir).where(sheets.is_sheet_url(url)).select("page_id", export.alias("export_url"))


@query("""
SELECT c_custkey, trim(s) AS symbol
FROM (SELECT c_custkey, unnest(string_split(c_mktsegment || ' , ' || c_name || ',' || c_nationkey, ',')) AS s
      FROM customer)""")
def symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    text = F.concat("c_mktsegment", F.lit(" , "), "c_name", F.lit(","), "c_nationkey")
    return ranges.symbol_rows(customer.select("c_custkey", text.alias("symbols")), "symbols")


@query("""
SELECT p_partkey, CASE WHEN contains(s, '-') THEN s ELSE s || '-USD' END AS symbol
FROM (SELECT p_partkey, upper(trim(s)) AS s
      FROM (SELECT p_partkey, unnest(string_split(p_name || ', ' || p_type || '-eur,, ,' || p_brand, ',')) AS s
            FROM part))
WHERE s <> ''""")
def symbol_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    text = F.concat("p_name", F.lit(", "), "p_type", F.lit("-eur,, ,"), "p_brand")
    return ranges.symbol_rows(part.select("p_partkey", text.alias("symbols")), "symbols", pairs=True)


@query("""
WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders),
     w AS (SELECT lo, greatest((hi - lo + 8) // 8, 1) AS width FROM b),
     p AS (SELECT CAST(i AS INTEGER) AS part_no, CASE WHEN i > 0 THEN lo + i * width END AS lower,
                  CASE WHEN i < 7 THEN lo + (i + 1) * width END AS upper
           FROM w, (SELECT unnest(generate_series(0, 7)) AS i))
SELECT part_no, lower, upper,
       CASE WHEN lower IS NULL THEN 'o_orderkey < ' || upper || ' or o_orderkey is null'
            WHEN upper IS NULL THEN 'o_orderkey >= ' || lower
            ELSE 'o_orderkey >= ' || lower || ' and o_orderkey < ' || upper END AS predicate
FROM p""")
def range_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.range_plan(table(spark, sf_dir, "orders"), "o_orderkey", 8)


@query("""
SELECT CAST(unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY)) AS DATE) AS day FROM events""")
def date_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranges.date_plan(table(spark, sf_dir, "events"), "ts")


@query("""
WITH t AS (SELECT o_orderpriority AS request_key, count(*) AS total FROM orders GROUP BY 1),
     p AS (SELECT request_key, total, unnest(generate_series(0, (total - 1) // 50)) AS page_no FROM t)
SELECT request_key, page_no, page_no * 50 AS start_at,
       CAST(least(50, total - page_no * 50) AS INTEGER) AS max_results
FROM p""")
def pages_offset_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("request_key"))
    return paging.offset_pages(totals.agg(F.count("*").alias("total")), 50)


@query("""
WITH p AS (SELECT p_partkey // 20 AS page_no, bool_or(p_size = 50) AS lost FROM part GROUP BY 1),
     last AS (SELECT max(page_no) FILTER (NOT lost) AS landed, max(page_no) AS final FROM p)
SELECT 'notion' AS request_key, page_no FROM p, last
WHERE lost AND page_no <= least(landed + 1, final)""")
def pages_cursor_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = part_pages(spark, sf_dir, size=20)
    arrived = landed(answers.where("lost = 0"), "notion")
    return paging.missing_pages(pages.cursor_pages(arrived))


@query("""
WITH p AS (SELECT vec_id // 20 AS page_no, count(*) FILTER (label = 3) > 3 AS lost FROM embeddings GROUP BY 1),
     n AS (SELECT page_no, lost, lead(lost) OVER (ORDER BY page_no) AS next_lost FROM p)
SELECT 'points' AS request_key, page_no, CAST((page_no + 1) * 20 AS VARCHAR) AS next_offset
FROM n WHERE NOT lost AND next_lost""")
def pages_chain_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    answers = embedding_points(spark, sf_dir, size=20)
    scrolled = points.scroll_pages(landed(answers.where("threes <= 3"), "points"))
    own = scrolled.withColumn("offset", (F.col("page_no") * 20).cast("string"))
    return paging.broken_links(own).select("request_key", "page_no", "next_offset")


@query("""
SELECT event_id, r.name AS region
FROM (SELECT event_id, event_id % 180 - 90.0 AS lat, event_id * 7 % 360 - 180.0 AS lon FROM events)
JOIN (VALUES ('EUROPE', 35, 72, -25, 45), ('NORTH_AMERICA', 7, 72, -168, -60), ('SOUTH_AMERICA', -56, 15, -90, -30),
             ('ASIA', -10, 82, 45, 180), ('AUSTRALIA', -50, -10, 110, 180), ('AFRICA', -35, 37, -20, 52),
             ('GLOBAL', -90, 90, -180, 180)) AS r(name, south, north, west, east)
  ON lat BETWEEN south AND north AND lon BETWEEN west AND east""")
def bbox_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("event_id") % 180 - 90).cast("double").alias("latitude"),
        (F.col("event_id") * 7 % 360 - 180).cast("double").alias("longitude"),
    )
    return regions.with_regions(events).select("event_id", "region")


@query("""
SELECT c_custkey,
       CASE WHEN c_mktsegment = 'BUILDING' THEN sha256(lower(c_name))
            ELSE sha256(lower(c_name) || '@x.org') END AS em,
       sha256('+' || c_nationkey || ' ' || c_custkey) AS ph
FROM customer""")
def pii_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    plain = F.concat(F.lit(" "), F.upper("c_name"), F.lit("@X.org\t"))
    email = F.when(F.col("c_mktsegment") == "BUILDING", F.sha2(F.lower("c_name"), 256)).otherwise(plain)
    phone = F.concat(F.lit(" +"), "c_nationkey", F.lit(" "), "c_custkey", F.lit("\n"))
    return customer.select(
        "c_custkey", convert.hashed_email(email).alias("em"), convert.hashed_phone(phone).alias("ph")
    )


@query("""
SELECT event_id, c_custkey
FROM (SELECT event_id, event_id * 37 % 18000 / 100.0 - 90 AS lat, event_id * 7919 % 36000 / 100.0 - 180 AS lon FROM events)
JOIN (SELECT c_custkey, c_custkey * 131 % 17000 / 100.0 - 90 AS south, c_custkey * 173 % 36000 / 100.0 - 180 AS west,
             1 + c_nationkey * (CASE WHEN c_custkey % 500 = 0 THEN 3 ELSE 0.1 END) AS size FROM customer)
  ON lat BETWEEN south AND south + size
 AND (lon BETWEEN west AND west + size OR lon + 360 BETWEEN west AND west + size)""")
def points_in_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as points, a box of one to many degrees for every customer; some reach over the date line."""
    points = table(spark, sf_dir, "events").select(
        "event_id",
        (F.col("event_id") * 37 % 18000 / 100 - 90).alias("latitude"),
        (F.col("event_id") * 7919 % 36000 / 100 - 180).alias("longitude"),
    )
    size = 1 + F.col("c_nationkey") * F.when(F.col("c_custkey") % 500 == 0, 3.0).otherwise(0.1)
    south, west = F.col("c_custkey") * 131 % 17000 / 100 - 90, F.col("c_custkey") * 173 % 36000 / 100 - 180
    east = west + size
    boxes = table(spark, sf_dir, "customer").select(
        "c_custkey",
        south.alias("south"),
        (south + size).alias("north"),
        west.alias("west"),
        F.when(east >= 180, east - 360).otherwise(east).alias("east"),
    )
    return regions.in_boxes(points, boxes).select("event_id", "c_custkey")


@query("""
WITH page AS (SELECT p_partkey // 5 AS n, p_partkey // 5 % 3 AS kind, max(p_size) AS size FROM part GROUP BY 1, 2),
     there AS (SELECT *, lead(n) OVER chain AS later, n + 3 AS next FROM page
               WHERE NOT (kind = 1 AND size % 7 = 0) WINDOW chain AS (PARTITION BY kind ORDER BY n)),
     final AS (SELECT max(n) AS n FROM page),
     cut AS (SELECT *, next > (SELECT n FROM final) AS over,
                    sum(CASE WHEN later IS DISTINCT FROM next THEN 1 ELSE 0 END) OVER
                        (PARTITION BY kind ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS part FROM there),
     placed AS (SELECT *, row_number() OVER w - 1 AS position, last_value(n) OVER w AS last_n,
                       count(*) OVER w - row_number() OVER w AS following, last_value(over) OVER w AS ended
                FROM cut WINDOW w AS (PARTITION BY kind, coalesce(part, 0) ORDER BY n
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT 'list-' || kind AS request_key, n AS "offset",
       CASE WHEN kind = 2 THEN 'cycle' WHEN ended THEN 'complete' ELSE 'broken' END AS state,
       CASE WHEN kind <> 2 THEN last_n END AS last,
       CASE WHEN kind <> 2 THEN following END AS following, CASE WHEN kind <> 2 THEN position END AS position
FROM placed""")
def pages_chain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three listings: one whole, one with pages missing, one whose last page leads back to its first."""
    number = F.expr("p_partkey div 5")
    pages = table(spark, sf_dir, "part").groupBy(number.alias("offset")).agg(F.max("p_size").alias("size"))
    kind = F.col("offset") % 3
    (final,) = pages.agg(F.max("offset")).first()
    after = F.when(F.col("offset") + 3 <= final, F.col("offset") + 3).when(kind == 2, F.lit(2).cast("long"))
    links = pages.where(~((kind == 1) & (F.col("size") % 7 == 0))).select(
        F.concat(F.lit("list-"), kind).alias("request_key"), "offset", after.alias("next_offset")
    )
    return paging.chain_order(links)
