"""Streaming twins: the same rows as in batch, through micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import body, landed, obj, paged, query, table
from catalog.reads import OFFSET_SQL, STATES_SQL, flat_states, state_responses, timeline_responses, user_offsets
from catalog.sinks import EVENTS_SQL, LIST_FIELDS, LIST_SQL, conversion_rows, customer_records, event_fields
from catalog.sinks import list_fields, list_rows
from drayage.operators.outcomes import record_outcomes
from drayage.scratch import delete, new_path, stage
from drayage.sinks import events as event_sink, list_items, records
from drayage.sources import weather
from drayage.streaming.outboxes import outbox_stream, read_outbox
from drayage.streaming.pollers import polling_stream
from drayage.streaming.readers import (
    aircraft_stream,
    incremental_stream,
    landed_stream,
    new_file_stream,
    weather_stream,
)
from drayage.streaming.senders import sending_stream, sent


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over what is there and read the table it wrote."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    running = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", new_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def half_of(spark: SparkSession, path: str) -> int:
    """Files per micro-batch for two micro-batches, whatever the size of the table."""
    return max(1, -(-len(spark.read.parquet(path).inputFiles()) // 2))


def stream_of(rows: DataFrame, label: str) -> DataFrame:
    """The rows again, as a file stream of two micro-batches."""
    spark = rows.sparkSession
    path = new_path(spark, label)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(files).write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", half_of(spark, path)).parquet(path)


@query(STATES_SQL)
def aircraft_stream_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "landed")
    state_responses(spark, sf_dir).write.parquet(path)
    states = aircraft_stream(landed_stream(spark, path, files_per_batch=half_of(spark, path)))
    return flat_states(run_to_table(states, "states"))


@query(f"""
SELECT user_id || '.5,-' || user_id || '.25' AS location, CAST(user_id + 0.5 AS DOUBLE) AS latitude,
       strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS timestamp
FROM events WHERE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') > {OFFSET_SQL}""")
def weather_stream_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, out = new_path(spark, "landed"), new_path(spark, "entries")
    timeline_responses(spark, sf_dir).write.parquet(path)
    entries = weather.timeline_entries(landed_stream(spark, path), on_error="skip")
    running = incremental_stream(
        entries,
        stage(user_offsets(spark, sf_dir), "offsets"),
        "location",
        "timestamp",
        out,
        new_path(spark, "offsets"),
        new_path(spark, "checkpoint"),
    )
    running.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("location", "latitude", "timestamp")


def run_now(writer) -> None:
    writer.trigger(availableNow=True).start().awaitTermination()


# One reading per user and second, a year later than its event; every third is in the early polls.
READINGS_SQL = """
SELECT user_id, strftime(ts + INTERVAL 366 DAY, '%Y-%m-%dT%H:%M:%SZ') AS t, max(value) AS v, max(event_id) % 3 = 0 AS early
FROM events GROUP BY 1, 2"""


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    late = F.date_format(F.col("ts") + F.expr("INTERVAL 366 DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = events.groupBy("user_id", late.alias("t")).agg(F.max("value").alias("v"), F.max("event_id").alias("event_id"))
    return rows.withColumn("early", F.col("event_id") % 3 == 0)


def reading_answers(rows: DataFrame, added: int, minute: int) -> DataFrame:
    """A poll in which every reading is so much larger, as landed responses."""
    item = obj(F.col("t").alias("time"), F.struct((F.col("v") + added).alias("temperature")).alias("values"))
    answers = paged(rows, "event_id", 100, item, "user_id")
    answers = answers.withColumn("body", body('{"timelines":{"minutely":', F.col("items"), "}}"))
    place = F.concat("user_id", F.lit(".5,-"), "user_id", F.lit(".25"))
    return landed(answers, "weather", place).withColumn("fetched_at", F.expr(f"fetched_at + INTERVAL {minute} MINUTES"))


@query(f"""
SELECT user_id + 0.5::DOUBLE AS latitude, t AS timestamp, v + CASE WHEN early THEN 2 ELSE 3 END AS temperature
FROM (SELECT *, max(CASE WHEN early THEN t END) OVER (PARTITION BY user_id) AS seen FROM ({READINGS_SQL}))
WHERE early OR seen IS NULL OR t > seen""")
def weather_stream_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping polls in one micro-batch, of which the later counts, and a third in the next."""
    path, out, checkpoint = (new_path(spark, n) for n in ("landed", "entries", "checkpoint"))
    rows = stage(readings(spark, sf_dir), "readings")
    early = rows.where("early")
    polls = [reading_answers(early, 1, 0).unionByName(reading_answers(early, 2, 1)), reading_answers(rows, 3, 2)]
    for poll in polls:
        poll.write.mode("append").parquet(path)
        fresh = weather_stream(spark, path)
        run_now(fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))
    temperature = F.from_json("weather", "temperature DOUBLE")["temperature"]
    found = spark.read.schema(fresh.schema).parquet(out)
    return found.select("latitude", "timestamp", temperature.alias("temperature"))


@query(f"""
SELECT user_id + 0.5::DOUBLE AS latitude, t AS timestamp, v AS temperature FROM ({READINGS_SQL})""")
def weather_polled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three polls of all locations, one half failed and one without any answer: every entry comes once."""
    path, out, checkpoint, polls = (new_path(spark, n) for n in ("landed", "entries", "checkpoint", "polls"))
    answers = reading_answers(readings(spark, sf_dir), 0, 0)
    # All pages of a place are one answer here, as its timeline is.
    entry = "STRUCT<time: STRING, values: STRING>"
    lists = F.collect_list(F.from_json("body", f"timelines STRUCT<minutely: ARRAY<{entry}>>")["timelines"]["minutely"])
    places = answers.groupBy("request_key").agg(F.flatten(lists).alias("minutely"))
    values = F.transform("minutely", lambda e: F.concat(F.lit('{"time":"'), e["time"], F.lit('","values":'), e["values"], F.lit("}")))
    timeline = F.concat(F.lit('{"timelines":{"minutely":['), F.array_join(values, ","), F.lit("]}}"))
    requests = stage(places.select("request_key", F.lit(0).cast("long").alias("page_no"), timeline.alias("answer")), "places")

    def half(request: dict) -> tuple[int, str]:
        return (404, "gone") if int(request["request_key"].split(".")[0]) % 2 else (200, request["answer"])

    def every(request: dict) -> tuple[int, str]:
        return 200, request["answer"]

    def none(request: dict) -> tuple[int, str]:
        return 403, "forbidden"

    for get in (half, none, every):
        run_now(polling_stream(spark, requests, "weather", get, path, polls))
        fresh = weather_stream(spark, path)
        run_now(fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint))
    temperature = F.from_json("weather", "temperature DOUBLE")["temperature"]
    found = spark.read.schema(fresh.schema).parquet(out)
    return found.select("latitude", "timestamp", temperature.alias("temperature"))


def last_commit(spark: SparkSession, checkpoint: str) -> int:
    commits = spark.read.format("binaryFile").load(f"{checkpoint}/commits").select("path").collect()
    return max(int(row[0].rsplit("/", 1)[1]) for row in commits)


@query("""
SELECT c_custkey AS record, CASE WHEN c_acctbal > 9500 THEN 'refused' ELSE 'accepted' END AS verdict,
       CAST(CASE WHEN c_acctbal > 9500 THEN 0 ELSE 1 END AS BIGINT) AS times_accepted FROM customer""")
def records_sent_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records streamed into an outbox and sent by a second stream, the last batch of which runs twice."""
    outbox, outcomes, checkpoint = (new_path(spark, n) for n in ("outbox", "outcomes", "sender"))
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("Number"), F.col("c_name").alias("Name"), F.col("c_acctbal").alias("Balance")
    )
    build = lambda batch: records.record_outbox(batch, "Account", "Number", batch_size=25)
    run_now(outbox_stream(stream_of(customers, "records"), build, outbox, new_path(spark, "checkpoint")))

    def send(request: dict) -> dict:
        import json

        if request["attempt"] == 1 and request["n_records"] == 25 and request["batch_id"].endswith("1"):
            return {"status": 503, "error": "busy"}
        bad = any(r["Balance"] > 9500 for r in json.loads(request["body"])["records"])
        return {"status": 400, "error": "no"} if bad else {"status": 201}

    for _ in range(2):
        run_now(sending_stream(spark, outbox, outcomes, checkpoint, send, base_seconds=0.01))
        # As if the driver had died before the last commit: the next run starts with that batch again.
        delete(spark, f"{checkpoint}/commits/{last_commit(spark, checkpoint)}")
    requests = read_outbox(spark, outbox)
    answers = sent(spark, outcomes)
    found = record_outcomes(requests, answers)
    numbers = F.from_json("body", "records ARRAY<STRUCT<Number: BIGINT>>")["records"]
    ids = requests.select("idem_key", F.posexplode(numbers["Number"]).alias("position", "record"))
    whole = requests.select(F.col("idem_key").alias("request_key"), F.sequence(F.lit(0), F.col("n_records") - 1).alias("_all"))
    taken = answers.where("status = 201").join(whole, "request_key")
    taken = taken.select(F.col("request_key").alias("idem_key"), F.explode(F.coalesce("positions", "_all")).alias("position"))
    times = taken.groupBy("idem_key", "position").agg(F.count("*").alias("times_accepted"))
    joined = ids.join(found, ["idem_key", "position"]).join(times, ["idem_key", "position"], "left")
    return joined.select("record", "verdict", F.coalesce("times_accepted", F.lit(0)).alias("times_accepted"))


@query(EVENTS_SQL)
def capi_stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "outbox")
    rows = stream_of(conversion_rows(spark, sf_dir), "events")
    build = lambda batch: event_sink.event_outbox(batch, "pixel", "event_id")
    running = outbox_stream(rows, build, path, new_path(spark, "checkpoint"))
    running.trigger(availableNow=True).start().awaitTermination()
    return event_fields(read_outbox(spark, path))


@query("""
SELECT count(*) AS n_records, count(DISTINCT c_name) AS n_names, max(c_custkey) AS last_number FROM customer""")
def record_stream_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "outbox")
    customers = customer_records(spark, sf_dir).withColumn("Name", F.concat(F.lit("Customer#"), "Number"))
    rows = stream_of(customers, "records")
    build = lambda batch: records.record_outbox(batch, "Account", "Number")
    running = outbox_stream(rows, build, path, new_path(spark, "checkpoint"))
    running.trigger(availableNow=True).start().awaitTermination()
    ddl = "records ARRAY<STRUCT<Number: BIGINT, Name: STRING>>"
    sent = read_outbox(spark, path).select(F.inline(F.from_json("body", ddl)["records"]))
    return sent.agg(
        F.count("*").alias("n_records"), F.countDistinct("Name").alias("n_names"), F.max("Number").alias("last_number")
    )


@query(LIST_SQL)
def list_item_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "outbox")
    rows = stream_of(list_rows(spark, sf_dir), "items")
    build = lambda batch: list_items.list_item_outbox(batch, "s", "l", LIST_FIELDS)
    running = outbox_stream(rows, build, path, new_path(spark, "checkpoint"))
    running.trigger(availableNow=True).start().awaitTermination()
    return list_fields(read_outbox(spark, path))


@query("""
SELECT count(*) AS n_lines, CAST(sum(length(value)) AS BIGINT) AS n_chars
FROM (SELECT unnest(string_split(text, chr(10))) AS value FROM documents)""")
def new_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "watched")
    # A file is one row of the stream, so files are kept small.
    table(spark, sf_dir, "documents").select("text").write.option("maxRecordsPerFile", 250).text(path)
    files = new_file_stream(spark, path, "*.txt").select("path", F.decode("content", "UTF-8").alias("content"))
    seen = run_to_table(files, "files")
    # Every file ends with a line feed, so the part after it is no line.
    lines = seen.select(F.explode(F.expr("slice(split(content, '\\n'), 1, size(split(content, '\\n')) - 1)")).alias("v"))
    return lines.agg(F.count("*").alias("n_lines"), F.sum(F.length("v")).alias("n_chars"))
