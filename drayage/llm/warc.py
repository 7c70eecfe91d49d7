"""Web archives: writing captures as WARC records, reading them, and putting transactions together.

A capture is written as three records: the response (or a revisit, which has no payload of its
own), the request, and metadata.  The latter two name the first in ``WARC-Concurrent-To``.
Archives are written by Spark's text writer, whose line separator is the end of a record, and
read as whole files that are cut by ``Content-Length``.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from drayage.llm.salted import join_back, salt_mask, salt_of
from drayage.llm.url_filter import likely
from drayage.scratch import stage, staging_scope

SMALLEST_REVISIT = 100  # bytes; smaller payloads are always written in full
CAPTURES_PER_FILE = 5_000
_END = "\r\n\r\n"
_BATCH_BYTES = 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORDS_DDL = (
    "record_id string, type string, target_uri string, date string, concurrent_to array<string>, "
    "refers_to string, payload_digest string, payload_bytes long, payload_intact boolean, "
    "fields array<struct<name: string, value: string>>, payload binary"
)


def _uuid(*parts: Column) -> Column:
    """A record id that follows from the parts; a null differs from every text."""
    texts = [F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts]
    digest = F.sha2(F.concat_ws("\x00", *texts), 256)
    cut = [F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.format_string("<urn:uuid:%s-%s-5%s-8%s-%s>", *cut)


def _record(block: Column, *headers: tuple[str, Column | str]) -> Column:
    """One record as text; headers that are null are left out."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(v) if isinstance(v, str) else v) for name, v in headers]
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws("\r\n", F.lit("WARC/1.1"), *lines, length), F.lit(_END), block)


def write_archives(
    captures: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    compression: str = "gzip",
) -> None:
    """Write one response or revisit, one request and one metadata record for each capture.

    Of captures with equal payloads of at least 100 bytes, those with the smallest key (null keys are
    larger than all others) are responses, and the others revisit the one of them with the smallest
    address.  A null payload is empty.  Rows that agree in key, address and payload are captures of
    their own, with ids of their own.  White space and control characters are taken out of addresses.
    The rows are staged once with a number each until they are written; decisions are made without
    their payloads.
    """
    with staging_scope(captures.sparkSession):
        writer = _records(captures, key, url, payload, date).write.option("maxRecordsPerFile", CAPTURES_PER_FILE)
        writer.text(path, compression=compression, lineSep=_END)


def _records(captures: DataFrame, key: str, url: str, payload: str, date: str) -> DataFrame:
    """The three records of each row as one text; what it reads is staged."""
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    address = F.regexp_replace(F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")), r"[\x00-\x20]", "")
    rows = captures.select(F.col(f"`{key}`").alias("key"), address.alias("url"), body.alias("body")).select(
        "key", "url", "body", F.sha2("body", 256).alias("digest"), F.octet_length("body").alias("n"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = stage(rows, "warc-rows")
    alone = F.lit(None)
    own = _uuid(F.lit("r"), F.col("key"), F.col("url"), F.col("digest"), alone)
    light = rows.select("number", "key", "url", "digest", "n", own.alias("own"), salt_of(F.col("number")).alias("salt"))

    # Of rows that agree in all, the first has the id that revisits name, the others one of their own.
    repeated = light.groupBy("own").agg(
        F.min("number").alias("least"), F.count("*").alias("rows"), salt_mask(F.col("salt")).alias("salts")
    )
    repeated = join_back(light, repeated.where("rows > 1").drop("rows"), "own", "salt", "salts", "inner")
    repeated = repeated.where("number <> least").select("number", F.lit(True).alias("repeated"), F.lit(None).alias("first"))
    name = F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("url"), F.col("own"))
    large = light.where(F.col("n") >= SMALLEST_REVISIT)
    firsts = large.groupBy("digest").agg(F.min(name).alias("first"), salt_mask(F.col("salt")).alias("salts"))
    revisits = join_back(large, firsts, "digest", "salt", "salts").where("NOT key <=> first.key")
    revisits = revisits.select("number", F.lit(None).cast("boolean").alias("repeated"), F.col("first.own").alias("first"))
    marks = repeated.unionByName(revisits).groupBy("number").agg(
        F.max("repeated").alias("repeated"), F.max("first").alias("first")
    )
    marks = stage(marks, "warc-marks")
    # Rows without a mark stay where they are; a Bloom filter tells most of them.
    marked = likely(marks, "number")(F.col("number"))
    plain = rows.where(~marked).withColumns({"repeated": F.lit(None).cast("boolean"), "first": F.lit(None).cast("string")})
    joined = plain.unionByName(rows.where(marked).join(marks, "number", "left"))

    parts = [F.col("key"), F.col("url"), F.col("digest"), F.when(F.col("repeated"), F.col("number"))]
    own = _uuid(F.lit("r"), *parts)
    first, again = F.col("first"), F.col("first").isNotNull()
    target = F.concat(F.lit("urn:capture:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    target = F.when(F.col("url") != "", F.col("url")).otherwise(target)
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("n").cast("string"),
        F.lit(_END),
    )
    capture = _record(
        F.concat(head, F.when(again, F.lit("")).otherwise(F.col("body"))),
        ("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        ("WARC-Record-ID", own),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", F.when(again, F.lit(_PROFILE))),
        ("WARC-Refers-To", F.when(again, first)),
        ("Content-Type", "application/http; msgtype=response"),
    )
    request = _record(
        F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{_END}")),
        ("WARC-Type", "request"),
        ("WARC-Record-ID", _uuid(F.lit("q"), *parts)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Concurrent-To", own),
        ("Content-Type", "application/http; msgtype=request"),
    )
    metadata = _record(
        F.concat_ws("\r\n", F.concat(F.lit("capture: "), F.col("key").cast("string")), F.lit("via: table")),
        ("WARC-Type", "metadata"),
        ("WARC-Record-ID", _uuid(F.lit("m"), *parts)),
        ("WARC-Date", date),
        ("WARC-Target-URI", target),
        ("WARC-Concurrent-To", own),
        ("Content-Type", "application/warc-fields"),
    )
    return joined.select(F.concat_ws(_END, capture, request, metadata).alias("value"))


def _members(data: bytes) -> bytes:
    """The file's bytes, unpacked if it is gzip; archives may be many members in a row."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data))
        data = member.unused_data
    return b"".join(out)


def parse(data: bytes) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    at = 0
    while True:
        while data[at : at + 2] == b"\r\n":
            at += 2
        if at >= len(data):
            return
        end = data.index(_END.encode(), at)
        version, *lines = data[at:end].decode("utf-8", "replace").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers: dict[str, list[str]] = {}
        for line in lines:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        at = end + 4
        length = int(headers["content-length"][0])
        yield headers, data[at : at + length]
        at += length


def _columns(headers: dict[str, list[str]], block: bytes) -> tuple:
    def one(name: str) -> str | None:
        return headers.get(name, [None])[0]

    kind, digest = one("warc-type"), one("warc-payload-digest")
    payload, fields, size, intact = block, {}, len(block), None
    if (one("content-type") or "").startswith("application/http"):
        head, _, payload = block.partition(_END.encode())
        lines = head.decode("utf-8", "replace").split("\r\n")
        fields = {"start": lines[0]} | {n.strip().lower(): v.strip() for n, _, v in (x.partition(":") for x in lines[1:])}
        size = len(payload)
    elif one("content-type") == "application/warc-fields":
        lines = block.decode("utf-8", "replace").split("\r\n")
        fields = {n.strip(): v.strip() for n, _, v in (x.partition(":") for x in lines if x)}
    if kind == "revisit":
        # What the record stands for, not what it holds.
        size = int(fields.get("content-length", 0))
    elif kind in ("response", "resource"):
        found = hashlib.sha256(payload).hexdigest()
        intact = digest is None or digest == f"sha256:{found}"
        digest = f"sha256:{found}"
    return (
        one("warc-record-id"), kind, one("warc-target-uri"), one("warc-date"), headers.get("warc-concurrent-to", []),
        one("warc-refers-to"), digest, size, intact, list(fields.items()), payload,
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, packed by gzip or plain.

    Columns: ``record_id, type, target_uri, date, concurrent_to, refers_to, payload_digest,
    payload_bytes, payload_intact, fields, payload``.  Of a response, bytes and digest are
    those of the payload read, and ``payload_intact`` tells whether the digest is the one
    written; a revisit has both of the payload it stands for.
    """
    schema = to_arrow_schema(StructType.fromDDL(_RECORDS_DDL))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for headers, block in parse(_members(content.as_py())):
                    rows.append(_columns(headers, block))
                    size += len(block)
                    if size >= _BATCH_BYTES:
                        yield _batch(rows, schema)
                        rows, size = [], 0
                yield _batch(rows, schema)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _RECORDS_DDL)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def transactions(records: DataFrame) -> DataFrame:
    """One row for each capture: ``record_id``, and the records of its transaction nested.

    ``capture`` is the response or revisit; ``requests`` and ``metadata`` are the records that
    name it in ``WARC-Concurrent-To``, or that name one of its requests there, by record id.
    Records with the same id are one.  Requests and metadata of no capture are left out, and a
    capture without them has empty lists.
    """
    held = records.columns
    records = records.dropDuplicates(["record_id"])
    captures = records.where("type IN ('response', 'revisit')")
    captures = captures.select("record_id", F.struct(*held).alias("capture"))
    light = F.struct(*[c for c in held if c != "payload"])
    others = records.where("type IN ('request', 'metadata')").select(
        "type", F.col("record_id").alias("own"), F.explode("concurrent_to").alias("to"), light.alias("other")
    )
    requests = others.where("type = 'request'")
    # Metadata may belong to the request instead.
    indirect = others.where("type = 'metadata'").join(
        requests.select(F.col("own").alias("to"), F.col("to").alias("over")), "to", "left"
    )
    metadata = indirect.select("own", F.coalesce("over", "to").alias("to"), "other")

    def nested(side: DataFrame, name: str) -> DataFrame:
        gathered = F.transform(F.sort_array(F.collect_list(F.struct("own", "other"))), lambda x: x["other"])
        return side.groupBy(F.col("to").alias("record_id")).agg(gathered.alias(name))

    joined = captures.join(nested(requests, "requests"), "record_id", "left")
    joined = joined.join(nested(metadata, "metadata"), "record_id", "left")
    return joined.select(
        "record_id",
        "capture",
        *[F.coalesce(c, F.array().cast(joined.schema[c].dataType)).alias(c) for c in ("requests", "metadata")],
    )


def with_referred(found: DataFrame, record_id: str, refers_to: str, value: str, name: str) -> DataFrame:
    """``found`` with ``name``: the ``value`` of the capture that a revisit refers to, else null.

    A capture may be what a third of all rows refer to; they are spread by salt.
    """
    rows = found.withColumn("_salt", F.when(F.col(refers_to).isNotNull(), salt_of(F.col(record_id))))
    wanted = rows.where(F.col(refers_to).isNotNull()).groupBy(refers_to).agg(salt_mask(F.col("_salt")).alias("_salts"))
    values = found.select(F.col(record_id).alias(refers_to), F.col(value).alias(name))
    return join_back(rows, wanted.join(values, refers_to), refers_to, "_salt", "_salts").drop("_salt")
