"""Scalar functions, through Spark."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.functions import convert, nested, sheets


def values(spark, rows, ddl, col):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(col.alias("v")).collect()]


def test_is_json(spark):
    texts = {
        '{"a": 1}': True, "[1, 2]": True, "1": True, '"x"': True, "null": True, " {} ": True,
        "{bad-json}": False, '{"a": 1}]': False, '{"a": 1}}': False, "1, 2": False, '1, "v": 2': False,
        "1] , [2": False, "": False, "  ": False, '{"a": 1': False, '{"a": }': False, None: False,
    }
    found = values(spark, [(t,) for t in texts], "t string", nested.is_json(F.col("t")))
    assert found == list(texts.values())


def test_json_text_names_the_field(spark):
    rows = spark.createDataFrame([("{bad-json}",)], "vector string")
    with pytest.raises(PySparkException, match="vector"):
        rows.select(nested.json_text(rows, "vector")).collect()
    natives = spark.createDataFrame([([1.0, 2.0], {"a": "b"})], "v array<double>, m map<string,string>")
    row = natives.select(nested.json_text(natives, "v"), nested.json_text(natives, "m")).first()
    assert tuple(row) == ("[1.0,2.0]", '{"a":"b"}')


def test_json_parts(spark):
    rows = [("a{b}", 1), (None, None), ('q"\n', 2)]
    part = nested.members(F.col("s").alias("x"), F.col("n"))
    assert values(spark, rows, "s string, n int", part) == ['"x":"a{b}","n":1', None, '"x":"q\\"\\n","n":2']
    whole = nested.json_object(part, nested.member("raw", F.lit("[1]")))
    assert values(spark, rows, "s string, n int", whole)[1] == '{"raw":[1]}'
    assert values(spark, rows, "s string, n int", nested.json_object_or_null(part))[1] is None
    assert values(spark, rows, "s string, n int", nested.scalar_json(F.col("s"))) == ['"a{b}"', None, '"q\\"\\n"']
    assert values(spark, rows, "s string, n int", nested.scalar_json(F.col("n"))) == ["1", None, "2"]


def test_flatten(spark):
    df = spark.sql("select 1 id, named_struct('street', 's', 'geo', named_struct('lat', '1')) address")
    assert nested.flatten_struct(df).columns == ["id", "address_street", "address_geo_lat"]


def test_safe_numbers(spark):
    rows = [("1.5",), ("",), ("n/a",), (None,), (" 2 ",)]
    assert values(spark, rows, "x string", convert.safe_double(F.col("x"))) == [1.5, None, None, None, 2.0]
    assert values(spark, rows, "x string", convert.safe_double(F.col("x"), 0.0)) == [1.5, 0.0, 0.0, 0.0, 2.0]
    assert values(spark, rows, "x string", convert.safe_int(F.col("x"))) == [1, None, None, None, 2]


def test_hashing(spark):
    digest = hashlib.sha256(b"test@example.com").hexdigest()
    rows = [(" Test@Example.com\n",), (digest,), (digest.upper(),), (None,)]
    assert values(spark, rows, "e string", convert.hashed_email(F.col("e"))) == [digest, digest, digest, None]
    phones = [("+1 ",), (digest + "\n",), ("ü",)]
    expected = [hashlib.sha256(b"+1").hexdigest(), digest, hashlib.sha256("ü".encode()).hexdigest()]
    assert values(spark, phones, "p string", convert.hashed_phone(F.col("p"))) == expected


def test_line_ends(spark):
    rows = [("a\r\n",), ("b\r\r\n\n",), ("c\rd",), ("",)]
    assert values(spark, rows, "s string", convert.strip_line_end(F.col("s"))) == ["a", "b", "c\rd", ""]


def test_event_epoch(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:01.9' t, timestamp_ntz'2024-01-01 00:00:01' n, 7L l, '8' s, 'x' b")
    found = df.select([convert.event_epoch(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields]).first()
    assert tuple(found) == (1704067201, 1704067201, 7, 8, None)
    now = spark.sql("select cast(null as long) x").select(convert.event_epoch(F.col("x"), T.LongType())).first()[0]
    assert now > 1_700_000_000


def test_iso_text(spark):
    df = spark.sql("select date'2024-02-03' d, timestamp_ntz'2024-02-03 04:05:06' t, timestamp_ntz'2024-02-03 04:05:06.5' u")
    found = df.select([convert.iso_text(F.col(f.name), f.dataType) for f in df.schema.fields]).first()
    assert tuple(found) == ("2024-02-03", "2024-02-03T04:05:06", "2024-02-03T04:05:06.500000")


def test_sheet_urls(spark):
    rows = [
        ("https://docs.google.com/spreadsheets/d/abc/edit?gid=7#gid=7",),
        ("https://docs.google.com/spreadsheets/d/abc",),
        ("https://example.com/spreadsheets/d/abc",),
        ("no url at all",),
    ]
    url = F.col("u")
    assert values(spark, rows, "u string", sheets.is_sheet_url(url)) == [True, True, False, False]
    assert values(spark, rows, "u string", sheets.spreadsheet_id(url)) == ["abc", "abc", None, None]
    assert values(spark, rows, "u string", sheets.worksheet_id(url)) == ["7", None, None, None]
    export = sheets.csv_export_url(F.lit("abc"), F.lit("7"), F.lit("select * limit 1"))
    assert values(spark, rows[:1], "u string", export) == [
        "https://docs.google.com/spreadsheets/d/abc/gviz/tq?tqx=out%3Acsv&gid=7&tq=select+*+limit+1"
    ]
    whole = sheets.csv_export_url(F.lit("abc"), F.lit(None).cast("string"), F.lit(None).cast("string"))
    assert values(spark, rows[:1], "u string", whole) == [
        "https://docs.google.com/spreadsheets/d/abc/gviz/tq?tqx=out%3Acsv"
    ]


def test_header_names():
    assert sheets.header_names('"",1,""') == ["Unnamed: 0", "1", "Unnamed: 2"]
    assert sheets.header_names("a,a,a") == ["a", "a.1", "a.2"]
    assert sheets.header_names('"x, y",z') == ["x, y", "z"]
