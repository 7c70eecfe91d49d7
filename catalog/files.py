"""Files written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.base import query, table
from drayage import registry
from drayage.scratch import new_path
from drayage.sinks import files as sinks
from drayage.sinks.versions import VersionConflict, append_version, read_version
from drayage.sources import files as sources


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM lineitem""")
def arrow_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "arrow")
    registry.write(table(spark, sf_dir, "lineitem"), "arrow", path=path, mode="overwrite")
    return registry.read(spark, "arrow", path=path)


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n_lines FROM lineitem WHERE l_linenumber >= 3 GROUP BY ALL""")
def arrow_group_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = arrow_scan(spark, sf_dir)
    return (
        lines.where(F.col("l_linenumber") >= 3)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("n_lines"))
    )


@query("""
SELECT CAST(s_suppkey AS DOUBLE) AS number, s_name AS label, s_acctbal AS balance FROM supplier""")
def sheet_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sheet")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    supplier.write.option("header", True).csv(path)
    return sources.read_sheet(spark, path, "number double, label string, balance double")


# A file whose cells hold line breaks is read by one task, so files must not grow with the table.
CSV_RECORDS = 2000
MESSY = {"escape": '"', "quoteAll": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
MESSY_SQL = """
SELECT CAST(doc_id AS {kind}) AS "{key}", text || ', "" "q" \\' AS "a ""b"",
c\\", '\\' AS slash FROM documents"""


def messy_texts(spark: SparkSession, sf_dir: str, key: str, path: str, sep: str = ",") -> None:
    """Documents as CSV: quotes, backslashes, separators and line breaks in cells and header."""
    note = F.concat("text", F.lit(', "" "q" \\')).alias('a "b",\nc\\')
    messy = table(spark, sf_dir, "documents").select(F.col("doc_id").alias(key), note, F.lit("\\").alias("slash"))
    messy.write.options(header=True, sep=sep, maxRecordsPerFile=CSV_RECORDS, **MESSY).csv(path)


@query(MESSY_SQL.format(kind="VARCHAR", key="doc_id"))
def sheet_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sheet")
    messy_texts(spark, sf_dir, "doc_id", path)
    return sources.read_sheet(spark, path)


@query(MESSY_SQL.format(kind="INTEGER", key="number"))
def dataset_messy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    messy_texts(spark, sf_dir, "number", path, ";")
    return sources.read_dataset_csv(spark, path, {"sep": "';'"})


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS "Unnamed: 2" FROM supplier""")
def sheet_header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "sheet")
    supplier = table(spark, sf_dir, "supplier")
    # The last column has a blank name.
    blank = supplier.select("s_suppkey", "s_name", F.col("s_nationkey").alias(" "))
    blank.write.option("header", True).csv(path)
    return sources.read_sheet(spark, path)


def dataset_folder(spark: SparkSession, sf_dir: str) -> str:
    """Documents as a dataset with two splits."""
    path = new_path(spark, "dataset")
    documents = table(spark, sf_dir, "documents")
    english = F.col("lang") == "en"
    documents.where(english).write.parquet(f"{path}/data/train-0")
    documents.where(~english).write.parquet(f"{path}/data/test-0")
    return path


@query("""
SELECT CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS split, CAST(doc_id AS INTEGER) AS doc_id, lang,
       CAST(NULL AS VARCHAR) AS absent, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents""")
def hub_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dataset_folder(spark, sf_dir)
    schema = "doc_id int, lang string, absent string, n_chars string"
    train = sources.read_split(spark, path, schema=schema).withColumn("split", F.lit("train"))
    test = sources.read_split(spark, path, "test", schema).withColumn("split", F.lit("test"))
    return train.unionByName(test).select("split", "doc_id", "lang", "absent", "n_chars")


@query("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""")
def hub_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = dataset_folder(spark, sf_dir)
    return sources.read_split(spark, path, "train").unionByName(sources.read_split(spark, path, "test"))


@query("""
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part""")
def dataset_csv_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    table(spark, sf_dir, "part").write.option("header", True).option("sep", ";").csv(path)
    return sources.read_dataset_csv(spark, path, {"sep": "';'"})


@query("""
SELECT rtrim(unnest(string_split(text, chr(10))), chr(13)) AS value FROM documents""")
def text_lines_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "lines")
    documents = table(spark, sf_dir, "documents")
    dos = F.when(F.col("lang") == "de", F.replace("text", F.lit("\n"), F.lit("\r\n"))).otherwise(F.col("text"))
    sinks.write_lines(documents.select(dos.alias("value"), "lang", "source"), path, by=("lang", "source"))
    return sources.read_lines(spark, path, recursive=True)


@query("""
SELECT unnest(string_split(text, chr(10))) AS value FROM documents""")
def text_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "lines")
    documents = table(spark, sf_dir, "documents")
    sinks.write_lines(documents.select("lang"), path, "append")
    sinks.write_lines(documents.select("text", "lang"), path, "overwrite")
    return sources.read_lines(spark, path)


@query("""
SELECT o_orderkey, o_orderpriority || chr(10) || '"' AS note,
       CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice
FROM orders""")
def json_array_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "arrays")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat("o_orderpriority", F.lit('\n"')).alias("note"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("o_totalprice"),
    )
    sinks.write_json_arrays(orders, path, "overwrite", rows_per_file=10_000)
    return spark.read.schema(orders.schema).json(path, multiLine=True)


@query("""
SELECT count(*) AS total_count, count(*) AS stored_count, max(event_id) AS last_id,
       count(*) FILTER (event_type = 'click') AS clicks
FROM events""")
def jsonl_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "jsonl")
    events = table(spark, sf_dir, "events")
    totals = sinks.write_json_lines(events, path, "overwrite")
    stored = spark.read.schema("event_id long, event_type string").json(path)
    return stored.agg(
        F.lit(totals["total_count"]).cast("long").alias("total_count"),
        F.count("*").alias("stored_count"),
        F.max("event_id").alias("last_id"),
        F.count_if(F.col("event_type") == "click").alias("clicks"),
    )


@query("""
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dimensions, CAST(embedding[1] AS DOUBLE) AS first_element
FROM embeddings""")
def vector_append_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "vectors")
    vectors = table(spark, sf_dir, "embeddings")
    first = append_version(vectors.where("label < 5"), path, based_on=None)
    append_version(vectors.where("label >= 5"), path, based_on=first)
    try:
        append_version(vectors, path, based_on=first)
    except VersionConflict:
        pass  # an append based on an outdated version leaves the dataset as it was
    else:
        raise AssertionError("a stale append was published")
    return read_version(spark, path).select(
        "vec_id",
        "label",
        F.size("embedding").alias("dimensions"),
        F.element_at("embedding", 1).cast("double").alias("first_element"),
    )


@query("""
SELECT 'src/' || doc_id AS path, n_chars AS length FROM documents WHERE lang <> 'en'""")
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    listing = documents.select(F.concat(F.lit("src/"), "doc_id").alias("path"), F.col("n_chars").alias("length"), "lang")
    return sources.new_files(listing.drop("lang"), listing.where("lang = 'en'"))
