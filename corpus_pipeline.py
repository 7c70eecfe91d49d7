"""From raw documents to tokens: language, exact and near copies, benchmark leaks, encoding.

Each stage takes what the one before it kept, as a Parquet table, and its decision takes effect.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.llm.bpe import encode
from drayage.llm.decontaminate import drop_contaminated
from drayage.llm.exact_dedup import keep_one, unused_name
from drayage.llm.language import UNKNOWN, fit, predict
from drayage.llm.simhash import keep_one_of_each
from drayage.scratch import stage

SURE = 0.5  # the least score of the predicted language
SHINGLE, SIMILARITY = 5, 0.8  # near copies share four fifths of their five-word shingles
TOKENIZER = "word_bpe_49k.json"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is told with a score of at least ``SURE``; text without letters goes."""
    column = unused_name(docs, "_language")
    found = predict(docs, fit(docs), column=column)
    sure = (F.col(column)["lang"] != UNKNOWN) & (F.col(column)["score"] >= SURE)
    return found.where(sure).drop(column)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text, that with the largest id."""
    return keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that with the smallest id."""
    return keep_one_of_each(docs, shingle=SHINGLE, similarity=SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no ten consecutive words of a benchmark text."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with ``ids`` and ``n_tokens``; columns of these names are replaced."""
    encoded = encode(docs, public_tokenizers.path(TOKENIZER))
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("tokens", tokens),
]

ORACLE_SQL = None  # language, near copies and tokens are beyond SQL; the tests compare with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
