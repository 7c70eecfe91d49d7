"""The text operators over whole tables, with SQL twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.llm.bpe import with_token_counts
from drayage.llm.context_tree import score_texts
from drayage.llm.decontaminate import build_index, find_phrases
from drayage.llm.exact_dedup import duplicate_groups
from drayage.llm.language import fit, predict
from drayage.llm.pii import KINDS, find_identifiers
from drayage.llm.ranked_search import build_index as build_ranked_index
from drayage.llm.ranked_search import search
from drayage.llm.secrets import find_secrets
from drayage.llm.shards import assign_shards
from drayage.llm.simhash import near_duplicate_groups
from drayage.llm.url_filter import judge_urls
from drayage.llm.vector_codes import compress
from drayage.llm.warc import read_archives, transactions, with_referred, write_archives
from drayage.scratch import new_path, stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with the SQL that must give the same rows."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Words, then every run of as many words as some item's phrases have, as text.
_PHRASES_SQL = r"""
    WITH word AS (
        SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
        UNION ALL
        SELECT 'i', item_id, row_number() OVER (), regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{80}-\x{10FFFF}]+') FROM benchmark),
    phrase AS (
        SELECT DISTINCT id, size, array_to_string(w[pos : pos + size - 1], ' ') AS p FROM (
            SELECT id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS pos
            FROM word WHERE kind = 'i' AND len(w) > 0)),
    run AS (
        SELECT r, pos, size, array_to_string(w[pos : pos + size - 1], ' ') AS p FROM (
            SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS pos
            FROM word, (SELECT DISTINCT size FROM phrase) WHERE kind = 'd' AND len(w) >= size)),
    hit AS (SELECT r, id AS item, pos, run.size FROM run JOIN phrase USING (size, p)),
    items AS (SELECT r, count(DISTINCT item) AS n_items,
                     string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS list FROM hit GROUP BY r),
    words AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (
        SELECT r, unnest(range(pos, pos + size)) AS pos FROM hit) GROUP BY r)
    SELECT word.id AS doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(list, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM word LEFT JOIN items USING (r) LEFT JOIN words USING (r) WHERE kind = 'd'
"""


@query(_PHRASES_SQL)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark texts in the documents, by phrases of ten words."""
    index = build_index(table(spark, sf_dir, "documents"))
    found = find_phrases(index, table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        F.col("key").alias("doc_id"),
        F.col("n_words").cast("long").alias("n_words"),
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


@query()
def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lengths of all documents, learned from four fifths of them."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5))
    return score_texts(table(spark, sf_dir, "documents"), fold != 1).select(
        F.col("key").alias("doc_id"),
        (~F.col("trained")).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        "bits_per_byte",
    )


@query("""
    SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest,
           CASE WHEN strlen(h) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN strlen(h) >= 100 AND page_id <> first THEN first END AS refers_to
    FROM (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
          FROM pages)
""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives, read back and put together by transaction."""
    path = new_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    # The digests come from the payloads read; the payloads themselves are not needed any more.
    found = transactions(stage(read_archives(spark, path).drop("payload"), "warc-records"))
    fields = F.get(F.col("metadata"), F.lit(0))["fields"]
    page = F.get(F.filter(fields, lambda f: f["name"] == "capture"), F.lit(0))["value"]
    pages = found.select(
        "record_id",
        F.col("capture.type").alias("record_type"),
        F.col("capture.refers_to").alias("target"),
        F.col("capture.payload_bytes").alias("payload_bytes"),
        F.substring_index("capture.payload_digest", ":", -1).alias("payload_digest"),
        page.cast("long").alias("page_id"),
    )
    return with_referred(pages, "record_id", "target", "page_id", "refers_to").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate of every document, with the forest's score."""
    return find_secrets(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


@query()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of three-word shingles, linked at two differing bits."""
    groups = near_duplicate_groups(table(spark, sf_dir, "documents"), shingle=3, radius=2, blocks=4)
    return groups.select(
        F.col("key").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one of its group that stays."""
    return duplicate_groups(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        "group_size",
        F.expr("key <=> keep").alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


@query()
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers in the documents, plain and disguised, without the doubtful ones."""
    found = find_identifiers(table(spark, sf_dir, "documents"))
    found = found.withColumn("spans", F.filter("spans", lambda s: s["sure"]))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        F.col("key").alias("doc_id"),
        *[F.size(F.filter("spans", _of_kind(k))).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


@query()
def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, and the text they decode to."""
    path = public_tokenizers.path("word_bpe_49k.json")
    texts = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return with_token_counts(texts, path).select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes, equal texts together."""
    found = assign_shards(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned from two thirds of them."""
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(3))
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(fold != 1))
    return predict(docs, model, columns=["doc_id"]).select(
        "doc_id",
        (fold == 1).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def _codebook_sql(rounds: int) -> str:
    """Plain k-means, a few tables for each round."""
    steps = [
        """kept AS (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings WHERE embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        """number AS MATERIALIZED (SELECT r, pos * 8 // size AS part, pos % (size // 8) AS place, x FROM (
            SELECT r, len(embedding) AS size, unnest(range(len(embedding))) AS pos,
                   unnest(list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT)) AS x FROM kept))""",
        """first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 16)""",
        """book0 AS MATERIALIZED (SELECT part, entry, place, x FROM number JOIN first USING (r))""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""near{n} AS MATERIALIZED (
            SELECT r, part, min((d, entry)) AS best FROM (
                SELECT r, part, entry, sum((number.x - book{n}.x) ** 2)::BIGINT AS d
                FROM number JOIN book{n} USING (part, place) GROUP BY ALL) GROUP BY ALL)""")
        steps.append(f"""book{n + 1} AS MATERIALIZED (
            SELECT part, entry, place, coalesce(floor_x, x) AS x FROM book{n} LEFT JOIN (
                SELECT part, best[2] AS entry, place,
                       ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS floor_x
                FROM number JOIN near{n} USING (r, part) GROUP BY ALL) USING (part, entry, place))""")
    return f"""WITH {", ".join(steps[:-1])},
        book AS (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) AS digest FROM book{rounds}),
        code AS (SELECT r, string_agg(printf('%02x', best[2]::INT), '' ORDER BY part) AS code,
                        sum(best[1])::BIGINT AS error FROM near{rounds} GROUP BY r)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT digest FROM book) AS codebooks_sha256
        FROM kept JOIN code USING (r)"""


@query(_codebook_sql(6))
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors as eight entries of sixteen, after six rounds."""
    return compress(table(spark, sf_dir, "embeddings")).select(
        F.col("key").alias("vec_id"),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.col("codebooks").alias("codebooks_sha256"),
    )


RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(f"""
    WITH part AS (
        SELECT row_number() OVER () AS r, page_id,
               translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    rule(of, start, verdict) AS (VALUES {", ".join(map(str, RULES))}),
    fit AS (SELECT r, arg_max(of || start, len(of || start)) AS rule, arg_max(verdict, len(of || start)) AS verdict
            FROM part JOIN rule ON (host = of OR suffix(host, '.' || of)) AND starts_with(path, start) GROUP BY r),
    listed AS (SELECT host FROM part JOIN fit USING (r) GROUP BY host
               HAVING count(*) FILTER (verdict = 'block') > count(*) FILTER (verdict = 'allow'))
    SELECT page_id, host, path, rule,
           coalesce(verdict, CASE WHEN host IN (FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
    FROM part LEFT JOIN fit USING (r)
""")
def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All urls by rules, and by hosts whose urls the rules mostly block."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select(F.col("key").alias("page_id"), "host", "path", "rule", "verdict")


@query(r"""
    WITH word AS (
        SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS r, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t FROM documents
        UNION ALL
        SELECT 'i', item_id, row_number() OVER (), unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{80}-\x{10FFFF}]+')) FROM benchmark),
    held AS (SELECT kind, r, any_value(id) AS id, t, count(*) AS tf FROM word GROUP BY kind, r, t),
    doc AS (SELECT r, any_value(id) AS doc_id, sum(tf)::BIGINT AS n FROM held WHERE kind = 'd' GROUP BY r),
    total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM doc),
    weight AS (SELECT t, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
               FROM held, total WHERE kind = 'd' GROUP BY t, n_docs),
    scored AS (SELECT item.r AS item, any_value(item.id) AS item_id, d.r, any_value(d.id) AS doc_id, sum(item.tf * w * (
                   (1000000000 * d.tf) // (1000 * d.tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::BIGINT AS score
               FROM held AS item JOIN held AS d USING (t) JOIN weight USING (t) JOIN doc ON doc.r = d.r, total
               WHERE item.kind = 'i' AND d.kind = 'd' GROUP BY item.r, d.r)
    SELECT item_id, (row_number() OVER best)::INT AS rank, doc_id, score FROM scored WHERE score > 0
    WINDOW best AS (PARTITION BY item ORDER BY score DESC, doc_id) QUALIFY rank <= 20
""")
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty best documents for every benchmark item."""
    index, totals = build_ranked_index(table(spark, sf_dir, "documents"))
    return search(index, totals, table(spark, sf_dir, "benchmark")).select(
        F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score"
    )
