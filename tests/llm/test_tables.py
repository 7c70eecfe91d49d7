"""Archives, secrets, shards and the pipeline."""

import random
import re

import pytest
import xxhash  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from drayage.llm import queries, secrets, shards, warc
from drayage.scratch import new_path

SF_DIR = "/root/testdata/sf0.001"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


LONG = "<p>Ünïcode</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 5


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archives_come_back_as_transactions(spark, compression):
    rows = [(1, "http://a/ b\n", LONG), (5, None, LONG), (2, "http://c/", None), (3, "http://d/", "short"),
            (4, "http://e/", "short"), (None, "http://f/", LONG), (7, "http://g/", "x" * 1_000_000), (8, "u", "")]
    path = new_path(spark, "warc-test")
    warc.write_archives(pages(spark, rows), path, compression=compression)
    records = warc.read_archives(spark, path)
    assert records.count() == 3 * len(rows) and records.where("NOT payload_intact").count() == 0
    found = {}
    for r in warc.transactions(records).collect():
        assert len(r.requests) == len(r.metadata) == 1
        fields = {f.name: f.value for f in r.metadata[0].fields}
        found[int(fields["capture"]) if "capture" in fields else None] = r
    assert found[1].capture.type == "response" and bytes(found[1].capture.payload).decode() == LONG
    assert {found[k].capture.type for k in (5, None)} == {"revisit"}
    assert found[5].capture.refers_to == found[1].record_id and found[5].capture.payload_bytes == len(LONG.encode())
    assert found[5].capture.payload_digest == found[1].capture.payload_digest
    assert all(found[k].capture.type == "response" for k in (2, 3, 4, 7, 8))


def test_repeated_rows_are_captures_of_their_own(spark):
    rows = [(3, "http://b/", LONG), (3, "http://b/", LONG), (3, "http://a/", LONG), (4, "http://b/", LONG), (4, "http://b/", LONG),
            (5, "u", "s"), (5, "u", "s"), (None, None, None), (None, None, None), (None, None, LONG)]
    frame = pages(spark, rows * 3).withColumns({"number": F.lit(1), "own": F.lit("x"), "KEY": F.lit(2)})
    path = new_path(spark, "warc-repeated")
    warc.write_archives(frame, path)
    found = warc.transactions(warc.read_archives(spark, path)).collect()
    assert len(found) == 3 * len(rows) and all(len(r.requests) == len(r.metadata) == 1 for r in found)
    assert len({r.metadata[0].record_id for r in found}) == len(found)
    got = sorted((str({f.name: f.value for f in r.metadata[0].fields}.get("capture")), r.capture.type) for r in found)
    kinds = {3: "response", 4: "revisit", 5: "response"}
    large = [(str(k), "revisit" if k is None and h else kinds.get(k, "response")) for k, _, h in rows * 3]
    assert got == sorted(large)
    first = {r.capture.refers_to for r in found if r.capture.type == "revisit"}
    targets = [r for r in found if r.record_id in first]
    assert len(first) == len(targets) == 1 and targets[0].capture.target_uri == "http://a/"


def test_metadata_of_a_request_joins_its_capture(spark):
    schema = "record_id string, type string, concurrent_to array<string>, payload binary"
    rows = [("c", "response", [], b"x"), ("q", "request", ["c"], b""), ("m", "metadata", ["q"], b""),
            ("m", "metadata", ["q"], b""), ("lost", "metadata", ["z"], b""), ("d", "revisit", None, b"")]
    got = {r.record_id: r for r in warc.transactions(spark.createDataFrame(rows, schema)).collect()}
    assert [m.record_id for m in got["c"].metadata] == ["m"] and got["d"].requests == []


def test_empty_archives(spark):
    path = new_path(spark, "warc-empty")
    warc.write_archives(pages(spark, []), path)
    assert warc.transactions(warc.read_archives(spark, path)).count() == 0


def test_candidates_and_forest(spark):
    rng = random.Random(0)
    rows = []
    for i in range(300):
        value = "".join(rng.choices("0123456789abcdef", k=40))
        number = "".join(rng.choices("0123456789", k=16))
        rows.append((i, f'some words token = "{value}" then {number} and /static/page-{number}.html', "src"))
    rows += [(None, None, None), (400, "", "s"), (401, "a" * 200_000 + "1", "s")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = secrets.find_secrets(frame.withColumn("label", F.lit(1))).collect()
    pattern = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+"
    want = sorted((k, n, c) for k, t, _ in rows if t for n, c in enumerate(re.findall(pattern, t)))
    assert sorted((r.key, r.nth, r.candidate) for r in got) == want
    assert all(r.is_secret == (r.nth == 0) for r in got if r.key < 300)
    assert secrets.find_secrets(frame.limit(0)).count() == 0


def test_secrets_of_all_forms_are_candidates_of_their_own(spark):
    value = "sk_live_51HabcQ9xZ"
    texts = [f"API_KEY={value}", f"https://a.b/c?access_token={value}&x=1", f'"aws_secret_access_key_1": "{value}"',
             'password = "hunterx"', "api_key: abcdefghijklmnopqrst", "nothing is here of that kind 1234567890123456"]
    frame = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "key long, text string, source string")
    found = secrets.candidates(frame, "key")
    featured = secrets.with_features(found, secrets.common_words(frame))
    got = {(r.key, r.candidate): r.assigned for r in featured.collect()}
    wanted = [(0, value), (1, value), (2, value), (3, "hunterx"), (4, "abcdefghijklmnopqrst")]
    assert [got.get(w) for w in wanted] == [1.0] * 5
    labels = {(r.key, r.candidate): r.label for r in secrets.labelled(featured).collect()}
    assert [labels.get(w) for w in wanted] == [1.0, 1.0, 1.0, None, None] and (2, "aws_secret_access_key_1") not in labels
    text = {r.key: r for r in found.where(F.col("candidate") == value).collect()}
    assert all(texts[k].endswith((r.before + value + r.after)[-40:]) for k, r in text.items())


def test_copies_do_not_crowd_out_other_findings(spark, monkeypatch):
    rows = [(float(label), float(i)) for label in (0, 1) for i in range(40) for _ in range(50)]
    frame = spark.createDataFrame(rows, "label double, length double")
    frame = frame.withColumns({f: F.lit(0.0) for f in secrets.FEATURES[1:]})
    staged = {}

    def kept(rows, name):
        staged[name] = rows.cache()
        return staged[name]

    monkeypatch.setattr(secrets, "stage", kept)
    assert secrets.fit(frame, most=30, trees=2)
    sample = staged["labelled-findings"]
    assert sample.select("label", "length").distinct().count() == sample.count() == 60
    assert sample.agg(F.sum("_weight")).first()[0] == 60 * 50


def test_forest_plan_has_no_python(spark):
    plan = queries.QUERIES["op4_secrets"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_differencing_is_tight_and_complete():
    rng = random.Random(1)
    sizes = [rng.randint(1, 1000) for _ in range(2000)]
    place = shards.difference(sizes, 7)
    sums = [sum(s for s, p in zip(sizes, place) if p == k) for k in range(7)]
    assert len(place) == 2000 and max(sums) - min(sums) <= 5
    assert shards.difference([], 3) == [] and sorted(shards.difference([5, 5, 5], 3)) == [0, 1, 2]
    assert shards.difference([8, 7, 6, 5, 4], 2).count(0) in (2, 3)


def test_shards_hold_groups_together_and_number_rows(spark):
    rng = random.Random(2)
    rows = [(i, "hot") for i in range(500)] + [(i, "é" * rng.randint(0, 300)) for i in range(500, 1500)]
    rows += [(None, None), (3, "hot"), (7, "x" * 50_000)]
    got = shards.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), 5).toPandas()
    assert len(got) == len(rows) and (got.groupby("group").shard.nunique() == 1).all()
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in got.groupby("shard"))
    sums = got.groupby("shard")["size"].sum()
    others = sums[sums.index != got["shard"][got["size"].idxmax()]]
    assert others.max() - others.min() <= 0.02 * sums.mean() + 700
    assert shards.assign_shards(spark.createDataFrame([], "doc_id long, text string")).count() == 0


ROWS = [(1, "the and of that is with", "en", "s", 1), (2, "the and of that is with", "en", "s", 1), (3, None, "en", None, None),
        (4, "123 456", None, "s", 1), (5, "", "de", "s", 1), (None, "der und die das ist", "de", "s", 1)]


def test_stages_take_odd_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for rows in (ROWS, []):
        frame = spark.createDataFrame(rows, schema).withColumn("key", F.lit("clash"))
        for name, step in corpus_pipeline.STAGES:
            after = step(spark, frame, SF_DIR)
            assert after.columns[: len(frame.columns)] == frame.columns, name
            assert after.count() <= len(rows)


def test_pipeline_matches_its_decisions(spark):
    """Copies and leaks go, everything else with a language stays and is encoded."""
    kept = corpus_pipeline.run(spark, SF_DIR).toPandas()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()
    leaks = queries.QUERIES["op1_decontaminate"](spark, SF_DIR).where("contaminated").toPandas()
    assert kept.text.is_unique and not set(kept.doc_id) & set(leaks.doc_id)
    newest = docs.groupby("text").doc_id.max()
    assert set(kept.doc_id) <= set(newest)
    gone = set(newest) - set(leaks.doc_id) - set(kept.doc_id)
    prints = queries.near_duplicate_groups(spark.createDataFrame(docs[docs.doc_id.isin(newest)])).toPandas()
    assert gone <= set(prints.key[prints.key != prints.component]) | {
        i for i, t in zip(docs.doc_id, docs.text) if not re.search(r"[^\W\d_]", t)
    }
    assert (kept.n_tokens == kept.ids.map(len)).all()
