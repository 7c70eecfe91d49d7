"""Ranked search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from drayage.llm import ranked_search as ranked

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k):
    """(item, rank, key, score) by scoring every document for every item."""
    held = [(key, Counter(words(text))) for key, text in docs if words(text)]
    total = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    rows = []
    for item, text in items:
        scored = []
        for key, count in held:
            m = 75 + 25 * sum(count.values()) * len(held) // total
            score = sum(
                math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * count[t] // (1000 * count[t] + 12 * m))
                for t in words(text)
                if t in count
            )
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        rows += [(item, n + 1, key, -s) for n, (s, _, _, key) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return rows


def corpus(rng, n):
    names = [f"w{i}" for i in range(120)]
    odds = [1 / (i + 1) for i in range(120)]
    return [(i, " ".join(rng.choices(names, odds, k=rng.randint(0, 60)))) for i in range(n)], names, odds


def index_row(docs, totals):
    part = pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.string())], ["key", "text"]
    )
    row = ranked._lists_of(part).to_pylist()[0]
    names = [c.split()[0] for c in ranked._PAIRS.split(", ")]
    return row | dict(zip(names, ranked._pairs_of(row, totals)))


@pytest.mark.parametrize("seed", range(4))
def test_slices_are_searched_exactly_and_bounds_hold(seed):
    rng = random.Random(seed)
    docs, names, odds = corpus(rng, 400)
    rng.shuffle(docs)
    held = [words(t) for _, t in docs if words(t)]
    totals = ranked.Totals(len(held), sum(map(len, held)))
    items = [(i, " ".join(rng.choices(names, odds, k=rng.randint(1, 12)))) for i in range(30)]
    block = ranked.block_of([t for _, t in items])
    terms = block.terms.to_pylist()
    weights = [ranked.weight(totals.documents, sum(t.decode() in set(h) for h in held)) for t in terms]
    queries = [{t: n * weights[t] for t, n in q.items()} for q in block.items]
    parts = [ranked.Slice(index_row(docs[i : i + 90], totals), block.terms, totals) for i in range(0, 400, 90)]
    wanted = {}
    for item, _, key, score in plain(docs, items, 5):
        wanted.setdefault(item, []).append((-score, key))
    savings = 0
    for item, query in enumerate(queries):
        top = []
        for part in parts:
            top = ranked.best_of(part, query, top, 5)
        assert top == wanted.get(item, [])
        for part in parts:
            there = [(int(part.place[t]), w) for t, w in query.items() if part.place[t] >= 0]
            if not there:
                continue
            lists, own = map(list, zip(*there))
            order, sums, _ = ranked.bounds(part, lists, own)
            savings += sum(w * int(part.maxima[t]) for t, w in there) - sums[-1]
            scores = np.zeros(len(part.m), dtype=np.int64)
            for n, i in enumerate(order):
                documents, impacts = part.list_of(lists[i])
                scores[documents] += own[i] * impacts
                assert scores.max() <= sums[n + 1] and sums[n] <= sums[n + 1]
    assert savings > 0  # pairs do tighten the bounds


def test_pairs_are_intersections():
    rng = random.Random(9)
    docs, *_ = corpus(rng, 200)
    totals = ranked.Totals(200, sum(len(words(t)) for _, t in docs))
    part = ranked.Slice(index_row(docs, totals), pa.array([], pa.large_binary()), totals)
    stored = 0
    for a, h in part.hot.items():
        for b, other in part.hot.items():
            if a < b:
                (da, ia), (db, ib) = part.list_of(a), part.list_of(b)
                both = np.intersect1d(da, db)
                assert part.joint[h, other] == max(ia[np.isin(da, both)], default=0)
                assert part.joint[other, h] == max(ib[np.isin(db, both)], default=0)
                found = part.pair_list(h, other)
                assert not len(found) or found.tolist() == both.tolist()
                stored += len(found)
    assert 0 < stored <= len(part.documents) // 2


def test_numbers_beyond_64_bits_are_exact():
    totals = ranked.Totals(10**13, 10**15)
    assert ranked.spread(np.array([10**9, 1]), totals).tolist() == [75 + 25 * 10**9 * 10**13 // 10**15, 75]


def test_search_equals_scoring_everything(spark, monkeypatch):
    monkeypatch.setattr(ranked, "SLICE_BYTES", 3000)
    monkeypatch.setattr(ranked, "BLOCK_BYTES", 200)
    rng = random.Random(7)
    docs, names, odds = corpus(rng, 300)
    docs += [(1000 + i, "w3 w7 hot text w50 Ünï") for i in range(150)] * 2  # ties and repeated rows
    docs += [(None, "w3 w7 hot text w50 Ünï"), (None, None), (5000, None), (5001, ""), (5002, "?! \n"),
             (5003, "W1 " * 50_000 + "Zebra"), (5004, "x" * 300_000)]
    items = [(i, " ".join(rng.choices(names, odds, k=rng.randint(1, 15)))) for i in range(25)]
    items += [(100, "hot text ünï ÜNÏ"), (100, "zebra w1"), (101, None), (102, ""), (103, "nowhere"), (None, "hot w3 w3 w3")]
    frame = spark.createDataFrame([(*d, 1, "clash") for d in docs], "doc_id long, text string, score int, item_id string")
    asked = spark.createDataFrame([(*i, 2, "clash") for i in items], "item_id long, text string, rank int, doc_id string")
    index, totals = ranked.build_index(frame.repartition(6))
    got = [tuple(r) for r in ranked.search(index, totals, asked.repartition(2), k=7).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain(docs, items, 7)))
    named = ranked.build_index(frame.selectExpr("CAST(doc_id AS string) AS doc_id", "text"))
    assert ranked.search(*named, asked).count() == len(plain(docs, items, 20))


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert [tuple(r) for r in ranked.search(*ranked.build_index(docs), items).collect()] == plain([(1, "a b")], [(1, "a")], 20)
    assert ranked.search(*ranked.build_index(docs), items.limit(0)).count() == 0
    assert ranked.search(*ranked.build_index(docs.limit(0)), items).count() == 0
    assert ranked.search(*ranked.build_index(docs.where("text IS NULL")), items).count() == 0
