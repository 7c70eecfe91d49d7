"""Exact and near duplicates against brute force, and the odd cases."""

import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from drayage.llm import exact_dedup, overlap, simhash
from drayage.llm.components import component_roots

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], SCHEMA)


ROWS = [(1, "a b c"), (2, "a b c"), (2, "a b c"), (3, None), (4, ""), (None, "a b c"), (5, "x" * 200_000), (None, "n")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda c: F.length(c).cast("string")])
def test_groups_are_those_of_equal_texts(spark, digest):
    rows = ROWS + [(6, "c b a")]  # as long as another text, so the second digest collides
    groups = defaultdict(list)
    for k, t in rows:
        groups[t or ""].append(k)
    want = sorted(
        (str(k), str(max((x for x in g if x is not None), default=None)), len(g)) for g in groups.values() for k in g
    )
    got = exact_dedup.duplicate_groups(docs(spark, rows), digest=digest).collect()
    assert sorted((str(r.key), str(r.keep), r.group_size) for r in got) == want


def test_one_row_of_each_text_stays(spark):
    kept = exact_dedup.keep_one(docs(spark, ROWS)).collect()
    assert sorted((r.text or "")[:5] for r in kept) == sorted({(t or "")[:5] for _, t in ROWS})
    assert {r.doc_id for r in kept if r.text == "a b c"} == {2}


def test_hot_group_is_spread_over_salts(spark):
    rows = [(i, "same") for i in range(3000)] + [(i, f"t{i}") for i in range(3000, 3100)]
    got = exact_dedup.duplicate_groups(docs(spark, rows))
    assert got.where("group_size = 3000 AND keep = 2999").count() == 3000


def test_columns_that_clash_and_empty_tables(spark):
    frame = docs(spark, ROWS).withColumns({"_digest": F.lit(1), "key": F.lit(2), "_copies": F.lit(3)})
    assert exact_dedup.keep_one(frame).columns == frame.columns
    assert simhash.keep_one_of_each(frame).columns == frame.columns
    empty = docs(spark, [])
    assert exact_dedup.duplicate_groups(empty).count() == 0
    assert exact_dedup.keep_one(empty).count() == 0
    assert simhash.near_duplicate_groups(empty).count() == 0
    assert simhash.keep_one_of_each(empty).count() == 0


def plain_fingerprint(text, size):
    words = (text or "").encode().translate(simhash.LOWER).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def test_fingerprints_follow_the_definition():
    rng = random.Random(1)
    texts = [None, "", "one", "A b", " ".join(rng.choices("ab cd éf gh".split(), k=40)), " x  y"]
    for text in texts:
        for size in (3, 5):
            assert simhash.fingerprint(text.encode() if text else None, size) == plain_fingerprint(text, size)


def reach(values, radius):
    """Components by comparing all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize(("radius", "blocks", "chunk"), [(2, 4, 2048), (2, 3, 8), (6, 9, 16)])
def test_links_reach_as_far_as_all_pairs(spark, radius, blocks, chunk):
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(60)}
    for center in list(values)[:6]:
        for _ in range(40):
            flips = rng.sample(range(64), rng.randint(0, radius + 1))
            values.add(center ^ sum(1 << f for f in flips))
    values = sorted(values)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    links = simhash.close_links(prints, radius, blocks, chunk).distinct()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= radius for r in links.collect())
    roots = {r.node: r.root for r in component_roots(links.toDF("u", "v")).collect()}
    got = defaultdict(set)
    for v in signed:
        got[roots.get(v, v)].add(v)
    want = defaultdict(set)
    for v, r in zip(signed, reach(values, radius)):
        want[r].add(v)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(1000, 1300)] + [(5, 5), (2, 1), (1, 2)]
    roots = {r.node: r.root for r in component_roots(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(roots[i] == 100 for i in range(100, 161))
    assert all(roots[i] == 7 for i in range(1000, 1300)) and roots[2] == 1


def test_near_copies_leave_one(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    text = rng.choices(words, k=1500)
    near = [*text[:300], "changed", *text[301:]]
    rows = [(3, " ".join(text)), (2, " ".join(near)), (2, " ".join(near)), (9, " ".join(rng.choices(words, k=600)))]
    rows += [(None, None), (11, ""), (12, " ")]
    kept = simhash.keep_one_of_each(docs(spark, rows), shingle=5, radius=6, blocks=9).collect()
    assert sorted(r.doc_id for r in kept) == [2, 9, 11]
    found = {r.key: r.component for r in simhash.near_duplicate_groups(docs(spark, rows)).collect()}
    assert found[3] == found[2] == 2 and found[None] == found[12] == 11


def jaccard(a, b, size=5):
    sets = [{tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} for w in (a, b)]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_similar_rows_are_those_of_all_pairs(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    texts = []
    for length in (60, 80, 100, 150, 300) * 6:
        text = rng.choices(words, k=length)
        texts.append(text)
        for _ in range(3):  # a word changed here and there: similarities from 0.6 to 0.95
            near = list(text)
            for _ in range(rng.randint(1, max(1, length // 50))):
                near[rng.randrange(length)] = "changed"
            texts.append(near)
    # A long chain: neighbours are similar, its ends are not.
    chain = rng.choices(words, k=120)
    texts += [chain[i : i + 100] for i in range(0, 20, 2)]
    values = [(jaccard(a, b), i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if j < i]
    assert sum(0.8 <= v < 0.95 for v, _, _ in values) > 30
    linked = {(i, j) for v, i, j in values if v >= 0.8}
    root = list(range(len(texts)))
    for _ in texts:
        for i, j in linked:
            root[i] = root[j] = min(root[i], root[j])
    frame = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    got = {r.key: r.component for r in overlap.similar_groups(frame, chunk=4).collect()}
    assert [got[i] for i in range(len(texts))] == root
    kept = simhash.keep_one_of_each(frame).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(root))


def test_spanning_pairs_are_the_most_alike():
    rng = np.random.default_rng(2)
    for _ in range(50):
        n = int(rng.integers(2, 30))
        sketches = np.ascontiguousarray(rng.integers(0, 2, (n, overlap.MINIMA), dtype=np.uint8).T)
        root = rng.integers(0, n, n)
        agree = (sketches[:, :, None] == sketches[:, None, :]).sum(axis=0)
        close = sorted(((int(agree[i, j]), i, j) for i in range(n) for j in range(i)), reverse=True)
        own, want = root.copy(), []
        for weight, i, j in close:
            if weight >= 44 and own[i] != own[j]:
                want.append(weight)
                own[own == own[i]] = own[j]
        got = [(i, j) for a, b in overlap._spanning(sketches, root, 44) for i, j in zip(a, b)]
        assert sorted((int(agree[i, j]) for i, j in got), reverse=True) == want
        crossing = {(i, j) for a, b in overlap._crossing(sketches, root, 44) for i, j in zip(a, b)}
        assert crossing == {(j, i) for weight, i, j in close if weight >= 44 and root[i] != root[j]}


def test_copies_that_one_text_connects(spark):
    """Every copy is close to the first text, but no two copies are close to each other."""
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(base)]
    for i in range(60):
        words = list(base)
        words[(7 * i) % 120] = f"x{i}"
        words[(7 * i + 50) % 120] = f"y{i}"
        texts.append(" ".join(words))
    texts += ["other words " + " ".join(f"z{i}" for i in range(80)), " ".join(f"z{i}" for i in range(80))]
    rows = list(enumerate(texts))
    random.Random(4).shuffle(rows)
    got = {r.key: r.component for r in overlap.similar_groups(docs(spark, rows), chunk=8).collect()}
    assert [got[i] for i in range(len(texts))] == [0] * 61 + [61, 61]


def edited(n, most, seed):
    """A text, and copies of it in which up to ``most`` words are others."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(150)]
    texts = [base]
    for i in range(n):
        text = list(base)
        for at in rng.sample(range(150), rng.randint(0, most)):
            text[at] = f"x{i}y{at}"
        texts.append(text)
    return texts


def test_copies_too_far_apart_take_few_comparisons(spark, monkeypatch):
    """Most copies share too little, but far more than other texts: their pairs are not compared one by one."""
    verified, asked = overlap._verified, []

    def counting(links, *rest):
        asked.append(links.count())
        return verified(links, *rest)

    monkeypatch.setattr(overlap, "_verified", counting)
    texts = edited(400, 12, 6)
    frame = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    got = {r.key: r.component for r in overlap.similar_groups(frame).collect()}
    linked = [(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts[:i]) if jaccard(a, b) >= 0.8]
    root = list(range(len(texts)))
    for _ in range(3):
        for i, j in linked:
            root[i] = root[j] = min(root[i], root[j])
    assert [got[i] for i in range(len(texts))] == root and len(set(root)) > 200
    assert sum(asked) < 20 * len(texts)


def test_rare_shingles_lead_to_all_similar_pairs(spark):
    texts = edited(80, 16, 9) + [t[:k] for t in edited(6, 2, 4) for k in (3, 5, 9, 30)]
    frame = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    rows = overlap._described(frame, "doc_id", "text", 5)
    classes = rows.groupBy("digest").agg(
        F.min("key").alias("first"), F.first("text_hash").alias("text_hash"), F.first("sketch").alias("sketch")
    )
    # All sets share one key, and none is linked yet.
    members = classes.select("digest", "sketch", F.lit(0).alias("band"), F.lit(0).cast("long").alias("block"))
    members = members.withColumns({"n": F.lit(999), "salt": F.lit(3), "size": F.lit(0), "rest": F.lit(0)})
    none = spark.createDataFrame([], "node binary, root binary")
    least = classes.agg(F.min("digest")).first()[0]
    pairs = classes.where("digest <> x''").select(F.lit(least).alias("a"), F.col("digest").alias("b"))
    found = overlap._by_rare_shingles(members, none, pairs, classes, frame, "text", 5, 0.8)
    proposed = overlap._apart(found, none, 0, 8, False, 0.8)
    first = {bytes(r.digest): r.first for r in classes.select("digest", "first").collect()}
    got = {tuple(sorted((first[bytes(r.a)], first[bytes(r.b)]))) for r in proposed.collect()}
    every = sorted(first.values())
    want = {(i, j) for i in every for j in every if i < j and jaccard(texts[i], texts[j]) >= 0.8}
    assert len(want) > 20 and want <= got
    assert len(got) < len(every) * (len(every) - 1) / 4


def test_similar_rows_of_odd_tables(spark):
    frame = docs(spark, [*ROWS, (7, " "), (8, "A  b C")]).withColumns({"_digest": F.lit(1), "key": F.lit(2)})
    kept = simhash.keep_one_of_each(frame)
    assert kept.columns == frame.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "None"]
    assert simhash.keep_one_of_each(docs(spark, [])).count() == 0
    assert overlap.similar_groups(docs(spark, [])).count() == 0


def test_simhash_proposes_and_shingles_decide(spark, monkeypatch):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    texts = [rng.choices(words, k=900) for _ in range(6)]
    texts += [[*texts[0][:300], "changed", *texts[0][301:]], [*texts[1], texts[1][-1]]]
    frame = docs(spark, [(i, " ".join(t)) for i, t in enumerate(texts)])
    prints = [simhash.fingerprint(" ".join(t).encode()) & (1 << 64) - 1 for t in texts]
    assert (prints[0] ^ prints[6]).bit_count() <= overlap.RADIUS and (prints[1] ^ prints[7]).bit_count() <= overlap.RADIUS
    # Without any pair from the bands, those from fingerprints are still found.
    members = overlap._members
    monkeypatch.setattr(overlap, "_members", lambda classes: members(classes).where("false"))
    assert {r.key: r.component for r in overlap.similar_groups(frame).collect()} == {**{i: i for i in range(6)}, 6: 0, 7: 1}
    # Fingerprints alone link nothing: here all are said to be close.
    everything = lambda prints, *_: prints.toDF("a").crossJoin(prints.toDF("b")).where("a < b")
    monkeypatch.setattr(overlap, "close_links", everything)
    assert {r.key: r.component for r in overlap.similar_groups(frame).collect()} == {**{i: i for i in range(6)}, 6: 0, 7: 1}
