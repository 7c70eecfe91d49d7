"""Cascades against plain sets, rules against a plain loop."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from drayage.llm import url_filter


def listed_by_cascade(spark, cascade, keys):
    rows = spark.createDataFrame([(k,) for k in keys], "key string").withColumn("extra", F.lit(1))
    asked = url_filter.with_membership(rows, F.array("key"), "there", cascade)
    return [(r.key, r.there[0]) for r in asked.collect()]


@pytest.mark.parametrize("group_keys", [10**6, 400])
def test_membership_is_exact_over_the_universe(spark, monkeypatch, group_keys):
    monkeypatch.setattr(url_filter, "GROUP_KEYS", group_keys)
    monkeypatch.setattr(url_filter, "FIRST_ERROR", 1 / 4)  # more levels
    universe = [f"k{i}" for i in range(6000)]
    listed = {f"k{i}" for i in range(0, 6000, 5)} | {"elsewhere", ""}
    frames = [spark.createDataFrame([(k, "x") for k in ks], "key string, key2 string")
              for ks in ([*listed, *listed, None], [*universe, *universe[:99], None, ""])]
    cascade = url_filter.build_cascade(*frames)
    assert len(cascade.groups) == -(-len(listed) // group_keys) and all(len(g) > 2 for g in cascade.groups)
    got = listed_by_cascade(spark, cascade, [*universe, "", None, "elsewhere"])
    assert len(got) == 6003 and {k for k, there in got if there} == listed


def test_empty_lists_and_universes(spark):
    none = spark.createDataFrame([], "key string")
    some = spark.createDataFrame([("a",), ("b",)], "key string")
    assert listed_by_cascade(spark, url_filter.build_cascade(none, some), ["a", "b"]) == [("a", False), ("b", False)]
    assert set(listed_by_cascade(spark, url_filter.build_cascade(some, none), ["a", "b"])) == {("a", True), ("b", True)}
    rows = spark.createDataFrame([(None,), ([],), (["a", "c", None],)], "keys array<string>")
    asked = url_filter.with_membership(rows, F.col("keys"), "there", url_filter.build_cascade(some, none))
    assert {str(r["keys"]): r["there"] and r["there"][::2] for r in asked.collect()}["None"] is None


def test_levels_alternate():
    a = np.arange(4, dtype=np.uint64)
    full, empty = np.full(1, 2**64 - 1, dtype=np.uint64), np.zeros(1, dtype=np.uint64)
    level = lambda words: (words, 64, 1)
    assert not url_filter.is_listed([], a, a).any()
    assert url_filter.is_listed([level(full)], a, a).all() and not url_filter.is_listed([level(empty)], a, a).any()
    assert url_filter.is_listed([level(full), level(empty)], a, a).all()
    assert not url_filter.is_listed([level(full), level(full), level(empty)], a, a).any()


def plain_rule(host, path, rules):
    fitting = [(len(h + p), len(h), h + p, v) for h, p, v in rules
               if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fitting:
        return None, None
    best = max(fitting)[:3]
    return best[2], "block" if "block" in [f[3] for f in fitting if f[:3] == best] else "allow"


def test_rules_against_a_plain_loop(spark):
    rng = random.Random(5)
    labels, paths = ["a", "b", "com", "x.y", "", "A"], ["", "/", "/d/", "/d/1", "/de", "x"]
    rules = [(rng.choice(labels) + rng.choice([".", ""]) + rng.choice(labels), rng.choice(paths), rng.choice(["allow", "block"]))
             for _ in range(25)] + [("com", "/d/", "allow"), ("com", "/d/", "block"), ("x", None, "allow"), (None, "/q", "block")]
    urls = [f"{rng.choice(['http://', 'HTTPS://', '', '://'])}{'.'.join(rng.choices(labels, k=rng.randint(1, 4)))}"
            f"{rng.choice(['', '/', '/d/', '/d/12', '/de?x=/d/', '?a://b', '#/d/', '/d/1#x'])}" for _ in range(600)]  # fmt: skip
    urls += [None, "", "no scheme", "http://" + "a." * 50_000 + "com/d/" + "z" * 100_000, "http://com/d/\nx", "http:///d/"]
    rows = [(i, u, "clash", "h", "r") for i, u in enumerate(urls)] + [(3, urls[3], "clash", "h", "r"), (None, "http://com/d/", "", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, key string, host string, rule string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    known = [(h or "", p or "", v) for h, p, v in rules]
    wanted, tally = [], {}
    for i, url, *_ in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
        host = rest[:cut].translate(lower)
        rule, verdict = plain_rule(host, path, known)
        tally[host] = tally.get(host, 0) + {"block": 1, "allow": -1, None: 0}[verdict]
        wanted.append((i, host, path, rule, verdict))
    default = {h: "block" if n > 0 else "allow" for h, n in tally.items()}
    wanted = [(i, h, p, r, v or default[h]) for i, h, p, r, v in wanted]
    got = [tuple(r) for r in url_filter.judge_urls(pages, table).collect()]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    assert {"block", "allow"} == set(default.values())
    unruled = url_filter.judge_urls(pages, table.limit(0)).collect()
    assert len(unruled) == len(rows) and {(r.rule, r.verdict) for r in unruled} == {(None, "allow")}
    assert url_filter.judge_urls(pages.limit(0), table).count() == 0
