"""Chains of pages and tables of boxes against brute force."""

import random

from pyspark.sql import functions as F

from drayage.plans.paging import chain_order
from drayage.plans.regions import in_boxes


def follow(links, start):
    seen, at = [], start
    while True:
        seen.append(at)
        after = links[at]
        if after is None:
            return "complete", at, len(seen) - 1
        if after not in links:
            return "broken", at, len(seen) - 1
        if after in seen:
            return "cycle", None, None
        at = after


def test_chains_of_any_shape(spark):
    rng = random.Random(4)
    rows, wanted = [], {}
    for listing in range(30):
        names = [f"p{i}" for i in range(rng.randint(1, 40))]
        links = {n: (rng.choice([None, "lost", *names]) if rng.random() < 0.2 else after)
                 for n, after in zip(names, [*names[1:], None])}
        rows += [(listing, n, after, 1) for n, after in links.items()]
        found = {n: follow(links, n) for n in names}
        longest = {}
        for _, last, steps in found.values():
            longest[last] = max(longest.get(last, 0), steps or 0)
        for n, (state, last, steps) in found.items():
            wanted[listing, n] = (state, last, steps, None if steps is None else longest[last] - steps)
    rows += rows[:50] + [(0, None, "p1", 1), (None, "x", None, 1)]  # repeated pages, pages without an offset
    frame = spark.createDataFrame(rows, "request_key int, offset string, next_offset string, state int")
    got = {(r.request_key, r.offset): (r.state, r.last, r.following, r.position) for r in chain_order(frame).collect()}
    got.pop((None, "x"), None)
    assert got == wanted and {w[0] for w in wanted.values()} == {"complete", "broken", "cycle"}
    assert chain_order(frame.limit(0)).count() == 0


def test_a_long_chain_takes_few_rounds(spark):
    pages = spark.range(5000).selectExpr("'k' request_key", "id offset", "if(id < 4999, id + 1, null) next_offset")
    ends = chain_order(pages).where("position IN (0, 4999)").orderBy("position").collect()
    assert [(r.offset, r.following, r.last) for r in ends] == [(0, 4999, 4999), (4999, 0, 4999)]


def test_boxes_of_all_sizes(spark):
    rng = random.Random(6)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(400)]
    points += [(1000, None, 1.0), (1001, 1.0, None), (1002, 90.0, 180.0), (1003, -90.0, -180.0), (1004, 10.0, 20.0)] + [(1005, 10.0, 20.0)] * 99
    boxes = [("globe", -90.0, 90.0, -180.0, 180.0), ("point", 10.0, 10.0, 20.0, 20.0), ("none", 5.0, -5.0, 0.0, 1.0),
             ("date line", -30.0, 30.0, 170.0, -170.0), ("null", None, 1.0, 1.0, 2.0)]
    for i in range(300):
        south, west, size = rng.uniform(-90, 80), rng.uniform(-180, 170), 10 ** rng.uniform(-3, 1.8)
        boxes.append((f"b{i}", south, south + size, west, min(180.0, west + size * rng.uniform(0.1, 3))))
    wanted = sorted(
        (p, name) for p, lat, lon in points for name, s, n, w, e in boxes
        if None not in (lat, lon, s) and s <= lat <= n and (w <= lon <= e if w <= e else lon >= w or lon <= e)
    )
    found = in_boxes(spark.createDataFrame(points, "id int, latitude double, longitude double"),
                     spark.createDataFrame(boxes, "name string, south double, north double, west double, east double"))
    assert sorted((r["id"], r["name"]) for r in found.collect()) == wanted
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_boxes_are_never_broadcast(spark):
    # A small table of boxes is many rows under its cells; crowded cells and all others give every pair once.
    points = spark.range(3000).selectExpr("id", "id % 7 * 10.0 latitude", "IF(id % 3 = 0, 5.0, id % 360 - 180.0) longitude")
    boxes = spark.range(500).selectExpr("id box", "id % 60 - 0.5 south", "id % 60 + 1.5 north", "id % 9 - 0.5 west", "id % 9 + 40.0 east")
    found = in_boxes(points, boxes)
    assert "SortMergeJoin" in found._jdf.queryExecution().executedPlan().toString()
    wanted = points.join(boxes, F.expr("latitude BETWEEN south AND north AND longitude BETWEEN west AND east"))
    same = ["id", "box"]
    assert found.select(same).exceptAll(wanted.select(same)).isEmpty() and found.count() == wanted.count() > 0
