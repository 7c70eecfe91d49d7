"""A listing read by many cursors has the same rows as one chain."""

import json
import random

import pytest
from pyspark.sql import functions as F

from drayage import registry
from drayage.landed import fetch_chain
from drayage.plans import cursors
from drayage.sources import points


def service(ids, size, fail_at=None):
    """Scrolls through sorted ids: whole numbers first, then text."""
    ordered = sorted(ids, key=lambda i: (isinstance(i, str), i))

    def get(request):
        start = json.loads(request["body"]).get("offset")
        key = lambda i: (isinstance(i, str), i)
        left = ordered if start is None else [i for i in ordered if key(i) >= key(start)]
        if fail_at is not None and fail_at in left[:size]:
            return 500, "broken"
        after = left[size] if len(left) > size else None
        result = {"points": [{"id": i, "vector": [1], "payload": {}} for i in left[:size]], "next_page_offset": after}
        return 200, json.dumps({"result": result})

    return get


def split(spark, ids, size, pages, fail_at=None):
    body = lambda cursor: json.dumps({} if cursor is None else {"offset": cursor})
    return cursors.fetch_split(
        spark, "c", "u", body, cursors.next_page_offset, "points", service(ids, size, fail_at), 4, pages
    )


def kept(landed):
    rows = points.points(landed, on_error="skip").collect()
    return sorted(r["id"] for r in rows)


@pytest.mark.parametrize("shape", ["dense", "clusters", "mixed", "text", "one", "none"])
def test_same_rows_as_one_chain(spark, shape):
    rng = random.Random(1)
    ids = {
        "dense": list(range(300)),
        "clusters": [c + i for c in (0, 2**40, 2**63, 2**64 - 60) for i in range(60)],
        "mixed": [*rng.sample(range(2**62), 100), *(f"{rng.getrandbits(128):032x}" for _ in range(80))],
        "text": [f"{rng.getrandbits(128):032x}" for _ in range(60)],
        "one": [7],
        "none": [],
    }[shape]
    landed = split(spark, ids, 5, 3)
    assert kept(landed) == sorted(map(str, ids))
    chains = landed.select("request_key").distinct().count()
    assert chains > 3 if shape in ("dense", "clusters", "mixed") else chains == 1
    numbers = landed.groupBy("request_key").agg(F.max("page_no").alias("last"))
    if shape in ("dense", "clusters"):
        assert numbers.agg(F.max("last")).first()[0] <= 2


def test_a_failed_page_shows(spark):
    landed = split(spark, list(range(100)), 5, 3, fail_at=50)
    assert landed.where("status = 500").count() >= 1 and "50" not in kept(landed)
    with pytest.raises(Exception, match="failed with status 500"):
        points.points(landed).collect()


def test_collections_are_read_in_several_tasks(spark):
    ids = list(range(0, 4000, 2))
    frame = registry.read(spark, "qdrant", get=service(ids, 100), url="http://q", collection="c", limit=100)
    assert sorted(int(r["id"]) for r in frame.collect()) == ids
    assert fetch_chain is not None and cursors.PAGES_PER_CHAIN < len(ids) // 100
