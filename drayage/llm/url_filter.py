"""URL filters: exact membership of keys in a list by a cascade of Bloom filters.

Level 0 holds the listed keys.  Level 1 holds the keys of the corpus that are not listed but pass
level 0, level 2 the listed keys that pass level 1, and so on, until nothing passes that should
not.  Over the keys it was built for, the cascade so tells exactly which are listed, and asking it
is a look into some bits beside the row: no join, no shuffle.

To build it, every key of the corpus is tested where it lies; only what passes level 0 (the
listed keys and a small share of the others) is made distinct and compared with the list.  From
there on each level is about half of the one before.

A filter is sent to all tasks, so its size has a bound: beyond ``GROUP_KEYS`` listed keys the keys
are parted by their hash into groups with a cascade each, and every group is a pass of its own
over the rows.  Bits are gathered by Spark, word by word; the driver holds one group at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from drayage.scratch import new_path, stage

GROUP_KEYS = 16_000_000  # listed keys in one cascade; about 23 MB of bits
FIRST_ERROR, ERROR = 1 / 256, 1 / 2  # share of foreign keys that pass level 0, and any other level
MOST_LEVELS = 64
_SEED = 7


class Level(NamedTuple):
    """One Bloom filter: where its words are stored, its number of bits, and bits for each key."""

    path: str
    bits: int
    hashes: int


class Cascade(NamedTuple):
    """The levels of each group of keys."""

    groups: list[list[Level]]


def hashes(key: Column) -> tuple[Column, Column]:
    """128 bits of hash, in two numbers."""
    return F.xxhash64(key), F.xxhash64(F.lit(_SEED), key)


def _mixed(numbers: np.ndarray, level: int) -> np.ndarray:
    """Another hash of hashed numbers for each level."""
    x = numbers.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(a: np.ndarray, b: np.ndarray, level: int, bits: int, n: int) -> np.ndarray:
    """The ``n`` bits of each key, one column for each."""
    first, step = _mixed(a, level), _mixed(b, level) | np.uint64(1)
    return (first[:, None] + np.arange(n, dtype=np.uint64) * step[:, None]) % np.uint64(bits)


def is_listed(levels: list[tuple[np.ndarray, int, int]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which keys the cascade holds: the first level a key fails at tells on which side it is."""
    found, rows = np.zeros(len(a), dtype=bool), np.arange(len(a))
    for number, (words, bits, n) in enumerate(levels):
        places = _places(a[rows], b[rows], number, bits, n)
        inside = ((words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=1)
        found[rows[~inside]] = number % 2 == 1
        rows = rows[inside]
    found[rows] = len(levels) % 2 == 1
    return found


def _sized(keys: int, error: float) -> tuple[int, int]:
    n = max(1, round(-math.log2(error)))
    return max(64, math.ceil(keys * n / math.log(2))), n


def _build_level(keys: DataFrame, count: int, level: int) -> Level:
    """A filter that holds ``keys`` (``a``, ``b``); its words are combined by Spark and stored."""
    bits, n = _sized(count, FIRST_ERROR if level == 0 else ERROR)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
            places = np.unique(_places(a, b, level, bits, n))
            words, at = np.unique(places >> np.uint64(6), return_index=True)
            ones = np.left_shift(np.uint64(1), places & np.uint64(63))
            held = np.bitwise_or.reduceat(ones, at) if len(at) else ones
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.astype(np.int64)), pa.array(held.view(np.int64))], ["word", "bits"]
            )

    path = new_path(keys.sparkSession, "bloom")
    words = keys.select("a", "b").mapInArrow(run, "word bigint, bits bigint")
    words.groupBy("word").agg(F.bit_or("bits").alias("bits")).write.parquet(path)
    return Level(path, bits, n)


def _loaded(spark: SparkSession, level: Level) -> tuple[np.ndarray, int, int]:
    rows = spark.read.schema("word bigint, bits bigint").parquet(level.path).toArrow()
    words = np.zeros((level.bits + 63) // 64, dtype=np.uint64)
    words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return words, level.bits, level.hashes


def _passing(keys: DataFrame, level: Level, number: int) -> DataFrame:
    """Those of ``keys`` (``a``, ``b``) that pass one level."""
    held = keys.sparkSession.sparkContext.broadcast(_loaded(keys.sparkSession, level))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, bits, n = held.value
        for batch in batches:
            a, b = (batch.column(c).to_numpy().view(np.uint64) for c in ("a", "b"))
            places = _places(a, b, number, bits, n)
            inside = ((words[places >> np.uint64(6)] >> (places & np.uint64(63))) & np.uint64(1)).all(axis=1)
            yield batch.filter(pa.array(inside))

    return keys.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def build_cascade(listed: DataFrame, universe: DataFrame, key: str = "key") -> Cascade:
    """A cascade that tells exactly which keys of ``universe`` are in ``listed``.

    Both have the string column ``key``; repeated keys count once, null keys are never listed.
    Listed keys need not occur in ``universe``.  Any other key than those of the two tables gets
    an answer that is wrong with a small chance, as of any Bloom filter.
    """

    def hashed(frame: DataFrame) -> DataFrame:
        rows = frame.select(F.col(f"`{key}`").cast("string").alias("key")).where("key IS NOT NULL")
        return rows.select(*[h.alias(n) for h, n in zip(hashes(F.col("key")), "ab")])

    ours = stage(hashed(listed).distinct(), "listed-keys")
    total = ours.count()
    n_groups = max(1, math.ceil(total / GROUP_KEYS))
    every, groups = hashed(universe), []
    for group in range(n_groups):
        own, other = (d.where(F.pmod("a", F.lit(n_groups)) == group) for d in (ours, every))
        count = own.count()
        if not count:
            groups.append([])
            continue
        levels = [_build_level(own, count, 0)]
        strangers = _passing(other, levels[0], 0).distinct().join(own, ["a", "b"], "left_anti")
        held, tested = stage(strangers, "false-positives"), own
        while count := held.count():
            if len(levels) == MOST_LEVELS:
                raise RuntimeError("two keys agree in 128 bits of hash")
            levels.append(_build_level(held, count, len(levels)))
            held, tested = stage(_passing(tested, levels[-1], len(levels) - 1), "false-positives"), held
        groups.append(levels)
    return Cascade(groups)


def _asker(held: Broadcast, group: int, n_groups: int):
    """A function on Arrow lists of both hashes, for the keys of one group."""

    def ask(a: pa.Array, b: pa.Array) -> pa.Array:
        first, second = (x.flatten().to_numpy().view(np.uint64) for x in (a, b))
        inside = is_listed(held.value, first, second)
        if n_groups > 1:
            inside &= np.mod(first.view(np.int64), n_groups) == group
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(a), 0).to_numpy())])
        mask = pc.is_null(a) if a.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(inside), mask=mask)

    return ask


def with_membership(rows: DataFrame, keys: Column, name: str, cascade: Cascade) -> DataFrame:
    """``rows`` with the column ``name``: for each key of the array ``keys``, whether it is listed.

    A null array stays null, a null key is not listed.  One pass over the rows for each group.
    """
    spark, n_groups = rows.sparkSession, len(cascade.groups)
    for group, levels in enumerate(cascade.groups):
        held = spark.sparkContext.broadcast([_loaded(spark, level) for level in levels])
        answer = F.arrow_udf(_asker(held, group, n_groups), "array<boolean>")
        asked = answer(F.transform(keys, lambda k: hashes(k)[0]), F.transform(keys, lambda k: hashes(k)[1]))
        asked = F.zip_with(asked, keys, lambda inside, k: inside & k.isNotNull())
        if group:
            asked = F.zip_with(F.col(name), asked, lambda x, y: x | y)
        rows = rows.withColumn(name, asked)
        if n_groups > 1:
            rows = stage(rows, "membership")  # so that no task holds two groups' bits
    return rows


def likely(keys: DataFrame, name: str):
    """A function on columns: whether a whole number may be among those in column ``name``.

    One Bloom filter of at most the size for ``GROUP_KEYS`` keys; with more keys more foreign numbers pass.
    """
    spark = keys.sparkSession
    hashed = keys.select(*[h.alias(n) for h, n in zip(hashes(F.col(name)), "ab")])
    held = spark.sparkContext.broadcast(
        [_loaded(spark, _build_level(hashed, max(1, min(keys.count(), GROUP_KEYS)), 0))]
    )

    def ask(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(is_listed(held.value, *(x.to_numpy().view(np.uint64) for x in (a, b))))

    answer = F.arrow_udf(ask, "boolean")
    return lambda number: answer(*hashes(number))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``: up to ``/``, ``?`` or ``#``, A-Z lower-cased; then up to ``?`` or ``#``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(text, "://([^/?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(text, "://[^/?#]*([^?#]*)", 1)


def apply_rules(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Every url with the longest rule that fits it.

    ``rules`` has ``host``, ``path`` and ``verdict`` (``allow`` or ``block``).  A rule fits its host
    and all subdomains of it, where the url's path starts with the rule's.  Of fitting rules that with
    most characters wins, of equally long ones that with the longer host.  A rule given with both
    verdicts blocks.  Columns: ``key``, ``host``, ``path``, ``rule`` (null where none fits) and
    ``verdict`` of the rule.  A null url, or one without ``://``, has empty host and path.

    A rule can only fit as so many last labels of the host with so many first characters of the path;
    the numbers that occur among the rules (a few, whatever their number) give the keys that
    every url is asked for.
    """
    spark = pages.sparkSession
    rules = rules.select(
        F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).where("path = '' OR path LIKE '/%'")
    shapes = rules.select(
        F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars")
    ).distinct()
    # Distinct pairs of two small numbers: of labels in a host and characters in a path.
    shapes = sorted(map(tuple, shapes.collect()))
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias("key"), host.alias("host"), path.alias("path"))
    if not shapes:
        return rows.withColumns({c: F.lit(None).cast("string") for c in ("rule", "verdict")})
    n_labels = F.size(F.split("host", r"\."))
    asked = [
        F.when(
            (n_labels >= labels) & (F.length("path") >= chars),
            F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, chars)),
        )
        for labels, chars in shapes
    ]
    rows = rows.withColumn("asked", F.filter(F.array(*asked), lambda k: k.isNotNull()))
    named = rules.select(F.concat("host", "path").alias("key"), "verdict")
    listed = build_cascade(named, rows.select(F.explode("asked").alias("key")))
    blocking = build_cascade(named.where("verdict = 'block'"), named)
    rows = with_membership(rows, F.col("asked"), "is_rule", listed)

    def sized(k: Column) -> Column:
        return F.struct(F.length(k).alias("size"), F.length(F.substring_index(k, "/", 1)).alias("host"), k.alias("key"))

    fitting = F.transform(
        F.filter(F.arrays_zip("asked", "is_rule"), lambda x: x["is_rule"]), lambda x: sized(x["asked"])
    )
    rows = rows.select("key", "host", "path", F.array_max(fitting)["key"].alias("rule"))
    rows = with_membership(rows, F.array("rule"), "blocks", blocking)
    verdict = F.when(F.col("rule").isNotNull(), F.when(F.get("blocks", F.lit(0)), "block").otherwise("allow"))
    return rows.withColumn("verdict", verdict).drop("blocks")


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """A verdict for every url: that of its rule, else that of its host.

    A host is blocked when the rules block more of its urls than they allow.  These hosts are the
    listed keys of a cascade over all hosts of the corpus; urls that no rule fits ask it.  Columns as
    of ``apply_rules``, with ``verdict`` never null.  Extra columns of ``pages`` are left out; repeated
    rows are returned each; an empty table gives an empty result.
    """
    ruled = stage(apply_rules(pages, rules, key, url), "ruled-urls")
    count = {v: F.count_if(F.col("verdict") == v).alias(v) for v in ("allow", "block")}
    hosts = stage(ruled.groupBy(F.col("host").alias("key")).agg(*count.values()), "hosts")
    cascade = build_cascade(hosts.where("block > allow"), hosts)
    rows = with_membership(ruled, F.array("host"), "listed", cascade)
    default = F.when(F.get("listed", F.lit(0)), "block").otherwise("allow")
    return rows.withColumn("verdict", F.coalesce("verdict", default)).drop("listed")
