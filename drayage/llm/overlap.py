"""Near copies by SimHash and by the overlap of their shingles: both propose pairs, the shingles decide.

SimHash fingerprints that differ in at most ``RADIUS`` bits meet by pigeonhole blocks (``simhash.close_links``).
As a similarity of 0.8 lies about ten bits apart, MinHash bands propose the pairs that are further apart.

The similarity of two texts is the share of their distinct shingles that they have in common
(Jaccard).  A text has ``BANDS`` keys, each made of ``ROWS`` minima of its hashed shingles; two
texts of similarity ``s`` share a key with a chance of ``1 - (1 - s ** ROWS) ** BANDS``, which is
0.99997 at 0.8 and more above.  All pairs that share a key are checked by their whole shingles.

Work is done on distinct sets of shingles.  First all members of a key are compared with its
smallest one.  Members that are connected then need no comparison, so what is left are keys whose
members are not all connected; these are cut into chunks, and every pair of chunks is a group of
its own.  In a group, the pairs that agree most and together would connect all its components are
compared, round by round, as long as most of them hold; so a group of ``n`` copies that one member
connects takes about ``n`` comparisons and not their square.  A sketch of a byte for each minimum
leaves out pairs that cannot be similar enough.

Large groups whose members have much in common, but too little, are left apart by that.  Their sets
are then keyed by their rarest shingles instead: sets that are similar enough share one of those that
come before the part they must have in common, and early enough in both for that part to follow.
What is frequent in such a group comes last and proposes nothing.  All pairs of these keys, and of
keys of at most ``FEW`` members, that are still in different components are compared at the end, so no
link is lost.

Sets of shingles are as large as the texts, so none is stored: those of proposed pairs are made again from
their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.llm.components import component_roots
from drayage.llm.salted import SALTS, join_back, salt_mask, salt_of
from drayage.llm.simhash import CHUNK, close_links, majority, shingle_hashes
from drayage.llm.url_filter import likely
from drayage.llm.words import give_back, slices
from drayage.scratch import new_path, stage, staging_scope

RADIUS, BLOCKS = 3, 6  # 20 keys of three blocks, 32 bits each
BANDS, ROWS = 20, 4
MINIMA = BANDS * ROWS
FEW = 16  # members of a key that may all be compared with each other
_SLICE_BYTES = 8 << 20
_PIECE = 2048  # shingles that are hashed at once
_RANDOM = np.random.default_rng(7)
_FACTORS = _RANDOM.integers(0, 1 << 63, (MINIMA, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SUMMANDS = _RANDOM.integers(0, 1 << 63, (MINIMA, 1), dtype=np.uint64)
_MOST = np.iinfo(np.uint64).max


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of the shingles under each of ``MINIMA`` hash functions."""
    least = np.full(MINIMA, _MOST)
    for at in range(0, len(shingles), _PIECE):
        least = np.minimum(least, (shingles[at : at + _PIECE] * _FACTORS + _SUMMANDS).min(axis=1))
    return least


def least_agreeing(similarity: float) -> int:
    """So many minima agree in all but about one in a million pairs of that similarity: five deviations below the mean."""
    return max(1, int(MINIMA * similarity - 5 * (MINIMA * similarity * (1 - similarity)) ** 0.5))


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    """Whether two sets have at least that share of their shingles in common; empty sets are alike."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common >= similarity * (len(a) + len(b) - common) - 1e-9


def _described(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """Every row's ``key``, ``text_hash``, ``fingerprint`` by SimHash, ``digest`` of its shingles, keys by band, and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                prints, digests, bands, sketches = [], [], [], []
                for cell in part.column("text").cast(pa.binary()):
                    hashes = shingle_hashes(cell.as_py(), shingle)
                    prints.append(majority(hashes))
                    found = np.unique(np.array(hashes, dtype=np.uint64))
                    least = minima(found)
                    digests.append(xxhash.xxh3_128_digest(found.tobytes()))
                    blocks = least.reshape(BANDS, ROWS)
                    bands.append(np.array([xxhash.xxh64_intdigest(b.tobytes()) for b in blocks], np.uint64).view(np.int64))
                    sketches.append(least.astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"), part.column("text_hash"), pa.array(prints, pa.int64()),
                        pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64())),
                        pa.array(sketches, pa.binary()),
                    ],
                    ["key", "text_hash", "fingerprint", "digest", "bands", "sketch"],
                )

    rows = _texts(docs, text).withColumn("key", F.col(f"`{key}`")).select("key", "text_hash", "text")
    kind = rows.schema["key"].dataType.simpleString()
    schema = f"key {kind}, text_hash long, fingerprint long, digest binary, bands array<long>, sketch binary"
    return rows.mapInArrow(run, schema)


def _texts(docs: DataFrame, text: str) -> DataFrame:
    content = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.withColumns({"text": content, "text_hash": F.xxhash64(content)})


def _sets_of(wanted: DataFrame, docs: DataFrame, text: str, shingle: int) -> DataFrame:
    """The shingles of the ``wanted`` texts (``text_hash``, ``digest``), made again from the text.

    A Bloom filter leaves the other texts where they are, so only wanted ones are shuffled, and of each
    only one copy by every task.  The filter has a bounded size; beyond it more texts than needed are moved.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                sets = [
                    np.unique(np.array(shingle_hashes(cell.as_py(), shingle), dtype=np.uint64)).tobytes()
                    for cell in part.column("text").cast(pa.binary())
                ]
                digests = pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary())
                made = pa.RecordBatch.from_arrays([digests, pa.array(sets, pa.binary())], ["digest", "shingles"])
                yield made.filter(pa.compute.equal(digests, part.column("digest").cast(pa.binary())))

    asked = likely(wanted, "text_hash")
    texts = _texts(docs, text).where(asked(F.col("text_hash"))).groupBy("text_hash").agg(F.first("text").alias("text"))
    named = texts.join(wanted, "text_hash").select("digest", "text")
    return stage(named.mapInArrow(run, "digest binary, shingles binary"), "overlap-sets")


def _matrix(sketches: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sketches.to_pylist()), dtype=np.uint8).reshape(-1, MINIMA)


def _members(classes: DataFrame) -> DataFrame:
    """A row for each set and band whose key other sets have too, with the smallest of them.

    Only keys and digests are shuffled for all sets; sketches join the few that share a key.
    """
    keyed = classes.select("digest", F.posexplode("bands").alias("band", "block"))
    keyed = keyed.withColumn("salt", salt_of(F.col("digest")))
    shared = (
        keyed.groupBy("band", "block")
        .agg(F.count("*").alias("n"), F.min("digest").alias("first"), salt_mask(F.col("salt")).alias("salts"))
        .where("n > 1")
    )
    least = classes.select(F.col("digest").alias("first"), F.struct("digest", "sketch").alias("least"))
    shared = shared.join(least, "first").drop("first")
    members = join_back(keyed, shared, ["band", "block"], "salt", "salts", "inner")
    # Where keys are shingles, ``rest`` of the ``size`` of a set follow; a band says nothing of that.
    unknown = {name: F.lit(0) for name in ("size", "rest")}
    return members.join(classes.select("digest", "sketch"), "digest").withColumns(unknown)


def _close_prints(classes: DataFrame, chunk: int) -> DataFrame:
    """Pairs ``a``, ``b`` of sets whose SimHash fingerprints are equal or differ in at most ``RADIUS`` bits.

    Sets of one fingerprint are paired with the smallest of them, and so are fingerprints that are close.
    """
    salted = classes.select("fingerprint", "digest").withColumn("salt", salt_of(F.col("digest")))
    prints = stage(
        salted.groupBy("fingerprint").agg(F.min("digest").alias("least"), salt_mask(F.col("salt")).alias("salts")),
        "overlap-prints",
    )
    equal = join_back(salted, prints, "fingerprint", "salt", "salts", "inner").where("digest <> least")
    links = close_links(prints.select("fingerprint"), RADIUS, BLOCKS, chunk).distinct()
    for end in ("a", "b"):
        named = prints.select(F.col("fingerprint").alias(end), F.col("least").alias(f"of_{end}"))
        links = links.join(named, end)
    close = links.select(F.greatest("of_a", "of_b").alias("a"), F.least("of_a", "of_b").alias("b"))
    return equal.select(F.col("digest").alias("a"), F.col("least").alias("b")).unionByName(close)


def _with_least(members: DataFrame, agreeing: int) -> DataFrame:
    """Pairs ``a``, ``b`` of a member and the smallest one of its key, where the sketches agree enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = pa.array((_matrix(batch.column("sketch")) == _matrix(batch.column("other"))).sum(axis=1) >= agreeing)
            yield batch.select(["a", "b"]).filter(alike)

    pairs = members.where("digest <> least.digest").select(
        F.col("digest").alias("a"), F.col("least.digest").alias("b"), "sketch", F.col("least.sketch").alias("other")
    )
    return pairs.mapInArrow(run, "a binary, b binary").distinct()


def _apart(
    members: DataFrame, roots: DataFrame, agreeing: int, chunk: int, spanning: bool, similarity: float
) -> DataFrame:
    """Pairs ``a``, ``b`` of one key that lie in different components, where the sketches agree enough.

    All such pairs, or with ``spanning`` of each group of members only the most alike ones that would
    connect them: fewer pairs than components, and none only if there is none at all.
    """
    roots = roots.withColumnRenamed("node", "digest")
    own = F.coalesce("root", "digest").alias("root")
    light = members.select("digest", "band", "block", "salt").join(roots, "digest", "left")
    mixed = light.select("band", "block", "salt", own).groupBy("band", "block").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), salt_mask(F.col("salt")).alias("salts")
    )
    mixed = mixed.where("low <> high").drop("low", "high")
    left = join_back(members, mixed, ["band", "block"], "salt", "salts", "inner")
    left = left.select("digest", "sketch", "size", "rest", "band", "block", "n").join(roots, "digest", "left")
    pairs = (
        left.withColumn("chunks", F.ceil(F.col("n") / F.lit(chunk // 2)).cast("int"))
        .withColumn("own", F.pmod(F.xxhash64(F.col("digest"), F.lit(7)), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "band", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            F.struct("digest", own, "sketch", "size", "rest").alias("member"),
        )
    )
    groups = pairs.groupBy("band", "block", "low", "high").agg(F.collect_list("member").alias("members"))
    chosen = _spanning if spanning else _crossing
    part = similarity / (1 + similarity)  # of both sizes, that similar sets have in common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for members in batch.column("members"):
                found = members.values
                digests = found.field("digest")
                sketches = np.ascontiguousarray(_matrix(found.field("sketch")).T)
                root = found.field("root").dictionary_encode().indices.to_numpy()
                needed, rest = found.field("size").to_numpy() * part - 1e-6, found.field("rest").to_numpy()
                for a, b in chosen(sketches, root, agreeing, (needed, rest)):
                    yield pa.RecordBatch.from_arrays([digests.take(pa.array(a)), digests.take(pa.array(b))], ["a", "b"])

    found = groups.where("size(members) > 1").select("members").mapInArrow(run, "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _by_rare_shingles(
    members: DataFrame, roots: DataFrame, pairs: DataFrame, classes: DataFrame, docs: DataFrame, text: str,
    shingle: int, similarity: float,
) -> DataFrame:
    """The sets of ``members`` in components that ``pairs`` leave apart, a row for each of their rarest shingles as ``block``.

    Shingles are in order of the number of these sets that have them.  Sets that are similar enough share
    at least ``similarity`` of the shingles of each, so the first shared one is not among the last such part
    but one of either set.  ``rest`` counts the shingles of a set from there on: no more can be shared.
    """
    spark = members.sparkSession
    own = F.coalesce("root", "digest").alias("root")
    roots = roots.withColumnRenamed("node", "digest")
    ends = pairs.withColumn("pair", F.monotonically_increasing_id()).select("pair", F.explode(F.array("a", "b")).alias("digest"))
    apart = ends.join(roots, "digest", "left").groupBy("pair").agg(F.collect_set(own).alias("roots")).where("size(roots) > 1")
    touched = apart.select(F.explode("roots").alias("root")).distinct().withColumn("salts", F.lit((1 << SALTS) - 1))
    left = members.select("digest").distinct().join(roots, "digest", "left").select("digest", own)
    left = left.withColumn("salt", salt_of(F.col("digest")))
    wanted = join_back(left, touched, "root", "salt", "salts", "inner").select("digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                found = np.frombuffer(batch.column("shingles")[n].as_py(), dtype=np.int64)
                whole = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays([batch.column("digest").slice(n, 1), whole], ["digest", "shingles"])

    path = new_path(spark, "overlap-members")
    with staging_scope(spark):
        wanted = stage(classes.select("text_hash", "digest").join(wanted, "digest"), "overlap-wanted")
        sets = _sets_of(wanted, docs, text, shingle).mapInArrow(run, "digest binary, shingles array<long>")
        each = sets.select("digest", F.size("shingles").alias("size"), F.explode("shingles").alias("block"))
        each = each.withColumn("salt", salt_of(F.col("digest")))

        def shared(rows: DataFrame) -> DataFrame:
            counts = rows.groupBy("block").agg(F.count("*").alias("n"), salt_mask(F.col("salt")).alias("salts"))
            return join_back(rows, counts.where("n > 1"), "block", "salt", "salts", "inner")

        # Shingles that no other set has come first.
        ranked = shared(each).groupBy("digest", "size", "salt").agg(
            F.sort_array(F.collect_list(F.struct("n", "block"))).alias("shared")
        )
        ranked = ranked.withColumn("lone", F.col("size") - F.size("shared"))
        placed = ranked.select("digest", "size", "salt", "lone", F.posexplode("shared").alias("place", "key"))
        placed = placed.withColumn("rest", F.col("size") - F.col("lone") - F.col("place"))
        rare = placed.where(F.col("rest") >= F.ceil(F.col("size") * similarity - 1e-9))
        rare = shared(stage(rare.select("digest", "size", "rest", "salt", F.col("key.block").alias("block")), "overlap-rare"))
        rows = rare.join(classes.select("digest", "sketch"), "digest").withColumn("band", F.lit(-1))
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _agreement(sketches: np.ndarray, i: int, sizes: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """How many minima every member (a column) has in common with member ``i``; none where ``sizes`` forbid.

    ``sizes``: what each member adds to the number of shingles to be shared, and how many it has left to share.
    """
    agreement = (sketches == sketches[:, i : i + 1]).sum(axis=0, dtype=np.uint8)
    if sizes:
        needed, rest = sizes
        agreement[np.minimum(rest, rest[i]) < needed + needed[i]] = 0
    return agreement


def _crossing(
    sketches: np.ndarray, root: np.ndarray, agreeing: int, sizes: tuple[np.ndarray, np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of members of different components that agree enough."""
    for i in range(len(root) - 1):
        alike = (root != root[i]) & (_agreement(sketches, i, sizes) >= agreeing)
        others = i + 1 + np.flatnonzero(alike[i + 1 :])
        if len(others):
            yield np.full(len(others), i), others


def _spanning(
    sketches: np.ndarray, root: np.ndarray, agreeing: int, sizes: tuple[np.ndarray, np.ndarray] | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that agree enough, the most alike first, until no component can be connected to another."""
    outside = np.ones(len(root), bool)
    best = np.zeros(len(root), np.int64)  # agreement with the nearest member inside
    near = np.zeros(len(root), np.int64)
    pairs = []
    while outside.any():
        at = int(np.where(outside, best, -1).argmax())
        if best[at] >= agreeing:
            pairs.append((near[at], at))
        component = np.flatnonzero(root == root[at])
        outside[component] = False
        for i in component:
            agreement = _agreement(sketches, i, sizes)
            closer = agreement > best
            best[closer], near[closer] = agreement[closer], i
    if pairs:
        a, b = np.array(pairs).T
        yield a, b


def _verified(links: DataFrame, classes: DataFrame, docs: DataFrame, text: str, shingle: int, similarity: float) -> DataFrame:
    """The ``links`` whose two sets of shingles are similar enough; the sets are deleted once they are compared."""
    spark = links.sparkSession
    ends = links.select(F.col("a").alias("digest")).union(links.select("b")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("of_a"), batch.column("of_b"))
            good = [similar(*(np.frombuffer(x.as_py(), dtype=np.uint64) for x in pair), similarity) for pair in pairs]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    path = new_path(spark, "overlap-links")
    with staging_scope(spark):
        wanted = stage(classes.select("text_hash", "digest").join(ends, "digest"), "overlap-wanted")
        sets = _sets_of(wanted, docs, text, shingle)

        def fetched(pairs: DataFrame, own: str, other: str) -> DataFrame:
            salted = pairs.withColumn("salt", salt_of(F.col(other)))
            asked = links.groupBy(own).agg(salt_mask(salt_of(F.col(other))).alias("salts"))
            answers = asked.join(sets.select(F.col("digest").alias(own), F.col("shingles").alias(f"of_{own}")), own)
            return join_back(salted, answers, own, "salt", "salts", "inner").drop("salt")

        both = fetched(fetched(links, "a", "b"), "b", "a").select("a", "b", "of_a", "of_b")
        both.mapInArrow(run, "a binary, b binary").write.parquet(path)
    return spark.read.schema("a binary, b binary").parquet(path)


def _roots(links: DataFrame) -> DataFrame:
    return component_roots(links.select(F.col("a").alias("u"), F.col("b").alias("v")))


def similar_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8, chunk: int = CHUNK
) -> DataFrame:
    """For every row: ``key``, ``fingerprint`` (long) and ``component`` (the smallest key reachable).

    Rows are linked when they share at least ``similarity`` of their distinct shingles of
    ``shingle`` words (as in ``simhash.fingerprint``); components are the connected rows.  Texts
    without words are linked with each other.  Null keys are passed over when the smallest key
    is taken; a component of null keys has null.  Repeated rows are kept each.  An empty table
    gives an empty result.  ``similarity`` is meant to be 0.8 or more; below, bands miss pairs.
    """
    described = _described(docs, key, text, shingle).withColumn("salt", salt_of(F.col("key")))
    rows = stage(described, "overlap-rows")
    classes = stage(
        rows.groupBy("digest").agg(
            F.min("key").alias("first"), F.min("text_hash").alias("text_hash"), salt_mask(F.col("salt")).alias("salts"),
            F.min("fingerprint").alias("fingerprint"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
        ),
        "overlap-classes",
    )
    agreeing = least_agreeing(similarity)
    members = stage(_members(classes), "overlap-members")
    proposed = _close_prints(classes, chunk).unionByName(_with_least(members, agreeing)).distinct()
    proposed = stage(proposed, "overlap-pairs")
    links = _verified(proposed, classes, docs, text, shingle, similarity)
    roots = _roots(links)
    while True:
        # Few pairs connect most of a large group.
        pairs = stage(_apart(members, roots, agreeing, chunk, True, similarity), "overlap-pairs")
        asked = pairs.count()
        if not asked:
            break
        found = _verified(pairs, classes, docs, text, shingle, similarity)
        links, held = links.unionByName(found), found.count()
        if held:
            roots = _roots(links)
        if 2 * held < asked:
            # By now the most alike members of large parts were compared; what is left apart is compared in full.
            large = members.where(F.col("n") > FEW)
            rare = _by_rare_shingles(large, roots, pairs, classes, docs, text, shingle, similarity)
            keys = members.where(F.col("n") <= FEW).select(*rare.columns).unionByName(rare)
            pairs = stage(_apart(keys, roots, agreeing, chunk, False, similarity), "overlap-pairs")
            links = links.unionByName(_verified(pairs, classes, docs, text, shingle, similarity))
            roots = _roots(links)
            break
    placed = classes.select("digest", "first", "salts").join(roots.withColumnRenamed("node", "digest"), "digest", "left")
    # Most sets are components of their own and take no part in the join by root.
    alone = placed.where("root IS NULL").select("digest", "salts", F.col("first").alias("component"))
    linked = placed.where("root IS NOT NULL")
    firsts = linked.groupBy("root").agg(F.min("first").alias("component"), salt_mask(salt_of(F.col("digest"))).alias("spread"))
    linked = join_back(linked.withColumn("salt", salt_of(F.col("digest"))), firsts, "root", "salt", "spread")
    answers = alone.unionByName(linked.select("digest", "salts", "component"))
    found = rows.select("key", "fingerprint", "digest", "salt")
    return join_back(found, answers, "digest", "salt", "salts").select("key", "fingerprint", "component")
