"""Near duplicates by SimHash and pigeonhole blocks.

A fingerprint is cut into ``blocks``.  Two fingerprints that differ in at most ``radius`` bits
agree in at least ``blocks - radius`` whole blocks, so they share the key made of those: every
fingerprint gets one key for each choice of that many blocks, and meets all its partners under
some key.  Members of a key are then compared by Hamming distance.

Work is done on distinct fingerprints.  A key with many members is cut into chunks, and every
pair of chunks is its own group, so no task sees more than two chunks and no pair of members is
missed.  Within a group a search from member to member yields a spanning forest of the links,
which has fewer rows than the group has members.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.llm.components import component_roots
from drayage.llm.exact_dedup import unused_name
from drayage.llm.salted import join_back, salt_mask, salt_of
from drayage.llm.words import LOWER, slices
from drayage.scratch import stage

BITS = 64
CHUNK = 2048  # members of one key that are compared in one group are at most twice as many
_SLICE_BYTES = 8 << 20
_BIT_TABLE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: bytes | None, shingle: int = 5) -> int:
    """The SimHash of one text as a signed whole number; without words it is zero.

    A-Z are lower-cased and words end at ASCII white space.  Shingles are ``shingle`` words
    joined by a blank, repeats included; fewer words are one shingle.  Each is hashed by XXH64
    with seed 42, and a bit is set where more than half of the hashes have it.
    """
    return majority(shingle_hashes(text, shingle))


def shingle_hashes(text: bytes | None, shingle: int) -> list[int]:
    """The hash of each shingle of a text, repeats included; none without words."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return []
    joined = b" ".join(words)
    ends = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts = [0, *(ends + 1).tolist()]
    ends = [*ends.tolist(), len(joined)]
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], 42) for a, b in zip(starts[:n], ends[-n:])]


def majority(hashes: list[int]) -> int:
    """Bits that more than half of the hashes have, counted byte by byte; zero without hashes."""
    octets = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    counts = np.bincount(octets.ravel(), minlength=2048).reshape(8, 256)
    ones = counts @ _BIT_TABLE
    return int(np.packbits(2 * ones > len(hashes)).view(">i8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5) -> DataFrame:
    """``key`` and ``fingerprint`` (long) of every row, from its whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                texts = part.column("text").cast(pa.binary()).to_pylist()
                found = pa.array([fingerprint(t, shingle) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("key"), found], ["key", "fingerprint"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, fingerprint long")


def block_masks(radius: int, blocks: int) -> list[int]:
    """One bit mask for each choice of ``blocks - radius`` blocks."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError(f"need 0 <= radius < blocks <= {BITS}, not {radius} and {blocks}")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def close_links(prints: DataFrame, radius: int, blocks: int, chunk: int = CHUNK) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints as far as ``radius`` bits reach.

    ``prints`` has one row for each ``fingerprint``.  Every link is a true one; two fingerprints
    within the radius are linked directly or over others.
    """
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in block_masks(radius, blocks)]
    masks = F.array(*[F.lit(m).cast("long") for m in signed])
    keyed = prints.select("fingerprint", F.posexplode(masks).alias("choice", "mask")).select(
        "fingerprint", "choice", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("block")
    )
    keyed = keyed.withColumn("salt", salt_of(F.col("fingerprint")))
    shared = (
        keyed.groupBy("choice", "block")
        .agg(F.count("*").alias("n"), salt_mask(F.col("salt")).alias("salts"))
        .where("n > 1")
    )
    members = join_back(keyed, shared, ["choice", "block"], "salt", "salts", "inner").drop("salt")
    chunks = F.ceil(F.col("n") / F.lit(chunk // 2)).cast("int")
    pairs = (
        members.withColumn("chunks", chunks)
        .withColumn("own", F.pmod(F.xxhash64(F.col("fingerprint"), F.lit(7)), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "choice", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            "fingerprint",
        )
    )
    groups = pairs.groupBy("choice", "block", "low", "high").agg(F.collect_list("fingerprint").alias("members"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            # Without sign, since bits of a negative number are counted in its absolute value.
            flat = lists.flatten().to_numpy().view(np.uint64)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy())
            starts = np.concatenate([[0], ends[:-1]])
            # Most groups are pairs; those are compared all at once.
            two = starts[ends - starts == 2]
            near = np.bitwise_count(flat[two] ^ flat[two + 1]) <= radius
            found = [np.stack([flat[two], flat[two + 1]], axis=1)[near]]
            for a, b in zip(starts.tolist(), ends.tolist()):
                if b - a > 2:
                    found.append(_spanning_links(flat[a:b], radius))
            links = np.concatenate(found).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    return groups.where("size(members) > 1").select("members").mapInArrow(run, "a long, b long")


def _spanning_links(members: np.ndarray, radius: int) -> np.ndarray:
    """Links that connect the members as all links within ``radius`` would."""
    left = np.sort(members)
    links = []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(left ^ at) <= radius
            if near.any():
                reached, left = left[near], left[~near]
                links.append(np.stack([np.full_like(reached, at), reached], axis=1))
                frontier.extend(reached)
    return np.concatenate(links) if links else np.empty((0, 2), dtype=np.uint64)


def near_duplicate_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    radius: int | None = None,
    blocks: int = 9,
    similarity: float = 0.8,
) -> DataFrame:
    """For every row: ``key``, ``fingerprint`` (long) and ``component`` (the smallest key reachable).

    Rows are linked when their fingerprints differ in at most ``radius`` bits or, without a
    radius, when they share at least ``similarity`` of their shingles (``overlap``); components
    are the connected rows.  Null and empty texts have fingerprint zero and are linked like others.
    Null keys are passed over when the smallest key is taken; a component of null keys has null.
    Repeated rows are kept each.  An empty table gives an empty result.  Other columns are not
    read.  The wider the radius, the more blocks it needs for keys that tell texts apart.
    """
    if radius is None:
        from drayage.llm.overlap import similar_groups

        return similar_groups(docs, key, text, shingle, similarity)
    rows = stage(fingerprints(docs, key, text, shingle).withColumn("salt", salt_of(F.col("key"))), "fingerprints")
    classes = stage(
        rows.groupBy("fingerprint").agg(F.min("key").alias("first"), salt_mask(F.col("salt")).alias("salts")),
        "fingerprint-classes",
    )
    links = stage(close_links(classes.select("fingerprint"), radius, blocks).distinct(), "close-links")
    roots = component_roots(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    # Only linked fingerprints take part below; all others are components of their own.
    linked = classes.join(roots.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left")
    firsts = linked.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("component"))
    # Nearly all have no root; they go past the join, where they would share a partition.
    lone = linked.where("root IS NULL").select("fingerprint", "salts", F.col("first").alias("component"))
    answers = linked.where("root IS NOT NULL").join(firsts, "root").select("fingerprint", "salts", "component")
    answers = answers.unionByName(lone)
    return join_back(rows, answers, "fingerprint", "salt", "salts").select("key", "fingerprint", "component")


def keep_one_of_each(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 5,
    radius: int | None = None,
    blocks: int = 9,
    similarity: float = 0.8,
) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, the one with the smallest key.

    Rows without words are one component.  Rows that agree in the smallest key are told apart
    by the smaller digest of the text, and equal rows are kept once.  Where all keys of a
    component are null, so does the smallest digest stay.
    """
    digest, copies = unused_name(docs, "_digest"), unused_name(docs, "_copies")
    content = F.col(f"`{text}`").cast("string")
    rows = docs.withColumn(digest, F.sha2(F.coalesce(content, F.lit("")), 256))
    # From here a row is known by its key and digest; null keys are larger than all others.
    name = F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("key"), F.col(digest).alias("digest"))
    groups = near_duplicate_groups(
        rows.select(name.alias("row"), content.alias("text")), "row", "text", shingle, radius, blocks, similarity
    )
    winners = (
        groups.where("key = component")
        .groupBy("component")
        .agg(F.count("*").alias(copies))
        .select(F.col("component.key").alias("_key"), F.col("component.digest").alias("_row"), copies)
    )
    same = rows[key].eqNullSafe(winners["_key"]) & (rows[digest] == winners["_row"])
    kept = rows.join(winners, same).select(*[rows[c] for c in docs.columns], rows[digest], copies)
    # Only rows that agree in text and key are left more than once.
    repeated = kept.where(F.col(copies) > 1).dropDuplicates([digest])
    return kept.where(F.col(copies) == 1).unionByName(repeated).select(*docs.columns)
