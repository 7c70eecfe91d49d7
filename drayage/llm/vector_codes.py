"""Vector codes: every part of a vector becomes the number of its nearest codebook entry.

The codebooks are found by k-means over whole numbers, with the adaptive distance bounds of
Drake and Hamerly.  For each part of each vector the table keeps, between rounds, the entry it
belongs to with an upper bound of its distance, the b closest other entries in order with a lower
bound each, and one outer bound for all entries beyond those.  When the entries have moved, the
bounds move by as much; a part whose upper bound is below its first lower bound stays where it
is without a distance being computed.  Others are measured against as many of the closest
entries as their bounds leave open, and against all only where even the outer bound does not
help.  All bounds are whole numbers rounded to the safe side and every comparison of distances is
one of exact squared integers, so the result is that of comparing everything with everything.

b belongs to a block of vectors and one part: it shrinks to the number of entries that were
looked at, and doubles where a quarter of the block had to be measured against all entries.

Vectors lie in blocks of bounded size, one row of a staged table each, which never move between
partitions.  A round is one pass over the blocks, which writes them anew with their bounds and
the sums of each entry's parts.  Only the sums and the codebooks (entries x dimension whole
numbers, whatever the number of vectors) reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drayage.llm.salted import SALTS, join_back, salt_mask
from drayage.scratch import delete, new_path, stage

BLOCK_ROWS, BLOCK_BYTES = 8192, 4 << 20
LARGEST = 1024.0  # of a component; whole numbers stay below 2**22, squared distances below 2**62
MOST_DIMENSIONS = 1 << 14  # of one part
UNKNOWN = np.iinfo(np.int32).max

_BLOCK = (
    "keys array<{key}>, labels array<{label}>, points binary, width int, most array<int>, nearest binary, "
    "upper binary, ranked array<binary>, lower array<binary>, outer binary, sums array<bigint>"
)
_CODES = "key {key}, label {label}, code binary, error bigint, salt int"


class Bounds(NamedTuple):
    """What is known of one part of the vectors of a block."""

    nearest: np.ndarray  # (n,) entry
    upper: np.ndarray  # (n,) at least the distance to it
    ranked: np.ndarray  # (n, b) the closest other entries
    lower: np.ndarray  # (n, b) ascending; at most the distance to this and every later entry
    outer: np.ndarray  # (n,) at most the distance to every entry not listed


def roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Square roots of whole numbers, rounded down and up."""
    down = np.floor(np.sqrt(squares.astype(np.float64))).astype(np.int64)
    down -= down * down > squares
    down += (down + 1) * (down + 1) <= squares
    return down, down + (down * down < squares)


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``x`` to all entries."""
    return np.stack([np.square(x - e).sum(axis=1) for e in entries], axis=1)


def _by_distance(squares: np.ndarray, tie: np.ndarray) -> np.ndarray:
    return np.lexsort((tie, squares), axis=1)


def measured(x: np.ndarray, entries: np.ndarray, most: int) -> Bounds:
    """Bounds from the distances to all entries; ties go to the lower number."""
    squares = _squares(x, entries)
    order = _by_distance(squares, np.broadcast_to(np.arange(len(entries)), squares.shape))
    down, up = roots(np.take_along_axis(squares, order, axis=1))
    b = min(most, len(entries) - 1)
    outer = down[:, b + 1] if b + 1 < len(entries) else np.full(len(x), UNKNOWN)
    return Bounds(order[:, 0], up[:, 0], order[:, 1 : b + 1], down[:, 1 : b + 1], outer)


def moved(known: Bounds, drift: np.ndarray, most: int) -> Bounds:
    """The bounds after every entry has moved by at most ``drift``, with ``most`` entries listed."""
    limits = np.column_stack([known.lower - drift[known.ranked], known.outer - drift.max()])
    limits = np.minimum.accumulate(limits[:, ::-1], axis=1)[:, ::-1]
    b = min(most, known.ranked.shape[1])
    return Bounds(
        known.nearest, known.upper + drift[known.nearest], known.ranked[:, :b], limits[:, :b], limits[:, b]
    )


def assign(x: np.ndarray, entries: np.ndarray, known: Bounds, most: int) -> tuple[Bounds, int]:
    """Exact nearest entries from valid bounds, and how many listed entries the next round should keep."""
    nearest, upper, ranked, lower, outer = (a.copy() for a in known)
    limits = np.column_stack([lower, outer])
    # The limits ascend, so their number below the upper bound says which entries are left open.
    open_ = (limits <= upper[:, None]).sum(axis=1)
    rows = np.flatnonzero(open_)
    own = np.square(x[rows] - entries[nearest[rows]]).sum(axis=1)
    upper[rows] = roots(own)[1]
    open_[rows] = (limits[rows] <= upper[rows, None]).sum(axis=1)
    b = ranked.shape[1]
    wanted = int(open_[open_ <= b].max(initial=0))

    some = open_[rows] > 0
    rows, own = rows[some], own[some]
    beyond = rows[open_[rows] > b]
    if 4 * len(beyond) > len(x) and b + 1 < len(entries):
        wider = min(len(entries) - 1, 2 * max(b, 1))
        return measured(x, entries, wider), wider
    few = open_[rows] <= b
    rows, own = rows[few], own[few]
    if len(rows):
        # Beside its own entry, each row is measured against the listed ones that are open.
        there = np.column_stack([nearest[rows], ranked[rows]])
        squares = np.full(there.shape, np.iinfo(np.int64).max)
        squares[:, 0] = own
        for j in range(int(open_[rows].max())):
            at = np.flatnonzero(open_[rows] > j)
            squares[at, j + 1] = np.square(x[rows[at]] - entries[ranked[rows[at], j]]).sum(axis=1)
        known_ = np.arange(b + 1) <= open_[rows, None]
        order = _by_distance(squares, np.where(known_, there, len(entries) + np.arange(b + 1)))
        there = np.take_along_axis(there, order, axis=1)
        down, up = roots(np.where(known_, np.take_along_axis(squares, order, axis=1), 0))
        nearest[rows], upper[rows], ranked[rows] = there[:, 0], up[:, 0], there[:, 1:]
        new = np.column_stack([np.where(known_[:, 1:], down[:, 1:], lower[rows]), outer[rows]])
        lower[rows] = np.minimum.accumulate(new[:, ::-1], axis=1)[:, ::-1][:, :b]
    if len(beyond):
        nearest[beyond], upper[beyond], ranked[beyond], lower[beyond], outer[beyond] = measured(x[beyond], entries, b)
    return Bounds(nearest, upper, ranked, lower, outer), max(wanted, min(max(1, len(entries) // 8), b))


def _parts(row: dict, dimension: int, parts: int) -> np.ndarray:
    points = np.frombuffer(row["points"], dtype=f"<i{row['width']}")
    return points.reshape(-1, parts, dimension // parts)


def _held(row: dict, part: int, n: int, parts: int) -> Bounds:
    def table(name: str, kind: str) -> np.ndarray:
        return np.frombuffer(row[name], dtype=kind).reshape(parts, n)[part].astype(np.int64)

    ranked = np.frombuffer(row["ranked"][part], dtype=np.uint8).reshape(n, -1).astype(np.int64)
    lower = np.frombuffer(row["lower"][part], dtype="<i4").reshape(ranked.shape).astype(np.int64)
    return Bounds(table("nearest", "u1"), table("upper", "<i4"), ranked, lower, table("outer", "<i4"))


def _solve(row: dict, books: np.ndarray, drift: np.ndarray | None) -> Iterator[tuple[np.ndarray, Bounds, int]]:
    """Of every part in turn: its numbers, bounds, and the entries to list next time."""
    parts, entries, size = books.shape
    points = _parts(row, parts * size, parts)
    for part in range(parts):
        x = points[:, part].astype(np.int64)
        most = row["most"][part]
        if drift is None:
            yield x, measured(x, books[part], most), most
        else:
            known = moved(_held(row, part, len(points), parts), drift[part], most)
            yield x, *assign(x, books[part], known, most)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict]]:
    for batch in batches:
        for n in range(batch.num_rows):
            row = batch.slice(n, 1)
            names = [c for c in row.schema.names if c not in ("keys", "labels", "sums")]
            yield row, row.select(names).to_pylist()[0]


def _round(books: np.ndarray, drift: np.ndarray | None):
    """One pass over the blocks: new bounds, and the count and sum of each entry's parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, size = books.shape
        for batch, row in _rows(batches):
            near, most, ranked, lower, sums = [], [], [], [], []
            upper, outer = [], []
            for x, known, wanted in _solve(row, books, drift):
                near.append(known.nearest.astype(np.uint8))
                upper.append(np.minimum(known.upper, UNKNOWN).astype("<i4"))
                outer.append(np.clip(known.outer, -1, UNKNOWN).astype("<i4"))
                ranked.append(known.ranked.astype(np.uint8).tobytes())
                lower.append(np.clip(known.lower, -1, UNKNOWN).astype("<i4").tobytes())
                most.append(wanted)
                total = np.zeros((entries, size + 1), dtype=np.int64)
                np.add.at(total, known.nearest, np.column_stack([x, np.ones(len(x), dtype=np.int64)]))
                sums.append(total)
            new = {
                "most": most,
                "nearest": np.concatenate(near).tobytes(),
                "upper": np.concatenate(upper).tobytes(),
                "ranked": ranked,
                "lower": lower,
                "outer": np.concatenate(outer).tobytes(),
                "sums": np.concatenate(sums).ravel(),
            }
            cells = [
                pa.array([new[f.name]], f.type) if f.name in new else batch.column(f.name) for f in batch.schema
            ]
            yield pa.RecordBatch.from_arrays(cells, schema=batch.schema)

    return run


def _last(books: np.ndarray, drift: np.ndarray | None):
    """The closing pass: a code and its error for every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, size = books.shape
        for batch, row in _rows(batches):
            codes, error = [], 0
            for part, (x, known, _) in enumerate(_solve(row, books, drift)):
                codes.append(known.nearest.astype(np.uint8))
                error = error + np.square(x - books[part][known.nearest]).sum(axis=1)
            codes = np.ascontiguousarray(np.column_stack(codes))
            n = len(codes)
            cells = [
                batch.column("keys").flatten(),
                batch.column("labels").flatten(),
                pa.Array.from_buffers(pa.binary(parts), n, [None, pa.py_buffer(codes)]).cast(pa.binary()),
                pa.array(error, pa.int64()),
                pa.array(np.arange(n) % SALTS, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(cells, ["key", "label", "code", "error", "salt"])

    return run


def _blocks(dimension: int, scale: int, most: list[int], entries: int):
    """Vectors as blocks of whole numbers, two or four bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (2 * dimension)))
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                flat = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                numbers = np.floor(flat.astype(np.float64) * scale).astype(np.int64)
                width = 2 if np.abs(numbers).max() < 1 << 15 else 4
                whole = pa.array([0, part.num_rows], pa.int32())
                none = [[b""] * len(most)]
                cells = [
                    pa.ListArray.from_arrays(whole, part.column("key")),
                    pa.ListArray.from_arrays(whole, part.column("label")),
                    pa.array([numbers.astype(f"<i{width}").tobytes()], pa.binary()),
                    pa.array([width], pa.int32()),
                    pa.array([most], pa.list_(pa.int32())),
                    *[pa.array([b""], pa.binary())] * 2,
                    *[pa.array(none, pa.list_(pa.binary()))] * 2,
                    pa.array([b""], pa.binary()),
                    pa.array([[]], pa.list_(pa.int64())),
                ]
                names = [c.split()[0] for c in _BLOCK.split(", ")]
                yield pa.RecordBatch.from_arrays(cells, names)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        sums = batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
        total = sums if total is None else total + sums
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["sums"])


def _totals(blocks: DataFrame) -> np.ndarray:
    """Sums over all blocks: added up by each task, then place by place."""
    each = blocks.select("sums").mapInArrow(_added, "sums array<bigint>").select(F.posexplode("sums").alias("at", "n"))
    rows = each.groupBy("at").agg(F.sum("n").alias("n")).collect()
    return np.array([n for _, n in sorted(map(tuple, rows))], dtype=np.int64)


def _usable(column: str, parts: int):
    size = F.size(column)
    within = ~F.exists(column, lambda x: F.abs(x) > LARGEST)
    return (size > 0) & (size % parts == 0) & (size <= parts * MOST_DIMENSIONS) & within


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> DataFrame:
    """Codes of all vectors by codebooks of ``entries`` entries for each of ``parts`` equal parts.

    Columns: ``key``, ``label``, ``code`` (a byte for each part), ``error`` (the squared distances
    between the parts and their entries, added up), ``label_error`` (errors added up over equal
    labels, null labels together) and ``codebooks`` (SHA-256 of all entries' numbers by part,
    entry and place, joined by commas).  Components become ``floor(scale * x)``.

    A codebook starts as that part of the ``entries`` vectors with the smallest keys (null keys
    last, equal keys by their components); of fewer vectors it has fewer entries.  Rows whose
    vector is null or holds a null or a number that is not finite are dropped.  Rows whose vector
    is empty, cannot be cut into equal parts, has another length than the first usable one or a
    component beyond 1024 in size are returned without code and error and teach nothing; without
    any other row of their label, ``label_error`` is null as well.  Repeated rows are returned each.
    """
    if not 0 < entries <= 256:
        raise ValueError("an entry's number must fit one byte")
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("vector")
    )
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.where(F.col("vector").isNotNull() & finite)
    usable = rows.where(_usable("vector", parts))
    order = [F.col("key").asc_nulls_last(), F.col("vector").asc()]
    starts = usable.orderBy(*order).limit(entries).collect()
    schemas = [
        s.format(key=rows.schema["key"].dataType.simpleString(), label=rows.schema["label"].dataType.simpleString())
        for s in (_BLOCK, _CODES)
    ]
    if not starts:
        return _result(rows, spark.createDataFrame([], schemas[1]), rows, None)
    dimension = len(starts[0]["vector"])
    alike = usable.where(F.size("vector") == dimension)
    if any(len(s["vector"]) != dimension for s in starts):
        starts = alike.orderBy(*order).limit(entries).collect()
    first = np.floor(np.array([s["vector"] for s in starts], dtype=np.float64) * scale).astype(np.int64)
    books = first.reshape(len(first), parts, -1).transpose(1, 0, 2)
    k = books.shape[1]

    most = [min(k - 1, max(1, k // 4))] * parts
    blocks = stage(alike.mapInArrow(_blocks(dimension, scale, most, k), schemas[0]), "vector-blocks")
    drift, path = None, None
    for _ in range(rounds):
        after = new_path(spark, "vector-round")
        blocks.mapInArrow(_round(books, drift), schemas[0]).write.parquet(after)
        if path:
            delete(spark, path)
        path = after
        blocks = spark.read.schema(schemas[0]).parquet(path)
        totals = _totals(blocks).reshape(parts, k, -1)
        counts = totals[:, :, -1:]
        new = np.where(counts > 0, totals[:, :, :-1] // np.maximum(counts, 1), books)
        drift = roots(np.square(new - books).sum(axis=2))[1]
        books = new
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = stage(blocks.mapInArrow(_last(books, drift), schemas[1]), "vector-codes")
    if path:
        delete(spark, path)
    odd = rows.where(~(_usable("vector", parts) & (F.size("vector") == dimension)))
    return _result(rows, codes, odd, digest)


def _result(rows: DataFrame, codes: DataFrame, odd: DataFrame, digest: str | None) -> DataFrame:
    """Codes and rows without code, with the errors of their label carried back by label and salt."""
    bare = stage(odd.select(
        "key",
        "label",
        F.lit(None).cast("binary").alias("code"),
        F.lit(None).cast("bigint").alias("error"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("salt"),
    ), "vectors-without-code")
    # A null label is a value of its own here, which the join must find again.
    alike = {"_none": F.col("label").isNull(), "_label": F.coalesce(F.col("label").cast("string"), F.lit(""))}
    both = codes.unionByName(bare).withColumns(alike)
    sums = both.groupBy("_none", "_label").agg(
        F.try_sum("error").alias("label_error"), salt_mask(F.col("salt")).alias("mask")
    )
    joined = join_back(both, sums, ["_none", "_label"], "salt", "mask")
    return joined.select("key", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks"))
