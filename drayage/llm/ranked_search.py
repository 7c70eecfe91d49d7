"""Ranked lexical search: the best documents of each item by MaxScore with bounds of term pairs.

The index is split by documents: a row of the stored table holds the inverted lists of some
megabytes of text, so nothing is shuffled to build it and a frequent word fills no partition.
Every list has the largest impact of its term in that slice.  For the slice's longest lists, where
skipping pays, the index also holds the intersection of each two of them: the largest impact
either term has among the documents with both, and, shortest first, the documents themselves.

An item is answered slice by slice.  The terms are ordered by what they can add at most; those
that together stay below the 20th best score so far are optional: a document with none but them is
never looked at, and others are given up as soon as what is left cannot lift them.  What a
pair can add together is bounded by its intersection, and usually less than both terms alone, so
pairs that match are taken out of the sum of the single bounds.  The documents of the item's
best stored intersection are scored first, for a higher threshold from the start.  A slice whose
bounds all together stay below the threshold is passed over.

Skipping compares strictly, so equal scores are never lost.  Each task keeps one list of best
documents for each item over all its slices.  Items are taken in blocks of bounded size; each
block is one pass over the index.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from drayage.llm.words import ALNUM, slices, split_words
from drayage.scratch import delete, new_path, stage

SLICE_BYTES = 8 << 20  # text in one row of the index, unless a single text is longer
BLOCK_BYTES = 1 << 20  # of items that are answered in one pass, unless one is longer
PAIR_TERMS = 64  # the longest lists of a slice, of which pairs are stored
BUCKETS = 64  # first step of merging the tasks' best

_LISTS = "keys array<{key}>, lengths array<int>, lexicon binary, list_ends binary, documents binary, counts binary"
_PAIRS = "maxima binary, hot binary, joint binary, pair_ends binary, pair_documents binary"


class Totals(NamedTuple):
    """Documents with any term, and all their terms with repeats."""

    documents: int
    terms: int


def _narrow(numbers: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs; the first byte says how many."""
    width = next(w for w in (1, 2, 4) if numbers.max(initial=0) < 1 << (8 * w))
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def _wide(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, dtype=f"<u{blob[0]}", offset=1)


def _lists_of(part: pa.RecordBatch) -> pa.RecordBatch:
    """The inverted lists of some texts."""
    words, rows = split_words(part.column("text"), ALNUM)
    lengths = np.diff(rows)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.uint64)
    documents = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)
    both, counts = np.unique((codes << np.uint64(32)) | documents, return_counts=True)
    ends = np.cumsum(np.bincount((both >> np.uint64(32)).astype(np.int64), minlength=len(coded.dictionary)))
    lexicon = b"\n".join(coded.dictionary.cast(pa.large_binary()).to_pylist())
    blobs = [lexicon, ends.astype("<i4").tobytes(), _narrow(both & np.uint64(0xFFFFFFFF)), _narrow(counts)]
    whole = pa.array([0, part.num_rows], pa.int32())
    lists = [part.column("key"), pa.array(lengths.astype(np.int32))]
    return pa.RecordBatch.from_arrays(
        [*[pa.ListArray.from_arrays(whole, x) for x in lists], *[pa.array([b], pa.binary()) for b in blobs]],
        [c.split()[0] for c in _LISTS.split(", ")],
    )


def spread(lengths: np.ndarray, totals: Totals) -> np.ndarray:
    """``m`` of each document: 75, and 25 times its length over the mean length."""
    if 25 * int(lengths.max(initial=0)) * totals.documents < 1 << 63:
        return 75 + 25 * lengths.astype(np.int64) * totals.documents // max(1, totals.terms)
    exact = [75 + 25 * n * totals.documents // totals.terms for n in lengths.tolist()]
    return np.array(exact, dtype=np.int64)


def impacts_of(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    counts = counts.astype(np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 12 * m)


def _pairs_of(row: dict, totals: Totals) -> list[bytes]:
    """Largest impact of every term, and the intersections of the slice's longest lists."""
    m = spread(np.array(row["lengths"], dtype=np.int64), totals)
    documents, ends = _wide(row["documents"]).astype(np.int64), np.frombuffer(row["list_ends"], "<i4")
    impacts = impacts_of(_wide(row["counts"]), m[documents])
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    maxima = np.maximum.reduceat(impacts, starts) if len(ends) else impacts
    sizes = ends - starts
    hot = np.argsort(-sizes, kind="stable")[:PAIR_TERMS]
    hot = hot[sizes[hot] > 1]
    held = np.zeros((len(hot), len(m)), dtype=np.int32)
    for h, term in enumerate(hot):
        at = slice(starts[term], ends[term])
        held[h, documents[at]] = impacts[at]
    joint = np.zeros((len(hot), len(hot)), dtype=np.int64)
    pairs = []
    for h in range(len(hot)):
        own = held[:, documents[starts[hot[h]] : ends[hot[h]]]]
        # Column by column, the documents of this term; rows, what all hot terms have there.
        joint[h] = np.where(own > 0, own[h], 0).max(axis=1)
        common = (own > 0).sum(axis=1)
        pairs += [(int(common[other]), h, other) for other in range(h + 1, len(hot)) if common[other]]
    # The documents of a pair are stored while all of them are fewer than half of the postings.
    room, lists = len(documents) // 2, {}
    for size, h, other in sorted(pairs):
        room -= size
        if room < 0:
            break
        lists[h, other] = np.flatnonzero((held[h] > 0) & (held[other] > 0))
    every = [lists.get((h, o), np.empty(0, np.int64)) for h in range(len(hot)) for o in range(h + 1, len(hot))]
    flat = np.concatenate([np.empty(0, np.int64), *every])
    pair_ends = np.cumsum([len(p) for p in every]).astype("<i4")
    return [_narrow(maxima), hot.astype("<i4").tobytes(), _narrow(joint.ravel()), pair_ends.tobytes(), _narrow(flat)]


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, Totals]:
    """The stored index of all documents, and the totals its impacts were made with.

    Terms are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII.
    The lists are written first; impacts, which need the totals, and pairs are added by a second pass.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield _lists_of(part)

    schema = _LISTS.format(key=rows.schema["key"].dataType.simpleString())
    path = new_path(spark, "lists")
    rows.mapInArrow(lists, schema).write.parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    length = F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)
    used = F.size(F.filter("lengths", lambda x: x > 0)).cast("bigint")
    sums = stored.agg(F.coalesce(F.sum(used), F.lit(0)), F.coalesce(F.sum(length), F.lit(0))).first()
    totals = Totals(*sums)

    def with_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1)
                names = ["lengths", "list_ends", "documents", "counts"]
                blobs = _pairs_of(row.select(names).to_pylist()[0], totals)
                cells = [*row.columns, *[pa.array([b], pa.binary()) for b in blobs]]
                yield pa.RecordBatch.from_arrays(
                    cells, [*row.schema.names, *[c.split()[0] for c in _PAIRS.split(", ")]]
                )

    index = stage(stored.mapInArrow(with_pairs, f"{schema}, {_PAIRS}"), "ranked-index")
    delete(spark, path)
    return index, totals


def _placed(key) -> tuple:
    """Orders keys, null ones last."""
    return (key is None, 0 if key is None else key)


class Slice:
    """One row of the index, with the lists of a block's terms read when they are first needed."""

    def __init__(self, row: dict, terms: pa.Array, totals: Totals):
        self.keys, self.totals = row["keys"], totals
        self.m = spread(np.array(row["lengths"], dtype=np.int64), totals)
        self.ends = np.frombuffer(row["list_ends"], "<i4")
        self.documents, self.counts = _wide(row["documents"]), _wide(row["counts"])
        self.maxima = _wide(row["maxima"])
        lexicon = pa.array(row["lexicon"].split(b"\n") if len(self.ends) else [], pa.large_binary())
        self.place = pc.fill_null(pc.index_in(terms, lexicon), -1).to_numpy()
        hot = np.frombuffer(row["hot"], "<i4")
        self.hot = {int(t): h for h, t in enumerate(hot)}
        self.joint = _wide(row["joint"]).reshape(len(hot), len(hot))
        self.pair_ends, self.pair_documents = np.frombuffer(row["pair_ends"], "<i4"), _wide(row["pair_documents"])
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._rank: np.ndarray | None = None

    def list_of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """The documents with a term of the lexicon, ascending, and their impacts."""
        if term not in self._lists:
            at = slice(self.ends[term - 1] if term else 0, self.ends[term])
            documents = self.documents[at].astype(np.int64)
            self._lists[term] = documents, impacts_of(self.counts[at], self.m[documents])
        return self._lists[term]

    def pair_list(self, h: int, other: int) -> np.ndarray:
        """The stored documents of two hot terms; empty where they are not stored."""
        h, other, n = min(h, other), max(h, other), len(self.hot)
        number = h * n - h * (h + 1) // 2 + other - h - 1
        return self.pair_documents[self.pair_ends[number - 1] if number else 0 : self.pair_ends[number]].astype(np.int64)

    @property
    def rank(self) -> np.ndarray:
        """The place of each document when they are ordered by key, null keys last."""
        if self._rank is None:
            order = sorted(range(len(self.keys)), key=lambda d: _placed(self.keys[d]))
            self._rank = np.empty(len(order), dtype=np.int64)
            self._rank[order] = np.arange(len(order))
        return self._rank


def bounds(part: Slice, terms: list[int], weights: list[int]) -> tuple[list[int], list[int], tuple | None]:
    """Terms by what they can add, what the first ones can add together, and the best stored pair.

    ``terms`` are numbers of the slice's lexicon.  The second list has one more entry than there are
    terms: entry i bounds the score of any document that holds none but the first i.
    """
    single = [w * int(part.maxima[t]) for t, w in zip(terms, weights)]
    order = sorted(range(len(terms)), key=lambda i: single[i])
    hot = [(i, part.hot[terms[i]]) for i in order if terms[i] in part.hot]
    savings, best = [], None
    for x, (i, h) in enumerate(hot):
        for j, other in hot[x + 1 :]:
            # Both: at most their joint impacts.  One alone: at most its own.
            both = weights[i] * int(part.joint[h, other]) + weights[j] * int(part.joint[other, h])
            saved = single[i] + single[j] - max(both, single[i], single[j])
            if saved > 0:
                savings.append((saved, i, j))
            if both and (best is None or both > best[0]) and len(part.pair_list(h, other)):
                best = both, h, other
    partner: dict[int, tuple[int, int]] = {}
    for saved, i, j in sorted(savings, reverse=True):
        if i not in partner and j not in partner:
            partner[i], partner[j] = (j, saved), (i, saved)
    sums, seen = [0], set()
    for i in order:
        other, saved = partner.get(i, (None, 0))
        sums.append(sums[-1] + single[i] - (saved if other in seen else 0))
        seen.add(i)
    return order, sums, best


def _added(part: Slice, term: int, weight: int, documents: np.ndarray, scores: np.ndarray) -> None:
    """Add a term's share to the scores of ``documents``."""
    where, impacts = part.list_of(term)
    at = np.searchsorted(where, documents)
    at[at == len(where)] = 0
    there = where[at] == documents
    scores[there] += weight * impacts[at[there]]


def best_of(part: Slice, query: dict[int, int], top: list[tuple], k: int) -> list[tuple]:
    """``top`` (score negated, key) with the documents of one more slice.

    ``query`` gives the weight of each of the block's terms, with the item's repeats.
    """
    held = [(int(part.place[t]), w) for t, w in query.items() if w > 0 and part.place[t] >= 0]
    if not held:
        return top
    terms, weights = map(list, zip(*held))
    order, sums, pair = bounds(part, terms, weights)
    floor = -top[-1][0] if len(top) == k else 1
    if sums[-1] < floor:
        return top
    if pair:
        documents = part.pair_list(*pair[1:])
        scores = np.zeros(len(documents), dtype=np.int64)
        for t, w in zip(terms, weights):
            _added(part, t, w, documents, scores)
        known = np.sort(np.concatenate([scores, np.array([-s for s, *_ in top], dtype=np.int64)]))
        if len(known) >= k:
            floor = max(floor, int(known[-k]))
    optional = max(i for i in range(len(sums)) if sums[i] < floor)
    total = np.zeros(len(part.m), dtype=np.int64)
    for i in order[optional:]:
        where, impacts = part.list_of(terms[i])
        total[where] += weights[i] * impacts
    documents = np.flatnonzero(total >= max(1, floor - sums[optional]))
    scores = total[documents]
    for left in range(optional - 1, -1, -1):
        i = order[left]
        _added(part, terms[i], weights[i], documents, scores)
        stays = scores + sums[left] >= floor
        documents, scores = documents[stays], scores[stays]
    if not len(documents):
        return top
    if len(documents) > k:
        stays = scores >= np.partition(scores, len(scores) - k)[-k]
        documents, scores = documents[stays], scores[stays]
    first = np.lexsort((part.rank[documents], -scores))[:k]
    new = [(-int(scores[n]), part.keys[documents[n]]) for n in first]
    return sorted([*top, *new], key=lambda x: (x[0], *_placed(x[1])))[:k]


class Block(NamedTuple):
    """Some items: their distinct terms, and each item's terms with repeats."""

    terms: pa.Array
    items: list[dict[int, int]]


def block_of(texts: list[str | None]) -> Block:
    words, rows = split_words(pa.array(texts, pa.string()), ALNUM)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy()
    items = []
    for start, end in zip(rows[:-1], rows[1:]):
        held, repeats = np.unique(codes[start:end], return_counts=True)
        items.append(dict(zip(held.tolist(), repeats.tolist())))
    return Block(coded.dictionary.cast(pa.large_binary()), items)


def weight(documents: int, holding: int) -> int:
    """Of a term that ``holding`` of all documents have."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _holding(index: DataFrame, terms: pa.Array) -> dict[int, int]:
    """How many documents have each term: counted by slice, added up by task, then by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                ends = np.frombuffer(row["list_ends"], "<i4")
                sizes = np.diff(ends, prepend=0)
                lexicon = pa.array(row["lexicon"].split(b"\n") if len(ends) else [], pa.large_binary())
                place = pc.fill_null(pc.index_in(terms, lexicon), -1).to_numpy()
                total[place >= 0] += sizes[place[place >= 0]]
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["term", "n"])

    counts = index.select("lexicon", "list_ends").mapInArrow(run, "term bigint, n bigint")
    return {t: n for t, n in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}


def _blocks(items: DataFrame, key: str, text: str) -> DataFrame:
    """Items in staged rows of bounded size, with a number each."""
    rows = items.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                whole = pa.array([0, part.num_rows], pa.int32())
                cells = [pa.ListArray.from_arrays(whole, part.column(c)) for c in ("key", "text")]
                yield pa.RecordBatch.from_arrays(cells, ["keys", "texts"])

    schema = f"keys array<{rows.schema['key'].dataType.simpleString()}>, texts array<string>"
    return stage(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "item-blocks")


def _first(rows: DataFrame, k: int, *within: str) -> DataFrame:
    order = [F.desc("score"), F.col("key").asc_nulls_last()]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*within).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def search(
    index: DataFrame,
    totals: Totals,
    items: DataFrame,
    key: str = "item_id",
    text: str = "text",
    k: int = 20,
) -> DataFrame:
    """The ``k`` best documents of every item: ``item``, ``rank`` from 1, ``key`` of the document, ``score``.

    Documents score above 0; equal scores go by ascending key, null keys last.  An item without
    terms, or with none that any document has, gets no rows.  Repeated documents are ranked each, and
    repeated items answered each.  Without documents or items the result is empty.
    """
    spark = index.sparkSession
    blocks = _blocks(items, key, text)
    document, item = index.schema["keys"].dataType.elementType, items.schema[key].dataType
    schema = f"number int, key {document.simpleString()}, score bigint"
    found = []
    # The driver holds one block at a time; its terms and weights go with the tasks of one pass.
    for (number,) in blocks.select("block").toLocalIterator():
        block = block_of(blocks.where(F.col("block") == number).first()["texts"])
        holding = _holding(index, block.terms)
        weights = {t: weight(totals.documents, n) for t, n in holding.items()}
        queries = [{t: weights[t] * n for t, n in q.items() if weights.get(t)} for q in block.items]

        def run(batches, block=block, queries=queries) -> Iterator[pa.RecordBatch]:
            top: list[list[tuple]] = [[] for _ in queries]
            kind = None
            for batch in batches:
                kind = batch.schema.field("keys").type.value_type
                for n in range(batch.num_rows):
                    part = Slice(batch.slice(n, 1).to_pylist()[0], block.terms, totals)
                    for at, query in enumerate(queries):
                        top[at] = best_of(part, query, top[at], k)
            if kind is not None:
                rows = [(at, *one) for at, best in enumerate(top) for one in best]
                cells = [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[2] for r in rows], kind),
                    pa.array([-r[1] for r in rows], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(cells, ["number", "key", "score"])

        tops = index.mapInArrow(run, schema).withColumn("bucket", F.pmod(F.spark_partition_id(), F.lit(BUCKETS)))
        best = _first(_first(tops, k, "number", "bucket").drop("rank"), k, "number")
        path = new_path(spark, "best")
        best.select("number", "rank", "key", "score").withColumn("block", F.lit(number)).write.parquet(path)
        found.append(path)
    best = f"number int, rank int, key {document.simpleString()}, score bigint, block bigint"
    rows = spark.read.schema(best).parquet(*found) if found else spark.createDataFrame([], best)
    named = blocks.select("block", F.posexplode("keys").alias("number", "item"))
    return rows.join(named, ["block", "number"]).select("item", "rank", "key", "score")
