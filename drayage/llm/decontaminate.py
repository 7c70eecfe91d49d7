"""Benchmark decontamination over a distributed positional inverted index.

The index is split by documents: each row of the stored table is the inverted index of some
megabytes of text, with a lexicon and one sorted list of positions for each term.  Nothing is
shuffled to build it, a frequent word fills no partition, and any set of test texts can be run
against it.  Documents lie one after the other on a single axis of positions with gaps between
them, so no phrase reaches over a border.

To find a phrase, the list of its rarest term is shifted by the term's place in the phrase and
intersected with the shifted lists of the other terms, rarest first.  With ``slop`` the terms
may each lie that far from their place (proximity instead of phrase).

Test texts are taken in blocks of bounded size; every block meets the whole index.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from drayage.llm.exact_dedup import unused_name
from drayage.llm.url_filter import likely
from drayage.llm.words import ALNUM, give_back, slices, split_words
from drayage.scratch import new_path, stage, staging_scope

GAP = 1 << 10  # between documents; a phrase and its slop must be shorter
SLICE_BYTES = 8 << 20  # text in one row of the index, unless a single text is longer
BLOCK_CHARS = 2 << 20  # of test texts that are run against the index at once, unless one is longer

_INDEX = "keys array<{key}>, lengths array<int>, lexicon binary, list_ends binary, positions binary"


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Store the positions of all words of all texts; the result is read from the shared folder.

    Columns: ``slice`` (a number), ``keys`` and ``lengths`` (the documents and their words),
    ``lexicon`` (terms, one a line), ``list_ends`` and ``positions`` (each term's sorted list).
    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond ASCII.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                yield _index_of(part)
        give_back()

    schema = _INDEX.format(key=rows.schema["key"].dataType.simpleString())
    index = rows.mapInArrow(run, schema).withColumn("slice", F.monotonically_increasing_id())
    return stage(index, "positions")


def _index_of(part: pa.RecordBatch) -> pa.RecordBatch:
    words, rows = split_words(part.column("text"), ALNUM)
    lengths = np.diff(rows)
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.uint64)
    places = np.arange(len(codes), dtype=np.uint64) + np.repeat(
        np.arange(len(lengths), dtype=np.uint64) * np.uint64(GAP), lengths
    )
    # Sorting term and place as one number orders every list.
    both = np.sort((codes << np.uint64(32)) | places)
    ends = np.cumsum(np.bincount(codes.astype(np.int64), minlength=len(coded.dictionary)))
    lexicon = b"\n".join(coded.dictionary.cast(pa.large_binary()).to_pylist())
    whole = pa.array([0, part.num_rows], pa.int32())
    lists = [part.column("key"), pa.array(lengths.astype(np.int32))]
    blobs = [lexicon, ends.astype("<i4").tobytes(), (both & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()]
    return pa.RecordBatch.from_arrays(
        [*[pa.ListArray.from_arrays(whole, x) for x in lists], *[pa.array([b], pa.binary()) for b in blobs]],
        ["keys", "lengths", "lexicon", "list_ends", "positions"],
    )


class Phrases(NamedTuple):
    """The distinct phrases of some items: term numbers, and the items each phrase is from."""

    terms: pa.Array
    phrases: list[tuple[int, ...]]
    owners: list[list[int]]
    items: list


def phrases_of(items: list, texts: list[str | None], window: int) -> Phrases:
    """All runs of ``window`` words; a text of fewer words is one phrase, one of none has none."""
    words, rows = split_words(pa.array(texts, pa.string()), ALNUM)
    coded = words.dictionary_encode()
    codes = coded.indices.to_pylist()
    found: dict[tuple[int, ...], list[int]] = {}
    for item, (start, end) in enumerate(zip(rows.tolist(), rows[1:].tolist())):
        size = min(window, end - start)
        for at in range(start, end - size + 1) if size else ():
            owners = found.setdefault(tuple(codes[at : at + size]), [])
            if not owners or owners[-1] != item:
                owners.append(item)
    return Phrases(coded.dictionary.cast(pa.large_binary()), list(found), list(found.values()), items)


def occurrences(lists: list[np.ndarray], slop: int = 0) -> tuple[np.ndarray, int]:
    """Where phrases start whose i-th term has the sorted positions ``lists[i]``.

    The rarest list gives the candidates and each further list thins them, rarest first.  With
    ``slop``, a start counts when every other term lies within that distance of its place.
    The second value is the place of the rarest term, which is where it should be exactly.
    """
    order = sorted(range(len(lists)), key=lambda i: len(lists[i]))
    starts = lists[order[0]].astype(np.int64) - order[0]
    for i in order[1:]:
        if not len(starts):
            break
        wanted = starts + i
        at = np.searchsorted(lists[i], wanted - slop)
        there = at < len(lists[i])
        there[there] = lists[i][at[there]] <= wanted[there] + slop
        starts = starts[there]
    return starts, order[0]


def _search(row: dict, phrases: Phrases, slop: int) -> dict[int, tuple[set[int], list[np.ndarray]]]:
    """Of the documents in one index row that contain items: the items, and the words hit."""
    lengths = np.array(row["lengths"], dtype=np.int64)
    ends = np.frombuffer(row["list_ends"], dtype="<i4")
    positions = np.frombuffer(row["positions"], dtype="<u4")
    lexicon = pa.array(row["lexicon"].split(b"\n") if len(ends) else [], pa.large_binary())
    place = pc.fill_null(pc.index_in(phrases.terms, lexicon), -1).to_pylist()
    bounds = [0, *ends.tolist()]
    first = np.cumsum(lengths) - lengths + np.arange(len(lengths)) * GAP
    found: dict[int, tuple[set[int], list[np.ndarray]]] = {}
    for phrase, owners in zip(phrases.phrases, phrases.owners):
        terms = [place[t] for t in phrase]
        if min(terms) < 0:
            continue
        starts, anchor = occurrences([positions[bounds[t] : bounds[t + 1]] for t in terms], slop)
        documents = np.searchsorted(first, starts + anchor, side="right") - 1
        # Starts are in order, so each document's lie together.
        held, at = np.unique(documents, return_index=True)
        for d, own in zip(held.tolist(), np.split(starts, at[1:])):
            own = own - first[d]
            covered = np.unique(own[:, None] + np.arange(len(phrase)))
            items, hits = found.setdefault(d, (set(), []))
            items.update(owners)
            hits.append(covered[(covered >= 0) & (covered < lengths[d])])
    return found


def _blocks(items: DataFrame, key: str, text: str, window: int) -> Iterator[Phrases]:
    keys, texts, size = [], [], 0
    for item, words in items.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")).toLocalIterator():
        if keys and size + len(words or "") > BLOCK_CHARS:
            yield phrases_of(keys, texts, window)
            keys, texts, size = [], [], 0
        keys.append(item)
        texts.append(words)
        size += len(words or "")
    if keys:
        yield phrases_of(keys, texts, window)


def find_phrases(
    index: DataFrame,
    items: DataFrame,
    key: str = "item_id",
    text: str = "text",
    window: int = 10,
    slop: int = 0,
) -> DataFrame:
    """What ``items`` the indexed documents contain, one row for each document.

    Columns: ``key`` of the document, ``n_words``, ``items`` (distinct keys of items with an
    occurring phrase) and ``hits`` (numbers of the document's words within any occurrence).  A
    phrase is ``window`` consecutive words of an item, or all of a shorter one.  Null and empty
    texts have no words: such documents are returned with nothing found, such items are found
    nowhere.  Repeated documents are returned each; repeated item keys count once, null keys
    are not listed.  Without items nothing is found; without documents the result is empty.
    """
    if window < 1 or window + 2 * slop >= GAP:
        raise ValueError(f"window and slop must stay below {GAP} words")
    kind = items.schema[key].dataType
    schema = f"slice long, number int, items array<{kind.simpleString()}>, hits array<int>"
    types = to_arrow_schema(StructType.fromDDL(schema))
    wanted = index.select("slice", "lengths", "lexicon", "list_ends", "positions")
    found = index.sparkSession.createDataFrame([], schema)
    for phrases in _blocks(items, key, text, window):

        def run(batches, phrases=phrases, types=types):
            for batch in batches:
                for n in range(batch.num_rows):
                    row = batch.slice(n, 1).to_pylist()[0]
                    by_document = _search(row, phrases, slop)
                    cells = [
                        [row["slice"]] * len(by_document),
                        list(by_document),
                        [[k for i in sorted(i) if (k := phrases.items[i]) is not None] for i, _ in by_document.values()],
                        [np.unique(np.concatenate(h)) for _, h in by_document.values()],
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(cells, types.types)], names=types.names
                    )

        found = found.unionByName(wanted.mapInArrow(run, schema))

    # Blocks of items may hit the same document.
    merged = found.groupBy("slice", "number").agg(
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits"),
    )
    documents = index.select("slice", F.posexplode(F.arrays_zip("keys", "lengths")).alias("number", "document"))
    return documents.join(merged, ["slice", "number"], "left").select(
        F.col("document.keys").alias("key"),
        F.col("document.lengths").alias("n_words"),
        F.coalesce("items", F.array().cast(f"array<{kind.simpleString()}>")).alias("items"),
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = 10,
) -> DataFrame:
    """``docs`` without the rows whose text contains a phrase of any item.

    The decision is the text's alone, so rows are known by its digest; rows with null text have
    no words and stay.  Columns, repeated rows and null keys are kept as they are.  The index is
    deleted once it was searched.  Only rows that a Bloom filter takes for leaked ones are joined
    with those; it has a bounded size, beyond which more rows than needed are moved.
    """
    spark = docs.sparkSession
    digest = unused_name(docs, "_digest")
    rows = docs.withColumn(digest, F.sha2(F.col(f"`{text}`").cast("string"), 256))
    path = new_path(spark, "leaked")
    with staging_scope(spark):
        found = find_phrases(build_index(rows, digest, text), items, item_key, item_text, window)
        found.where("size(hits) > 0").select(F.col("key").alias(digest)).distinct().write.parquet(path)
    leaked = spark.read.schema(f"`{digest}` string").parquet(path)
    number = F.xxhash64(F.col(digest))
    maybe = likely(leaked.select(number.alias("number")), "number")(number)
    clean = rows.where(~maybe).unionByName(rows.where(maybe).join(leaked, digest, "left_anti"))
    return clean.select(*docs.columns)
