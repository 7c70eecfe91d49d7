"""Scoring text by context-tree weighting over bytes.

A text is scored as its sequence of words: each word and a blank, then an end.  Every byte is
decomposed into eight binary decisions.  A decision is predicted at each depth: by the bits of
the byte so far and the last 0, 1, ... ``DEPTH`` bytes.  Each such node holds the counts of both
outcomes in training and a Krichevsky-Trofimov estimate.  Nodes are weighted as in context-tree
weighting: half for the node's own estimate, half for the product of its children's.  The
prediction mixes the estimates of all depths by these weights, and its code length is the score.

The counts are of runs of ``DEPTH + 1`` bytes, gathered from the whole training corpus, so they
grow with it.  All nodes below a context of two bytes need only the runs of
that context, so runs are solved by that context in parallel; the nodes above have one byte of
context at most and form a table of at most 65,536 rows.

Texts are kept in blocks.  A block asks once for each distinct run and word it has, and the
answers meet it by its number; no model is sent to all tasks.  Questions and answers are packed,
a row for each block and part.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.llm.packed import bucket_count, by_bucket, pack_numbers, pack_words, unpack_numbers, unpack_words
from drayage.llm.words import NOT_SPACE, give_back, slices, split_words
from drayage.scratch import stage

DEPTH = 6  # bytes of context; a run of DEPTH + 1 bytes must fit in 56 bits
TOP = 2  # bytes of context by which runs are solved together
BLOCK_BYTES = 32 << 20  # text in a block, unless a single text is longer
PARTS = 4  # bytes of context whose runs are solved at once, in pieces
TASK_BYTES = 8 << 20  # text whose runs a task solves, unless one context has more
LEAST_TASKS = 32
_MERGED_RUNS = 4_000_000  # runs of several blocks that are merged at once
_SORTED_RUNS = 2_000_000  # runs of a block that are sorted at once
_PIECE_BYTES = 1 << 20  # text whose runs are laid out at once
_PIECE_RUNS = 1 << 16  # runs that are solved at once, unless one context of PARTS bytes has more
_END, _BLANK = 10, 32
_HALF = np.log(0.5)
_BITS = np.arange(8)


def runs_of(words: pa.Array, rows: np.ndarray, depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The byte runs of all texts, and where each text's begin.

    There is a run for each byte of a text: the ``depth`` bytes before it, nearest first and in
    the highest places, and then the byte itself.  End bytes are thought to lie before a text.
    """
    texts = len(rows) - 1
    _, offsets, data = words.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    # Each word takes its bytes and a blank, each text one end byte.
    spaces = np.arange(len(words)) + np.repeat(np.arange(texts), np.diff(rows))
    begins = cuts[rows] - cuts[0] + rows + np.arange(texts + 1)
    stream = np.full(begins[-1], _BLANK, dtype=np.int64)
    stream[begins[1:] - 1] = _END
    places = np.repeat(spaces, np.diff(cuts)) + np.arange(cuts[-1] - cuts[0])
    stream[places] = np.frombuffer(data, dtype=np.uint8)[cuts[0] : cuts[-1]] if len(words) else 0
    runs = stream.copy()
    if depth:
        # The bytes before, nearest first, at first as if all texts were one.
        before = np.concatenate([np.full(depth, _END), stream])[:-1]
        context = before[depth - 1 :].copy()
        for back in range(1, depth):
            context <<= 8
            context |= before[depth - 1 - back : len(before) - back]
        runs |= context << 8
    for k in range(depth):
        # The byte k of a text has only k bytes of its own before it.
        at = begins[:-1] + k
        at = at[at < begins[1:]]
        foreign = (1 << 8 * (depth - k)) - 1
        ends = foreign // 255 * _END
        runs[at] = (runs[at] & ~(foreign << 8)) | ends << 8
    return runs, begins


class Places:
    """Where each of some distinct numbers is, by open addressing; all that are asked for must be there."""

    def __init__(self, keys: np.ndarray):
        self._keys = keys
        self._bits = max(4, (2 * len(keys)).bit_length())
        self._slots = np.zeros(1 << self._bits, dtype=np.int32)  # 0: free, else the place plus one
        at, left = self._first(keys), np.arange(len(keys))
        while len(left):
            free = self._slots[at] == 0
            self._slots[at[free]] = left[free] + 1
            more = self._slots[at] != left + 1
            at, left = self._next(at[more]), left[more]

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & (len(self._slots) - 1)

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = self._first(keys)
        found = self._slots[at] - 1
        left = np.flatnonzero(self._keys[found] != keys)
        at = at[left]
        while len(left):
            at = self._next(at)
            found[left] = self._slots[at] - 1
            more = self._keys[found[left]] != keys[left]
            at, left = at[more], left[more]
        return found


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, with small arguments moved up first."""
    y, moved = x.astype(np.float64), np.zeros(len(x))
    for _ in range(8):
        small = y < 8
        moved[small] -= np.log(y[small])
        y[small] += 1
    return moved + (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - (1 / 360 - 1 / (1260 * y * y)) / (y * y)) / y


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The log of the Krichevsky-Trofimov probability of so many zeros and ones in any one order."""
    return _log_gamma(zeros + 0.5) + _log_gamma(ones + 0.5) - _log_gamma(zeros + ones + 1) - np.log(np.pi)


class Level(NamedTuple):
    """Nodes of one depth: counts, the weight of the own estimate (1 at the deepest), log P weighted."""

    zeros: np.ndarray
    ones: np.ndarray
    own: np.ndarray
    weighted: np.ndarray


def _level(zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None) -> Level:
    estimate = log_kt(zeros, ones)
    if below is None:
        return Level(zeros, ones, np.ones(len(zeros)), estimate)
    weighted = np.logaddexp(_HALF + estimate, _HALF + below)
    return Level(zeros, ones, np.exp(_HALF + estimate - weighted), weighted)


def _decisions(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run the eight places in the byte's binary tree (1 to 255), and the eight outcomes."""
    byte = (runs & 255)[:, None]
    return (1 << _BITS) | (byte >> (8 - _BITS)), (byte >> (7 - _BITS)) & 1


def _nodes(runs: np.ndarray, place: np.ndarray, length: int, depth: int) -> np.ndarray:
    """Numbers of the nodes that a context of ``length`` bytes and the places stand for."""
    return ((runs >> (8 * (depth - length + 1)))[:, None] << 8) | place


def solve(runs: np.ndarray, n: np.ndarray, depth: int = DEPTH, top: int = TOP) -> tuple[np.ndarray, np.ndarray, Level]:
    """Predictions of every run's eight decisions by contexts of ``top`` to ``depth`` bytes.

    ``runs`` are all distinct runs of some contexts of ``top`` bytes, with their counts in
    training, which may be zero.  Also returns the nodes of ``top`` bytes and their level.
    """
    place, bit = _decisions(runs)
    weight = np.repeat(n.astype(np.float64), 8)
    flat = bit.ravel()
    prediction = level = children = None
    levels = []
    for length in range(depth, top - 1, -1):
        nodes, which = np.unique(_nodes(runs, place, length, depth).ravel(), return_inverse=True)
        ones = np.bincount(which, weights=weight * flat, minlength=len(nodes))
        zeros = np.bincount(which, weights=weight * (1 - flat), minlength=len(nodes))
        below = None
        if level is not None:
            parent = np.searchsorted(nodes, _parents(children))
            below = np.bincount(parent, weights=level.weighted, minlength=len(nodes))
        level, children = _level(zeros, ones, below), nodes
        levels.append((which, level))
    for which, level in levels:
        prediction = _mixed(prediction, which, flat, level)
    return prediction.reshape(-1, 8), children, level


def _parents(nodes: np.ndarray) -> np.ndarray:
    return (nodes >> 16 << 8) | (nodes & 255)


def _run_pieces(runs: np.ndarray, depth: int, parts: int) -> Iterator[slice]:
    """Sorted runs in pieces of whole contexts of ``parts`` bytes."""
    context = runs >> (8 * (depth - parts + 1))
    starts = np.concatenate([[0], np.flatnonzero(np.diff(context)) + 1])
    cuts = starts[np.concatenate([[0], np.flatnonzero(np.diff(starts // _PIECE_RUNS)) + 1])]
    yield from map(slice, cuts, [*cuts[1:], len(runs)])


def upper_levels(runs: np.ndarray, n: np.ndarray, depth: int = DEPTH) -> list[tuple[np.ndarray, Level]]:
    """Nodes and levels of contexts below ``PARTS`` bytes down to ``TOP``, for sorted runs, piece by piece.

    Where nothing lies between, the nodes of ``TOP`` bytes are the last ones too.
    """
    parts = max(TOP, min(PARTS, depth))
    found = [solve(runs[at], n[at], depth, parts)[1:] for at in _run_pieces(runs, depth, parts)]
    nodes = np.concatenate([x for x, _ in found])
    level = Level(*(np.concatenate(x) for x in zip(*(level for _, level in found))))
    levels = [(nodes, level)]
    for _ in range(parts - TOP):
        above, which = np.unique(_parents(nodes), return_inverse=True)
        level = _level(*(np.bincount(which, weights=x, minlength=len(above)) for x in (level.zeros, level.ones, level.weighted)))
        nodes = above
        levels.append((nodes, level))
    return levels


def _mixed(deeper: np.ndarray | None, which: np.ndarray, bit: np.ndarray, level: Level) -> np.ndarray:
    zeros, ones = level.zeros[which], level.ones[which]
    own = (np.where(bit == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
    if deeper is None:
        return own
    weight = level.own[which]
    return weight * own + (1 - weight) * deeper


class Asked(NamedTuple):
    """Questions of a block: distinct sorted ``runs`` and their counts in training, packed."""

    block: int
    runs: bytes
    n: bytes


def _partition(batches: Iterator[pa.RecordBatch]) -> tuple[list[Asked], np.ndarray, np.ndarray]:
    """All questions of a partition, its distinct runs in order, and their counts."""
    asked: list[Asked] = []
    runs, n, held = [], [], 0
    for batch in batches:
        for row in batch.select(["block", "runs", "n"]).to_pylist():
            asked.append(Asked(**row))
            runs.append(_unpack_sorted(row["runs"]))
            n.append(unpack_numbers(row["n"]))
            held += len(runs[-1])
            if held > _MERGED_RUNS:
                runs, n = ([x] for x in _merged(runs, n))
                held = len(runs[0]) // 2
    return asked, *_merged(runs, n)


def _merged(runs: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not runs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.concatenate(runs)
    order = np.argsort(both)
    both, counts = both[order], np.concatenate(n)[order]
    starts = np.concatenate([[0], np.flatnonzero(np.diff(both)) + 1])
    return both[starts], np.add.reduceat(counts, starts)


def _counted(marked: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs in order, and how many of each have the lowest bit set."""
    both = np.sort(np.concatenate(marked))
    edges = np.concatenate([[0], np.flatnonzero(both[1:] != both[:-1]) + 1])
    n = np.diff(np.append(edges, len(both))) * (both[edges] & 1)
    runs = both[edges] >> 1
    starts = np.concatenate([[0], np.flatnonzero(runs[1:] != runs[:-1]) + 1])
    return runs[starts], np.add.reduceat(n, starts)


def _pack_sorted(numbers: np.ndarray) -> bytes:
    return pack_numbers(np.diff(numbers, prepend=0))


def _unpack_sorted(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(packed))


def log_probabilities(questions: DataFrame, tasks: int, depth: int = DEPTH) -> DataFrame:
    """``block``, ``keys`` and ``values``: each block's runs again, with log10 of the probability of a run's byte after its context.

    ``questions`` has ``part``, ``block``, ``runs`` and ``n``, the counts in the block's training texts; all runs
    of a context of ``TOP`` bytes are in one part.
    """
    dealt = questions.repartition(tasks, "part")

    def upper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, runs, n = _partition(batches)
        if len(runs):
            nodes, level = upper_levels(runs, n, depth)[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (_parents(nodes), level.zeros, level.ones, level.weighted)], ["node", "zeros", "ones", "below"]
            )

    nodes = dealt.mapInArrow(upper, "node long, zeros double, ones double, below double")
    sums = nodes.groupBy("node").agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "below")])
    # Nodes with one byte of context: 256 * 255 rows at most.
    table = np.zeros((3, 1 << 16))
    for row in sums.collect():
        table[:, row["node"]] = row["zeros"], row["ones"], row["below"]
    one = _level(*table)
    zeros, ones, below = (x.reshape(256, 256).sum(axis=0) for x in (one.zeros, one.ones, one.weighted))
    top = [one, _level(zeros, ones, below)]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, runs, n = _partition(batches)
        if not len(runs):
            return
        levels = upper_levels(runs, n, depth)
        parts = TOP + len(levels) - 1
        log10p = np.empty(len(runs))
        for at in _run_pieces(runs, depth, parts):
            prediction, _, _ = solve(runs[at], n[at], depth, parts)
            place, bit = _decisions(runs[at])
            for length, (nodes, level) in zip(range(parts - 1, TOP - 1, -1), levels[1:]):
                which = np.searchsorted(nodes, _nodes(runs[at], place, length, depth).ravel())
                prediction = _mixed(prediction.ravel(), which, bit.ravel(), level).reshape(-1, 8)
            for length, level in ((1, top[0]), (0, top[1])):
                which = _nodes(runs[at], place, length, depth)
                prediction = _mixed(prediction.ravel(), which.ravel(), bit.ravel(), level).reshape(-1, 8)
            log10p[at] = np.log10(prediction).sum(axis=1)
        for block, own, _ in asked:
            values = pack_numbers(log10p[np.searchsorted(runs, _unpack_sorted(own))])
            yield pa.RecordBatch.from_pylist([{"block": block, "keys": own, "values": values}])
        del asked, runs, n, levels, log10p
        give_back()

    return dealt.mapInArrow(predict, "block long, keys binary, values binary")


_BLOCK = "keys array<{key}>, train array<boolean>, sizes array<int>, lengths array<int>, words binary"


def _blocks(docs: DataFrame, key: str, text: str, train: Column) -> DataFrame:
    """Blocks of texts: keys, whether each is learned from, its words and bytes, and all words packed."""
    rows = docs.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"), train.alias("train")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                words, sizes, lengths = [], [], []
                for piece in slices(part, "text", _PIECE_BYTES):
                    found, at = split_words(piece.column("text"), NOT_SPACE)
                    words.append(_joined(found))
                    sizes.append(np.diff(at).astype(np.int32))
                    upto = np.concatenate([[0], np.cumsum(pc.binary_length(found).to_numpy(zero_copy_only=False) + 1)])
                    lengths.append(np.diff(upto[at]).astype(np.int32))
                whole = pa.array([0, part.num_rows], pa.int32())
                lists = [part.column("key"), part.column("train"), *[pa.array(np.concatenate(x)) for x in (sizes, lengths)]]
                packed = zstandard.compress(b"".join(words))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.ListArray.from_arrays(whole, x) for x in lists], pa.array([packed], pa.binary())],
                    ["keys", "train", "sizes", "lengths", "words"],
                )
                del words, sizes, lengths, lists, packed
                give_back()

    schema = _BLOCK.format(key=rows.schema["key"].dataType.simpleString())
    return stage(rows.mapInArrow(run, schema).withColumn("block", F.monotonically_increasing_id()), "text-blocks")


def _joined(words: pa.Array) -> bytes:
    """The words, a line each."""
    _, offsets, data = words.buffers()
    cuts = np.frombuffer(offsets, dtype=np.int64)[: len(words) + 1]
    out = np.full(cuts[-1] + len(words), _END, dtype=np.uint8)
    if len(words):
        out[np.repeat(np.arange(len(words)), np.diff(cuts)) + np.arange(cuts[-1])] = np.frombuffer(data, dtype=np.uint8)
    return out.tobytes()


def _pieces(lengths: np.ndarray, packed: bytes) -> Iterator[tuple[int, int, pa.Array, np.ndarray]]:
    """A block's texts in runs of about ``_PIECE_BYTES``: from, to, words, and where each text's begin."""
    lines = zstandard.decompress(packed)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    piece = ends[1:] // _PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(lengths)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            texts = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), b - a, [None, pa.py_buffer(ends[a : b + 1].astype(np.int64)), pa.py_buffer(lines)]
            )
            words, rows = split_words(texts, NOT_SPACE)
            yield a, b, words, rows


def _run_questions(blocks: DataFrame, tasks: int, depth: int) -> DataFrame:
    """(part, block, runs, n): what runs each block has, packed, and how often in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lengths, train, words in _rows(batches):
            # The lowest bit tells whether the text is learned from, so one sort does for both.
            marked, held, found = [], 0, []
            for a, b, own, rows in _pieces(lengths, words):
                runs, begins = runs_of(own, rows, depth)
                marked.append((runs << 1) | np.repeat(train[a:b], np.diff(begins)))
                held += len(runs)
                if held >= _SORTED_RUNS:
                    found.append(_counted(marked))
                    marked, held = [], 0
            if held:
                found.append(_counted(marked))
            runs, n = _merged(*map(list, zip(*found))) if len(found) > 1 else found[0]
            # Contexts of TOP bytes are dealt to parts by a multiplication, so that neighbours part.
            context = runs >> (8 * (depth - TOP + 1))
            part = (context * 40503 % 65521 * tasks) // 65521
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(tasks + 1))
            for no in np.flatnonzero(np.diff(ends)).tolist():
                at = order[ends[no] : ends[no + 1]]
                yield pa.RecordBatch.from_pylist([
                    {"part": no, "block": block, "runs": _pack_sorted(runs[at]), "n": pack_numbers(n[at])}
                ])
            del runs, n, found, order
            give_back()

    return blocks.select("block", "train", "lengths", "words").mapInArrow(
        run, "part long, block long, runs binary, n binary"
    )


def _token_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """``block``, ``keys`` and ``values``: each block's words and their counts in all training texts, packed.

    Each bucket's ``total`` and number of ``distinct`` words in training are in one of its rows.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, lengths, train, words in _rows(batches):
            names, counts = pa.array([], pa.large_string()), np.zeros(0)
            for a, b, own, rows in _pieces(lengths, words):
                coded = own.dictionary_encode()
                said = np.repeat(train[a:b], np.diff(rows))
                n = np.bincount(coded.indices.to_numpy(), weights=said, minlength=len(coded.dictionary))
                merged = pa.concat_arrays([names, coded.dictionary]).dictionary_encode()
                names = merged.dictionary
                counts = np.bincount(
                    merged.indices.to_numpy(), weights=np.concatenate([counts, n]), minlength=len(names)
                )
            names = names.cast(pa.large_binary())
            order = pc.array_sort_indices(names)
            names, counts = names.take(order).to_pylist(), counts[order.to_numpy()].astype(np.int64)
            for bucket, at in by_bucket(names, buckets):
                yield pa.RecordBatch.from_pylist([{
                    "bucket": bucket, "block": block,
                    "keys": pack_words([names[i] for i in at]), "n": pack_numbers(counts[at]),
                }])
            del names, counts
            give_back()

    def merge(asked: pa.Table) -> pa.Table:
        lists = [unpack_words(p.as_py()) for p in asked["keys"]]
        words = pa.array([w for x in lists for w in x], pa.large_binary()).dictionary_encode()
        which = words.indices.to_numpy()
        n = np.bincount(which, weights=np.concatenate([unpack_numbers(p.as_py()) for p in asked["n"]])).astype(np.int64)
        ends = np.cumsum([len(x) for x in lists])
        values = [pack_numbers(n[own].astype(np.float64)) for own in np.split(which, ends[:-1])]
        first = np.arange(len(lists)) == 0
        return pa.table({
            "block": asked["block"], "keys": asked["keys"], "values": pa.array(values, pa.binary()),
            "total": first * n.sum(), "distinct": first * np.count_nonzero(n),
        })

    asked = blocks.select("block", "train", "lengths", "words").mapInArrow(
        ask, "bucket long, block long, keys binary, n binary"
    )
    return asked.groupBy("bucket").applyInArrow(merge, "block long, keys binary, values binary, total long, distinct long")


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, bytes]]:
    for batch in batches:
        for i in range(batch.num_rows):
            lengths = batch.column("lengths")[i].values.to_numpy().astype(np.int64)
            train = batch.column("train")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.column("block")[i].as_py(), lengths, train, batch.column("words")[i].as_py()


def score_texts(
    docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", depth: int = DEPTH
) -> DataFrame:
    """Score every row of ``docs`` by a model of those for which ``train`` is true.

    Columns: ``key``, ``trained``, ``n_tokens`` (words and one end), ``n_known``,
    ``train_tokens``, ``base_score`` (tokens on their own, add one half), ``score`` (log10 of
    the text's probability under context-tree weighting) and ``bits_per_byte``.  A-Z are
    lower-cased and words end at ASCII white space.  Null texts are empty: an end alone.  Null
    ``train`` is false.  Repeated rows are scored each and null keys kept.  Without training
    rows every decision is one half.  An empty table gives an empty result.
    """
    blocks = _blocks(docs, key, text, F.coalesce(train, F.lit(False)))
    sums = blocks.agg(*[
        F.coalesce(F.sum(F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)), F.lit(0)) for c in ("lengths", "sizes")
    ], F.coalesce(F.sum(F.size(F.filter("train", lambda t: t))), F.lit(0)))
    n_bytes, n_words, end = sums.first()
    tasks = max(LEAST_TASKS, n_bytes // TASK_BYTES)
    questions = stage(_run_questions(blocks, tasks, depth), "run-questions")
    # A block has far fewer distinct words than words.
    tokens = stage(_token_counts(blocks, bucket_count(n_words // 8)), "token-counts")
    total, distinct = tokens.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("total", "distinct")]).first()
    total, distinct = total + end, distinct + (end > 0)
    answers = log_probabilities(questions, tasks, depth).withColumn("of_run", F.lit(True)).unionByName(
        tokens.select("block", "keys", "values", F.lit(False).alias("of_run"))
    )
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    least = 0.5 / (total + 0.5 * (distinct + 1))

    def score(block: pa.Table, known: pa.Table) -> pa.Table:
        give_back()
        block = block.combine_chunks()
        asked, values = (known.filter(known["of_run"]), known.filter(pc.invert(known["of_run"])))
        run_keys = np.concatenate([np.zeros(0, np.int64), *[_unpack_sorted(k.as_py()) for k in asked["keys"]]])
        run_values = np.concatenate([np.zeros(0), *[unpack_numbers(v.as_py(), np.float64) for v in asked["values"]]])
        places = Places(run_keys)
        names = pa.array([w for k in values["keys"] for w in unpack_words(k.as_py())], pa.large_binary())
        seen = np.concatenate([np.zeros(0), *[unpack_numbers(v.as_py(), np.float64) for v in values["values"]]])
        out = []
        for row in range(block.num_rows):
            keys, train = block["keys"][row].values, block["train"][row].values
            sizes = block["sizes"][row].values.to_numpy().astype(np.int64)
            known_words, base = np.zeros(len(sizes)), np.zeros(len(sizes))
            scores, n_bytes = np.zeros(len(sizes)), np.zeros(len(sizes))
            lengths = block["lengths"][row].values.to_numpy().astype(np.int64)
            for a, b, words, rows in _pieces(lengths, block["words"][row].as_py()):
                text_of = np.repeat(np.arange(a, b), np.diff(rows))
                c = seen[pc.index_in(words.cast(pa.large_binary()), names).to_numpy(zero_copy_only=False).astype(np.int64)]
                known_words += np.bincount(text_of, weights=c > 0, minlength=len(sizes))
                base += np.bincount(text_of, weights=np.log10((c + 0.5) * 2 * least), minlength=len(sizes))
                found, begins = runs_of(words, rows, depth)
                value = np.concatenate([run_values[places.of(x)] for x in np.array_split(found, 8)])
                scores[a:b] = np.add.reduceat(value, begins[:-1])
                n_bytes[a:b] = np.diff(begins)
            base += np.log10((end + 0.5) * 2 * least)
            out.append(pa.table({
                "key": keys, "trained": train, "n_tokens": sizes + 1,
                "n_known": (known_words + (end > 0)).astype(np.int64),
                "train_tokens": np.full(len(sizes), total, dtype=np.int64),
                "base_score": base, "score": scores, "bits_per_byte": -scores / np.log10(2) / n_bytes,
            }))
        del known, asked, values, names, seen, run_keys, run_values, places
        give_back()
        return pa.concat_tables(out)

    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            score,
            f"key {kind}, trained boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
            "score double, bits_per_byte double",
        )
    )
