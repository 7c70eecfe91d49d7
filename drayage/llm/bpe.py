"""Byte-pair encoding by speculation: propose by longest match, verify all neighbours, merge the rest.

A word is first cut greedily into the longest tokens that encode themselves.  The proposal is
the true encoding exactly if no merge ever crosses a border between two of its tokens, and that
depends on the two neighbours alone.  All neighbours of a batch are checked at once with arrays;
only words with a pair that fails are merged step by step.

Texts are cut at white space first, and what one such chunk encodes to is kept by the task, so
a chunk is worked out once.  The vocabulary is read from a public tokenizer's file.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drayage.llm.words import give_back, slices

_SLICE_BYTES = 2 << 20
_CACHED = 160_000  # chunks whose tokens a worker keeps, as bytes
_LONG = 200  # characters; longer chunks are not kept
_SHORT = 64  # symbols; longer words are merged with a heap
_NEVER = int(np.iinfo(np.int64).max)
_LAST = 0xE000  # added to a last character; byte characters are below it


@cache
def byte_characters() -> list[str]:
    """The printable character that stands for each byte in the vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class Vocabulary:
    """Tokens and merges of a tokenizer file: byte-level BPE on lower-cased words with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model = data["model"]
        self.end = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.tokens = [""] * size
        for token, number in [*self.ids.items(), *self.special.items()]:
            self.tokens[number] = token
        splits = [part["pattern"]["Regex"] for part in data["pre_tokenizer"]["pretokenizers"] if "pattern" in part]
        # ``regex`` knows Unicode 17; characters new in it may be cut otherwise by an older library.
        self.pieces = regex.compile(splits[0])
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        self.made: dict[tuple[int, int], int] = {}
        # How each token comes about: its two halves and when; single bytes are there from the start.
        self.left = np.arange(size)
        self.right = np.arange(size)
        self.born = np.full(size, -1, dtype=np.int64)
        for n, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            halves, whole = (self.ids[a], self.ids[b]), self.ids[a + b]
            if halves in self.rank:
                continue
            self.rank[halves], self.made[halves] = n, whole
            if self.born[whole] < 0:
                self.left[whole], self.right[whole], self.born[whole] = *halves, n
        keys = np.array([a * size + b for a, b in self.rank], dtype=np.int64)
        order = np.argsort(keys)
        self._keys = np.append(keys[order], _NEVER)
        self._ranks = np.append(np.array(list(self.rank.values()), dtype=np.int64)[order], _NEVER)

    @cached_property
    def whole(self) -> dict[str, int]:
        """Tokens that encode themselves, by their text; only these are proposed.

        The last character of a word and the word end are one character here.
        """
        own = {t: n for t, n in self.ids.items() if self.merge(self.symbols_of(t)) == [n]}
        return {self._marked(t): n for t, n in own.items()}

    def _marked(self, token: str) -> str:
        body = token.removesuffix(self.end)
        return body[:-1] + chr(_LAST + ord(body[-1])) if body and len(body) < len(token) else token

    @cached_property
    def prefixes(self) -> dict[str, int]:
        """Every beginning of a proposed token: the token it is, or -1."""
        found = {t[:n]: -1 for t in self.whole for n in range(1, len(t))}
        return found | self.whole

    def symbols_of(self, token: str) -> list[int]:
        body = token.removesuffix(self.end) if self.end and token != self.end else token
        marks = list(body)
        if len(body) < len(token):
            marks[-1] += self.end
        return [self.ids[m] for m in marks]

    def merge(self, symbols: list[int]) -> list[int]:
        """Exact merging: the earliest merge first, and of equal ones that on the left."""
        symbols = list(symbols)
        return self._merge_short(symbols) if len(symbols) <= _SHORT else self._merge_long(symbols)

    def _merge_short(self, symbols: list[int]) -> list[int]:
        rank = self.rank
        due = [rank.get(pair, _NEVER) for pair in zip(symbols, symbols[1:])]
        while due and (first := min(due)) < _NEVER:
            i = due.index(first)
            symbols[i : i + 2] = [self.made[symbols[i], symbols[i + 1]]]
            del due[i]
            if i:
                due[i - 1] = rank.get((symbols[i - 1], symbols[i]), _NEVER)
            if i < len(due):
                due[i] = rank.get((symbols[i], symbols[i + 1]), _NEVER)
        return symbols

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """The same in n log n steps."""
        after = [*range(1, len(symbols)), -1]
        before = list(range(-1, len(symbols) - 1))
        heap = [(r, i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if (r := self.rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            _, at, pair = heapq.heappop(heap)
            other = after[at]
            if other < 0 or (symbols[at], symbols[other]) != pair:
                continue  # one of the two has been merged since
            symbols[at], symbols[other] = self.made[pair], -1
            after[at] = after[other]
            if after[at] >= 0:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0 and after[i] >= 0:
                    fresh = (symbols[i], symbols[after[i]])
                    if (r := self.rank.get(fresh)) is not None:
                        heapq.heappush(heap, (r, i, fresh))
        return [s for s in symbols if s >= 0]

    def propose(self, word: str) -> list[int]:
        """Greedy longest match; every last character is a token, so some token always fits."""
        out, at, prefixes, word = [], 0, self.prefixes, self._marked(word)
        while at < len(word):
            token, end, stop = -1, at, at + 1
            while (found := prefixes.get(word[at:stop])) is not None:
                if found >= 0:
                    token, end = found, stop
                if stop == len(word):
                    break
                stop += 1
            out.append(token)
            at = end
        return out

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the tokens ``a[i]`` and ``b[i]`` stay apart when they stand side by side.

        Left of the border lies, at any time, one of the right-hand parts of ``a``, and right of
        it one of the left-hand parts of ``b``.  They are joined if their merge comes while both
        are there: before either is merged into its own token.  If the same merge is due on both
        sides at once, the one further left is done first.
        """
        apart = np.ones(len(a), dtype=bool)
        x, x_gone = a.copy(), np.full(len(a), _NEVER)
        rows = np.arange(len(a))
        while len(rows):
            y, y_gone, at = b[rows], np.full(len(rows), _NEVER), np.arange(len(rows))
            while len(at):
                due = self._rank_of(x[at], y[at])
                apart[rows[at[(due < x_gone[at]) & (due <= y_gone[at])]]] = False
                more = self.born[y[at]] >= 0
                at = at[more]
                y_gone[at] = self.born[y[at]]
                y[at] = self.left[y[at]]
            more = (self.born[x] >= 0) & apart[rows]
            rows, x = rows[more], x[more]
            x_gone, x = self.born[x], self.right[x]
        return apart

    def _rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keys = a.astype(np.int64) * len(self.tokens) + b
        at = np.searchsorted(self._keys, keys)
        return np.where(self._keys[at] == keys, self._ranks[at], _NEVER)

    def words_of(self, chunk: str) -> list[str | int]:
        """The words of a text without white space in byte characters; special tokens as their ids."""
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower() + self.end]
        out: list[str | int] = []
        for part in self.cut.split(chunk) if self.cut else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part.isascii() and part.isprintable():
                out += [piece + self.end for piece in self.pieces.findall(part.lower())]
            elif part:
                plain = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                for piece in self.pieces.findall(plain):
                    out.append("".join(map(byte_characters().__getitem__, piece.encode())) + self.end)
        return out

    def encode_words(self, words: list[str]) -> list[list[int]]:
        proposed = [self.propose(w) for w in words]
        lengths = np.array([len(p) for p in proposed], dtype=np.int64)
        flat = np.array([t for p in proposed for t in p], dtype=np.int64)
        if len(flat) == 0:
            return proposed
        owner = np.repeat(np.arange(len(words)), lengths)
        inside = owner[1:] == owner[:-1]
        pairs = (flat[:-1] * len(self.tokens) + flat[1:])[inside]
        distinct, which = np.unique(pairs, return_inverse=True)
        good = self.compatible(*np.divmod(distinct, len(self.tokens)))
        for i in np.unique(owner[:-1][inside][~good[which]]).tolist():
            proposed[i] = self.merge(self.symbols_of(words[i]))
        return proposed

    def encode_chunks(self, chunks: list[str]) -> list[list[int]]:
        """The tokens of texts without white space."""
        parts = [self.words_of(c) for c in chunks]
        words = list({w for p in parts for w in p if isinstance(w, str)})
        tokens = dict(zip(words, self.encode_words(words)))
        return [[t for w in p for t in ([w] if isinstance(w, int) else tokens[w])] for p in parts]


@cache
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


# White space as the tokenizer takes it; Python also splits at the four separators \x1c to \x1f.
_SEPARATORS = regex.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"[\t-\r \x85\xa0  -     　]+")


def _chunks(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [c for c in _SPACES.split(text) if c]
    return text.split()


# Tokens of chunks by tokenizer, kept by a Python worker from task to task and bounded by _CACHED.
_KNOWN: dict[str, dict[str, bytes]] = {}


def encode(docs: DataFrame, path: str, text: str = "text", column: str = "ids") -> DataFrame:
    """``docs`` with ``column``: the token ids of the whole text.

    ``path`` is the tokenizer's file; it must be readable on every executor.  Null and empty
    texts, and texts of white space, have no tokens.  All other columns and rows, repeated ones
    too, stay as they are; a column of that name is replaced.
    """

    @F.arrow_udf("array<int>")
    def ids(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary, known = load(path), _KNOWN.setdefault(path, {})
        for part in parts:
            batch = pa.RecordBatch.from_arrays([part], ["text"])
            lists = [_encoded(vocabulary, run.column("text"), known) for run in slices(batch, "text", _SLICE_BYTES)]
            yield pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))
            del batch, lists
            give_back()

    return docs.withColumn(column, ids(F.col(f"`{text}`").cast("string")))


def _encoded(vocabulary: Vocabulary, texts: pa.Array, known: dict[str, bytes]) -> pa.ListArray:
    chunks: list[str] = []
    ends = [0]
    for cell in texts:
        chunks += _chunks(cell.as_py() or "")
        ends.append(len(chunks))
    coded = pa.array(chunks, pa.large_string()).dictionary_encode()
    distinct = coded.dictionary.to_pylist()
    fresh = [c for c in distinct if c not in known]
    found = {c: array("i", t).tobytes() for c, t in zip(fresh, vocabulary.encode_chunks(fresh))}
    # What is common comes early, so it is kept until the space is used up.
    room = _CACHED - len(known)
    known.update((c, found[c]) for c in fresh[: max(0, room)] if len(c) <= _LONG)
    tokens = [found[c] if c in found else known[c] for c in distinct]
    # Lay the distinct chunks' tokens out for every chunk of the texts.
    lengths = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) // 4
    flat = np.frombuffer(b"".join(tokens), dtype=np.int32)
    codes = coded.indices.to_numpy()
    sizes = lengths[codes]
    upto = np.concatenate([[0], np.cumsum(sizes)])
    starts = (np.cumsum(lengths) - lengths)[codes]
    ids = flat[np.repeat(starts - upto[:-1], sizes) + np.arange(upto[-1])] if len(codes) else flat
    return pa.ListArray.from_arrays(pa.array(upto[ends].astype(np.int32)), pa.array(ids))


def decode(ids: Column, path: str) -> Column:
    """The text of token ids as the tokenizer's library gives it.

    The file names no decoder, so tokens are joined by a blank, word ends and byte characters
    included.  Null is null, and no tokens are an empty text.
    """

    @F.arrow_udf("string")
    def text(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = pa.array(load(path).tokens, pa.string())
        for part in parts:
            joined = [
                pc.binary_join(
                    pa.ListArray.from_arrays(row.offsets, tokens.take(row.values), mask=row.is_null()), " "
                )
                for row in _few(part)
            ]
            yield pa.concat_arrays(joined) if joined else pa.array([], pa.string())
            del joined
            give_back()

    return text(ids)


def _few(lists: pa.ListArray, rows: int = 500) -> Iterator[pa.ListArray]:
    """Runs of rows, so that the text of one run at a time is built."""
    for start in range(0, len(lists), rows):
        part = lists.slice(start, rows)
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy())])
        yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), part.flatten(), mask=part.is_null())


def restore(vocabulary: Vocabulary, ids: list[int]) -> str:
    """The words of token ids: bytes put together again, one blank after each word."""
    octet = {c: b for b, c in enumerate(byte_characters())}
    out = bytearray()
    for number in ids:
        token = vocabulary.tokens[number]
        body = token.removesuffix(vocabulary.end)
        out += token.encode() if token in vocabulary.special else bytes(octet[c] for c in body)
        if len(body) < len(token):
            out += b" "
    return out.decode("utf-8", "replace")


def with_token_counts(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, ``n_tokens`` and ``decoded``; columns of these names are replaced."""
    encoded = encode(docs, path, text)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long")).withColumn("decoded", decode(F.col("ids"), path))
