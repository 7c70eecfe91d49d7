"""Language identification by words first, then by shorter and shorter character n-grams.

Training counts every word of every labelled text, and every gram of those words, for each
language that has a labelled text.  Nothing is left out: the counts stay in tables.  A known word
scores each language by its log frequency there.  An unseen word scores by its known
four-character grams; if it has none, by those of three characters, then two, then one.

The frequency of a token in a language is mixed with that in all languages together, so a language
with few texts neither gains nor loses by the words of others.  The second part is the same for
all languages; what is added up is by how much the mixture exceeds it.

Words that make up most of all text (at most ``HEAD`` pairs of a word and a language, whatever
the corpus) are sent to the tasks, which add their scores while they read the texts.  The other
words are asked for by block of texts, each distinct word of a block once, and met with the table
of words bucket by bucket; questions and answers are packed.  Words not found there go by their
grams: all grams are sent to the tasks if they are few, and else joined.  Where a word is looked
up changes the work, never the score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drayage.llm.exact_dedup import unused_name
from drayage.llm.packed import bucket_count, by_bucket, pack_numbers, pack_words, unpack_numbers, unpack_words
from drayage.llm.salted import join_back, salt_mask, salt_of
from drayage.llm.words import give_back, slices, split_words
from drayage.scratch import delete, new_path, stage

UNKNOWN = "und"
LONGEST = 4
HEAD = 500_000  # pairs of a word and a language that are sent to the tasks
_SLICE_BYTES = 8 << 20  # text whose words are packed together
MIX = 0.9  # share of a language's own frequencies
_GRAM_BYTES = 1 << 20  # words whose grams are cut at once
_FOUND = -1  # in place of a language: how many grams were found
_LETTER = re.compile(r"[^\W\d_]")
_BYTES = np.arange(256)
# Letters after lower-casing, and whatever is beyond ASCII.
_LETTERS = ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
_BLOCK_TYPE = pa.struct(
    [("size", pa.int64()), *[(name, pa.binary()) for name in ("words", "numbers", "lengths", "codes", "counts")]]
)
_ANSWER = pa.schema(
    [("block", pa.int64()), ("bucket", pa.int64()), *[(name, pa.binary()) for name in ("sizes", "langs", "gains")]]
)


def _words(texts: pa.Array):
    return split_words(pc.utf8_lower(texts), _LETTERS)


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``word``, ``counts`` (by ``lang``) and ``n`` over all whole texts whose text and language are not null.

    Words of a slice of text are counted and packed; each bucket of words is then merged on its own.
    """
    rows = docs.select(
        F.col(f"`{text}`").cast("string").alias("text"), F.col(f"`{lang}`").cast("string").alias("lang")
    ).where("text IS NOT NULL AND lang IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                words, at = _words(part.column("text"))
                if not len(words):
                    continue
                langs = part.column("lang").dictionary_encode()
                coded, distinct = _sorted_codes(words)
                of_word = np.repeat(langs.indices.to_numpy(), np.diff(at))
                pairs, n = np.unique(of_word.astype(np.int64) * len(distinct) + coded, return_counts=True)
                lang_no, code = np.divmod(pairs, len(distinct))
                for no in np.unique(lang_no):
                    own = lang_no == no
                    yield pa.RecordBatch.from_pylist([{
                        "lang": langs.dictionary[int(no)].as_py(), "size": int(own.sum()),
                        "words": pack_words([distinct[c] for c in code[own]]), "n": pack_numbers(n[own].astype(np.int64)),
                    }])
            give_back()

    spark, path = docs.sparkSession, new_path(docs.sparkSession, "packed-counts")
    packed = rows.mapInArrow(run, "lang string, size long, words binary, n binary")
    packed.write.parquet(path)
    packed = spark.read.schema(packed.schema).parquet(path)
    buckets = bucket_count(packed.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, n = unpack_words(row["words"]), unpack_numbers(row["n"])
                for bucket, at in by_bucket(words, buckets):
                    yield pa.RecordBatch.from_pylist([{
                        "bucket": bucket, "lang": row["lang"],
                        "words": pack_words([words[i] for i in at]), "n": pack_numbers(n[at]),
                    }])

    def merge(parts: pa.Table) -> pa.Table:
        give_back()
        langs = parts["lang"].combine_chunks().dictionary_encode()
        lists = [unpack_words(p.as_py()) for p in parts["words"]]
        words = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
        n = np.concatenate([unpack_numbers(p.as_py()) for p in parts["n"]])
        of_word = np.repeat(langs.indices.to_numpy().astype(np.int64), [len(x) for x in lists])
        width = len(langs.dictionary)
        pairs, which = np.unique(words.indices.to_numpy().astype(np.int64) * width + of_word, return_inverse=True)
        sums = np.bincount(which, weights=n).astype(np.int64)
        code, lang_no = np.divmod(pairs, width)
        begins = np.searchsorted(code, np.arange(len(words.dictionary) + 1))
        counts = pa.StructArray.from_arrays([langs.dictionary.take(pa.array(lang_no)), pa.array(sums)], ["lang", "n"])
        return pa.table({
            "word": words.dictionary.cast(pa.string()),
            "counts": pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), counts),
            "n": np.add.reduceat(sums, begins[:-1]),
        })

    cuts = packed.select("lang", "words", "n").mapInArrow(cut, "bucket long, lang string, words binary, n binary")
    counted = cuts.groupBy("bucket").applyInArrow(
        merge, "word string, counts array<struct<lang: string, n: long>>, n long"
    )
    counted = stage(counted, "word-counts")
    delete(spark, path)
    return counted


def _sorted_codes(words: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """The number of each word among the distinct ones, and those in order."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary.cast(pa.large_binary())
    order = pc.array_sort_indices(distinct).to_numpy().astype(np.int64)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    return place[coded.indices.to_numpy()], distinct.take(pa.array(order)).to_pylist()


class Pieces(NamedTuple):
    """Grams of some words: distinct ``tokens``; every gram's word and its number among them."""

    tokens: list[str]
    owner: np.ndarray
    which: np.ndarray


def _pieces(words: list[str], size: int) -> Pieces:
    """The grams of ``size`` characters of the words with a mark at both ends, repeats included."""
    codes = np.frombuffer("".join(f"^{w}$" for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    n = np.maximum(lengths - size + 1, 0)
    owner = np.repeat(np.arange(len(words)), n)
    at = np.arange(n.sum()) + np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(n) - n), n)
    if not len(at):
        return Pieces([], owner, at)
    if size <= 3:  # 21 bits a character
        key = sum(codes[at + k] << 21 * (size - 1 - k) for k in range(size))
    else:
        _, two = np.unique(codes[:-1] << 21 | codes[1:], return_inverse=True)
        key = two[at].astype(np.int64) << 32 | two[at + 2]
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    spelled = codes[at[first][:, None] + np.arange(size)].astype(np.uint32).tobytes().decode("utf-32-le")
    return Pieces([spelled[i : i + size] for i in range(0, len(spelled), size)], owner, which)


def gram_counts(counts: DataFrame) -> DataFrame:
    """``lang``, ``token``, ``size``, ``n`` over all grams of words given as ``lang``, ``word``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word", _GRAM_BYTES):
                langs, n = part.column("lang").to_numpy(), part.column("n").to_numpy()
                names, of_name = np.unique(langs, return_inverse=True)
                words = part.column("word").to_pylist()
                for size in range(1, LONGEST + 1):
                    tokens, owner, which = _pieces(words, size)
                    pairs, spot = np.unique(which * len(names) + of_name[owner], return_inverse=True)
                    token, name = np.divmod(pairs, len(names))
                    sums = np.bincount(spot, weights=n[owner]).astype(np.int64) if len(owner) else np.zeros(0, np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(names[name], pa.int32()),
                            pa.array(tokens, pa.string()).take(pa.array(token)),
                            pa.array(np.full(len(pairs), size), pa.int32()),
                            pa.array(sums),
                        ],
                        ["lang", "token", "size", "n"],
                    )
        give_back()

    counted = counts.mapInArrow(run, "lang int, token string, size int, n long")
    return counted.groupBy("lang", "token", "size").agg(F.sum("n").alias("n"))


def _with_grams(words: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """A row for each gram of ``word``, repeats included: ``token``, ``size`` and the other columns.

    The word itself is left out, as a very long one would be copied as often as it has letters.
    """
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))

    def of_size(size: int) -> Column:
        # At each character, it and what follows; shorter words have none.
        found = F.regexp_extract_all(marked, F.lit(f"(?s)(?=(.{{{size}}}))."), F.lit(1))
        return F.transform(found, lambda g: F.struct(g.alias("token"), F.lit(size).alias("size")))

    rows = words.withColumn("_piece", F.explode(F.flatten(F.array(*[of_size(size) for size in sizes]))))
    others = [c for c in words.columns if c != "word"]
    return rows.select(*others, F.col("_piece.token").alias("token"), F.col("_piece.size").alias("size"))


class Head(NamedTuple):
    """Common words, or grams: that of a number has its ``langs`` and ``gains`` from ``begins[number]`` on."""

    numbers: dict[str, int]
    begins: np.ndarray
    langs: np.ndarray
    gains: np.ndarray


class Model(NamedTuple):
    """What was learned.

    ``rates`` has a row for each size (0: words): a token seen ``c`` times in a language and ``n``
    times in all gains it ``log(1 + rate * c / n)``.  ``words`` (``word``, ``counts``, ``n``) and
    ``grams`` (``token``, ``size``, ``counts``, ``n``) are tables of all counts by number of language.
    ``near`` has all grams, unless they are too many to be sent to the tasks.
    """

    langs: list[str]
    rates: np.ndarray
    head: Head
    words: DataFrame | None
    grams: DataFrame | None
    near: Head | None


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", head: int = HEAD) -> Model:
    """Learn from the labelled rows of ``docs``; rows without text or language are passed over.

    With nothing to learn from, the model knows no language.  What comes to the driver are the
    languages, their totals, and at most ``head`` pairs each of a common word or a gram and a language.
    """
    words = word_counts(docs, text, lang)
    pairs = words.select(F.explode("counts").alias("c"))
    totals = {r["lang"]: r["n"] for r in pairs.groupBy("c.lang").agg(F.sum("c.n").alias("n")).collect()}
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros((LONGEST + 1, 0)), _head([], "word", np.zeros((1, 0))), None, None, None)
    number = F.create_map(*[F.lit(x) for no, name in enumerate(langs) for x in (name, no)])
    numbered = F.transform("counts", lambda c: F.struct(number[c["lang"]].alias("lang"), c["n"].alias("n")))
    words = words.select("word", numbered.alias("counts"), "n")
    grams = gram_counts(words.select("word", F.explode("counts").alias("c")).select("c.lang", "word", "c.n"))
    grams = grams.groupBy("token", "size").agg(F.collect_list(F.struct("lang", "n")).alias("counts"), F.sum("n").alias("n"))
    grams = stage(grams, "grams")

    seen = np.zeros((LONGEST + 1, len(langs)))
    seen[0] = [totals[name] for name in langs]
    sums = grams.select("size", F.explode("counts").alias("c")).groupBy("size", "c.lang")
    sums = sums.agg(F.sum("c.n").alias("n"), F.count("*").alias("pairs")).collect()
    for r in sums:
        seen[r["size"], r["lang"]] = r["n"]
    rates = MIX / (1 - MIX) * seen.sum(axis=1, keepdims=True) / np.maximum(seen, 1)
    # A word pays for each of its languages, so there are no more than `head` pairs.
    common = words.where(F.col("n") * head >= F.size("counts").cast("long") * F.lit(sum(totals.values())))
    near = _head(grams.collect(), "token", rates) if sum(r["pairs"] for r in sums) <= head else None
    return Model(langs, rates, _head(common.collect(), "word", rates), words, grams, near)


def _head(rows: list, token: str, rates: np.ndarray) -> Head:
    pairs = [(r["size"] if token == "token" else 0, lang, n / r["n"]) for r in rows for lang, n in r["counts"]]
    size, langs = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
    return Head(
        {r[token]: no for no, r in enumerate(rows)},
        np.cumsum([0, *[len(r["counts"]) for r in rows]]),
        langs,
        np.log(1 + rates[size, langs] * np.array([p[2] for p in pairs], np.float64)),
    )


def _spread(begins: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All places of runs that begin at ``begins`` and have ``n`` places each."""
    return np.arange(n.sum()) + np.repeat(begins - (np.cumsum(n) - n), n)


def _read(model: Model, texts: pa.Array, numbers: pa.Array) -> list[pa.Array]:
    """By text: if it has a letter, the sums of its common words by language; with the first, all other words.

    These are packed: distinct words, the numbers of the texts, how many words each has, which ones and how often.
    """
    words, at = _words(texts)
    codes, distinct = _sorted_codes(words)
    head, width = model.head, len(model.langs)
    number = np.array([head.numbers.get(w.decode(), -1) for w in distinct], np.int64)
    rest_no = np.cumsum(number < 0) - 1  # among the words that are not common
    rest = [w for w, no in zip(distinct, number.tolist()) if no < 0]
    rows = np.repeat(np.arange(len(texts)), np.diff(at))
    known = number[codes] >= 0

    row, own = rows[known], number[codes[known]]
    n = head.begins[own + 1] - head.begins[own]
    place = _spread(head.begins[own], n)
    spot = np.repeat(row, n) * width + head.langs[place]
    sums = np.bincount(spot, head.gains[place], len(texts) * width)

    pairs, n = np.unique(rows[~known] * max(1, len(rest)) + rest_no[codes[~known]], return_counts=True)
    row, code = np.divmod(pairs, max(1, len(rest)))
    block = {
        "size": len(rest), "words": pack_words(rest), "numbers": pack_numbers(numbers.to_numpy()),
        "lengths": pack_numbers(np.bincount(row, minlength=len(texts)).astype(np.int64)),
        "codes": pack_numbers(code.astype(np.int64)), "counts": pack_numbers(n.astype(np.int64)),
    }
    return [
        pa.array([bool(t and _LETTER.search(t)) for t in texts.to_pylist()], pa.bool_()),
        pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1) * width, pa.int32()), pa.array(sums)),
        pa.array([block if rest and not i else None for i in range(len(texts))], _BLOCK_TYPE),
    ]


def _gains(model: Model, size: int | Column) -> Column:
    """From ``counts`` and ``n``: what a token of the size gains the languages that have it."""
    rates = F.array(*[F.array(*[F.lit(float(r)) for r in row]) for row in model.rates])[size]
    return F.transform(
        "counts", lambda c: F.struct(c["lang"].alias("lang"), F.log(1 + rates[c["lang"]] * c["n"] / F.col("n")).alias("gain"))
    )


def _backed_off(words: DataFrame, model: Model, sizes: Sequence[int]) -> DataFrame:
    """``id`` and ``gains`` by the mean of its known grams of the longest size that has any."""
    pieces = _with_grams(words.select("id", "word"), sizes).withColumn("salt", salt_of(F.col("id")))
    wanted = pieces.groupBy("token", "size").agg(salt_mask(F.col("salt")).alias("salts"))
    wanted = wanted.join(model.grams, ["token", "size"])
    wanted = wanted.select("token", "size", "salts", _gains(model, F.col("size")).alias("gains"))
    met = join_back(pieces, wanted, ["token", "size"], "salt", "salts", "inner")
    found = F.array(F.struct(F.lit(_FOUND).alias("lang"), F.lit(1.0).alias("gain")))
    gains = met.select("id", "size", F.explode(F.concat("gains", found)).alias("g"))
    sums = gains.groupBy("id", "size", "g.lang").agg(F.sum("g.gain").alias("gain"))
    # No more than a row for each size and language.
    lists = sums.groupBy("id").agg(
        F.max("size").alias("longest"), F.collect_list(F.struct("size", "lang", "gain")).alias("all")
    )
    lists = lists.withColumn("all", F.filter("all", lambda g: g["size"] == F.col("longest")))
    lists = lists.withColumn("found", F.filter("all", lambda g: g["lang"] == _FOUND)[0]["gain"])
    mean = F.transform(
        F.filter("all", lambda g: g["lang"] != _FOUND),
        lambda g: F.struct(g["lang"].alias("lang"), (g["gain"] / F.col("found")).alias("gain")),
    )
    return lists.select("id", mean.alias("gains"))


def _mean_gains(words: list[str], near: Head, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By word the number of its gains, their languages and sizes: the mean of its longest known grams."""
    spots, gains = [], []
    left = np.arange(len(words))
    for size in range(LONGEST, 0, -1):
        if not len(left):
            break
        tokens, owner, which = _pieces([words[i] for i in left], size)
        token = np.array([near.numbers.get(t, -1) for t in tokens], np.int64)[which]
        owner, token = owner[token >= 0], token[token >= 0]
        found = np.bincount(owner, minlength=len(left))
        n = near.begins[token + 1] - near.begins[token]
        place = _spread(near.begins[token], n)
        spot, at = np.unique(np.repeat(owner, n) * width + near.langs[place], return_inverse=True)
        row, lang = np.divmod(spot, width)
        gains.append(np.bincount(at, near.gains[place], len(spot)) / found[row])
        spots.append(left[row] * width + lang)
        left = left[found == 0]
    spot = np.concatenate([np.zeros(0, np.int64), *spots])
    order = np.argsort(spot, kind="stable")
    word, lang = np.divmod(spot[order], width)
    return np.bincount(word, minlength=len(words)), lang, np.concatenate([np.zeros(0), *gains])[order]


def _answers(questions: DataFrame, model: Model, shared: Broadcast, buckets: int) -> DataFrame:
    """``block``, ``bucket`` and, packed, the gains of the words asked for in that order."""
    bucket = F.pmod(F.crc32("word"), F.lit(buckets)).alias("bucket")
    table = model.words.select(bucket, "word", _gains(model, 0).alias("gains"))
    if model.near is None:

        def unseen(asked: pa.Table, known: pa.Table) -> pa.Table:
            words = pa.array([w for p in asked["words"] for w in unpack_words(p.as_py())], pa.binary()).unique()
            new = pc.invert(pc.is_in(words, value_set=known["word"].combine_chunks().cast(pa.binary())))
            return pa.table({"word": words.filter(new).cast(pa.string())})

        words = questions.groupBy("bucket").cogroup(table.drop("gains").groupBy("bucket")).applyInArrow(unseen, "word string")
        words = stage(words.withColumn("id", F.monotonically_increasing_id()), "unseen-words")
        longest = stage(_backed_off(words, model, [LONGEST]), "longest-grams")
        shorter = _backed_off(words.join(longest, "id", "left_anti"), model, range(1, LONGEST))
        table = table.unionByName(words.join(longest.unionByName(shorter), "id").select(bucket, "word", "gains"))

    def look_up(asked: pa.Table, known: pa.Table) -> pa.Table:
        give_back()
        model = shared.value
        lists = [unpack_words(p.as_py()) for p in asked["words"]]
        coded = pa.array([w for x in lists for w in x], pa.binary()).dictionary_encode()
        distinct = coded.dictionary
        place = pc.index_in(distinct, value_set=known["word"].combine_chunks().cast(pa.binary()))
        place = pc.fill_null(place, -1).to_numpy().astype(np.int64)
        lists_of = known["gains"].combine_chunks()
        begins = lists_of.offsets.to_numpy().astype(np.int64)
        flat = lists_of.values
        langs, gains = flat.field("lang").to_numpy().astype(np.int64), flat.field("gain").to_numpy()
        n = np.where(place >= 0, np.diff(np.append(begins, begins[-1:]))[place], 0) if len(begins) > 1 else 0 * place
        begin = np.where(place >= 0, begins[place], 0)
        missing = np.flatnonzero(place < 0)
        if model.near is not None and len(missing):
            words = [w.decode() for w in distinct.take(pa.array(missing)).to_pylist()]
            more, more_langs, more_gains = _mean_gains(words, model.near, len(model.langs))
            n[missing], begin[missing] = more, len(langs) + np.cumsum(more) - more
            langs, gains = np.concatenate([langs, more_langs]), np.concatenate([gains, more_gains])
        codes = coded.indices.to_numpy().astype(np.int64)
        out, at = [], 0
        for block, bucket, words in zip(asked["block"].to_pylist(), asked["bucket"].to_pylist(), lists):
            own = codes[at : at + len(words)]
            at += len(words)
            places = _spread(begin[own], n[own])
            out.append((block, bucket, *map(pack_numbers, (n[own], langs[places], gains[places]))))
        return pa.Table.from_pylist([dict(zip(_ANSWER.names, row)) for row in out], _ANSWER)

    return (
        questions.groupBy("bucket")
        .cogroup(table.groupBy("bucket"))
        .applyInArrow(look_up, "block long, bucket long, sizes binary, langs binary, gains binary")
    )


def _rest(blocks: DataFrame, model: Model, shared: Broadcast) -> DataFrame:
    """``row`` and ``gains`` by language: what the words in blocks add up to for each text."""
    buckets = bucket_count(blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0])
    width = len(model.langs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("words").to_pylist()):
                words = unpack_words(packed)
                yield pa.RecordBatch.from_pylist([
                    {"block": block, "bucket": bucket, "words": pack_words([words[i] for i in at])}
                    for bucket, at in by_bucket(words, buckets)
                ])

    def add_up(block: pa.Table, answers: pa.Table) -> pa.Table:
        block = block.to_pylist()[0]
        order = np.concatenate([at for _, at in by_bucket(unpack_words(block["words"]), buckets)])
        answers = answers.sort_by("bucket")
        sizes, langs, gains = (
            np.concatenate([unpack_numbers(p.as_py(), kind) for p in answers[name]])
            for name, kind in (("sizes", np.int64), ("langs", np.int64), ("gains", np.float64))
        )
        n, begin = np.empty_like(order), np.empty_like(order)
        n[order], begin[order] = sizes, np.cumsum(sizes) - sizes
        numbers, lengths, codes, counts = (unpack_numbers(block[c]) for c in ("numbers", "lengths", "codes", "counts"))
        row = np.repeat(np.arange(len(numbers)), lengths)
        places = _spread(begin[codes], n[codes])
        spot, at = np.unique(np.repeat(row, n[codes]) * width + langs[places], return_inverse=True)
        sums = np.bincount(at, gains[places] * np.repeat(counts, n[codes]), len(spot))
        row, lang = np.divmod(spot, width)
        begins = np.searchsorted(row, np.arange(len(numbers) + 1)).astype(np.int32)
        pairs = pa.StructArray.from_arrays([pa.array(lang, pa.int32()), pa.array(sums)], ["lang", "gain"])
        return pa.table({"row": numbers, "gains": pa.ListArray.from_arrays(pa.array(begins), pairs)})

    questions = blocks.select("block", "words").mapInArrow(cut, "block long, bucket long, words binary")
    answers = _answers(questions, model, shared, buckets)
    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(add_up, "row long, gains array<struct<lang: int, gain: double>>")
    )


def predict(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    column: str = "language",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` with ``column``, a struct of ``lang`` and ``score`` (0 to 1) from the text alone.

    Null texts, texts without a letter, and all texts where no language was learned get ``und``
    and 0.  Between equal languages the first by name is taken.  All other columns and rows,
    repeated ones too, stay as they are; a column of that name is replaced.  ``columns`` are
    those to keep, all unless given.  The rows are staged once with a number each.
    """
    kept = [c for c in (docs.columns if columns is None else columns) if c.lower() != column.lower()]
    target = T.StructType.fromDDL("lang string, score double")
    if not model.langs:
        return docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(
            column, F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
        )
    light = model._replace(words=None, grams=None)
    shared = docs.sparkSession.sparkContext.broadcast(light)
    parts_type = T.StructType.fromDDL(
        "letters boolean, sums array<double>, "
        "block struct<size: long, words: binary, numbers: binary, lengths: binary, codes: binary, counts: binary>"
    )

    @F.arrow_udf(parts_type)
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for columns in batches:
            batch = pa.RecordBatch.from_arrays(list(columns), ["text", "number"])
            runs = list(slices(batch, "text", _SLICE_BYTES)) or [batch]
            found = [_read(shared.value, run.column("text"), run.column("number")) for run in runs]
            columns = [pa.concat_arrays(same) for same in zip(*found)]
            yield pa.StructArray.from_arrays(columns, ["letters", "sums", "block"])
            del batch, runs, found, columns
            give_back()

    @F.arrow_udf(target)
    def decide(letters: pa.Array, sums: pa.Array, more: pa.Array) -> pa.Array:
        model = shared.value
        totals = sums.flatten().to_numpy().reshape(len(letters), len(model.langs)).copy()
        row = pc.list_parent_indices(more).to_numpy()
        flat = more.flatten()
        lang, gain = flat.field("lang").to_numpy(), flat.field("gain").to_numpy()
        totals[row, lang] += gain
        # Sums of the same numbers in another order stay equal.
        totals = np.round(totals, 9)
        # The share of each language given the text, all languages being alike before.
        best = totals.argmax(axis=1)
        score = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
        some = letters.to_numpy(zero_copy_only=False)
        langs = [model.langs[b] if s else UNKNOWN for b, s in zip(best, some)]
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(np.where(some, score, 0.0))], ["lang", "score"]
        )

    number, parts, more = (unused_name(docs, name) for name in ("_number", "_parts", "_more"))
    rows = docs.withColumn(number, F.monotonically_increasing_id())
    rows = rows.withColumn(parts, read(F.col(f"`{text}`").cast("string"), F.col(number)))
    rows = stage(rows.select(*[F.col(f"`{c}`") for c in kept], parts, number), "read-texts")
    blocks = rows.where(F.col(parts)["block"].isNotNull())
    blocks = blocks.select(F.col(number).alias("block"), F.col(parts)["block"].alias("b")).select("block", "b.*")
    sums = _rest(blocks, model, shared).select(F.col("row").alias(number), F.col("gains").alias(more))
    rows = rows.withColumn(parts, F.struct(F.col(parts)["letters"].alias("letters"), F.col(parts)["sums"].alias("sums")))
    told = decide(F.col(parts)["letters"], F.col(parts)["sums"], F.coalesce(F.col(more), F.array()))
    joined = rows.join(sums, number, "left").withColumn(column, told)
    return joined.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`"))
