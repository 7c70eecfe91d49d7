"""Phrases, identifiers, languages, tokens and code lengths against plain versions."""

import collections
import hashlib
import math
import random
import re
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from drayage import scratch
from drayage.llm import bpe, context_tree, decontaminate, language, pii
from drayage.llm.words import ALNUM, NOT_SPACE, split_words

SCHEMA = "doc_id long, text string, lang string"
PATH = public_tokenizers.path("word_bpe_49k.json")


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang) for i, t in enumerate(texts)], SCHEMA)


def lower(text):
    return (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).decode()


def test_words_are_those_of_the_patterns():
    rng = random.Random(0)
    texts = [None, "", " ", "A"] + ["".join(rng.choices("aB1 \n_.é\x0b中-", k=30)) for _ in range(300)]
    for table, pattern in ((ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (NOT_SPACE, r"[^\x20\x09-\x0D]+")):
        for part in (pa.array(texts), pa.array(texts).slice(2, 100)):
            words, rows = split_words(part, table)
            words = words.to_pylist()
            got = [words[a:b] for a, b in zip(rows, rows[1:])]
            assert got == [re.findall(pattern, lower(t)) for t in part.to_pylist()]


def plain_phrases(texts, items, window):
    cut = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t)) for t in texts]
    out = []
    for words in cut:
        hit, found = set(), set()
        for key, text in items:
            item = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
            size = min(window, len(item))
            for i in range(len(item) - size + 1) if size else ():
                for j in range(len(words) - size + 1):
                    if words[j : j + size] == item[i : i + size]:
                        hit |= set(range(j, j + size))
                        found.add(key)
        out.append((len(words), sorted(hit), sorted(x for x in found if x is not None)))
    return out


def test_phrases_match_brute_force(spark, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choices("ab", k=rng.randint(0, 30))) for _ in range(40)] + [None, "", "A, b! a", "a " * 5000]
    items = [(1, "a b a b"), (2, "b b a"), (2, "a"), (3, None), (4, "--"), (None, "b a"), (5, "a b b a a b a")]
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 8)  # several blocks of items
    frame = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.build_index(docs(spark, texts))
    got = {r.key: (r.n_words, sorted(r.hits), sorted(r["items"])) for r in decontaminate.find_phrases(index, frame, window=4).collect()}
    assert [got[i] for i in range(len(texts))] == plain_phrases(texts, items, 4)


def test_proximity_allows_words_to_stray():
    lists = [np.array([0, 10]), np.array([2, 50]), np.array([3])]
    assert decontaminate.occurrences(lists)[0].tolist() == []
    starts, anchor = decontaminate.occurrences(lists, slop=1)
    assert starts.tolist() == [1] and anchor == 2


def test_contaminated_rows_go_and_others_stay(spark):
    leak = "one two three four five six seven eight nine ten"
    frame = docs(spark, [leak, f"x {leak.upper()} y", "clean text", None, ""]).withColumn("_digest", F.lit("c"))
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(frame, items)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4] and kept.columns == frame.columns
    assert decontaminate.drop_contaminated(frame, items.limit(0)).count() == 5
    assert decontaminate.drop_contaminated(frame.limit(0), items).count() == 0


def test_leaks_leave_no_index_and_move_few_rows(spark, monkeypatch):
    leak = " ".join(f"w{i}" for i in range(10))
    frame = docs(spark, [f"x{i} {leak}" if i % 50 == 0 else f"clean text {i}" for i in range(1000)] + [None])
    items = spark.createDataFrame([(1, leak)], "item_id long, text string")
    staged, joined = [], []
    stage, anti = decontaminate.stage, type(frame).join

    def staging(df, label):
        staged.append(stage(df, label))
        return staged[-1]

    def joining(self, other, on=None, how=None):
        if how == "left_anti":
            joined.append(self.count())
        return anti(self, other, on, how)

    monkeypatch.setattr(decontaminate, "stage", staging)
    monkeypatch.setattr(type(frame), "join", joining)
    kept = decontaminate.drop_contaminated(frame, items)
    paths = [path for df in staged for path in df.inputFiles()]
    assert paths and not any(Path(path.removeprefix("file://")).exists() for path in paths)
    assert len(joined) == 1 and 20 <= joined[0] < 500
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(1001) if i % 50 or i == 1000]


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def accepted(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        total = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(1)
    pieces = ["1", "22", ".", ".", "@", "a", "+", " ", "-", "b.c", "4", "(", "255", "256", "é", "%", "1234 5678 9012"]
    for _ in range(5000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 30)))
        want = sorted(
            (m.start(), k, m.end()) for k, (kind, p) in enumerate(BASE.items()) for m in re.finditer(p, text)
            if accepted(kind, m.group())
        )
        assert [(s.start, s.kind, s.end) for s in pii.find_spans(text) if s.base] == want


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("to john (at) example (dot) com.", "email", "john (at) example (dot) com"),
        ("to jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("jo​hn@example.com", "email", "jo​hn@example.com"),
        ("plus four nine one five one two three four five six", "phone", "plus four nine one five one two three four five six"),
        ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
        ("４111 1111 1111 1111", "card", "４111 1111 1111 1111"),
        ("mary_at_site_dot_org", "email", "mary_at_site_dot_org"),
    ],
)
def test_disguises_are_mapped_back(text, kind, value):
    found = [s for s in pii.find_spans(text) if not s.base]
    assert [(pii.KINDS[s.kind], text[s.start : s.end]) for s in found] == [(kind, value)]
    assert pii.may_be_spoken(pa.array([text])).tolist()[0] or pii.normalise(text, spoken=False)


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("write joe at example dot it now", "email", "joe at example dot it"),
        ("write joe at mail dot example dot museum", "email", "joe at mail dot example dot museum"),
        ("write joe at example.com now", "email", "joe at example.com"),
        ("write joe_at_example.nl", "email", "joe_at_example.nl"),
        ("call +49 one five 1 two 3456789 now", "phone", "+49 one five 1 two 3456789"),
        ("call +49 151 2 three 456789", "phone", "+49 151 2 three 456789"),
        ("at 192 dot one six eight dot 1 dot one.", "ip", "192 dot one six eight dot 1 dot one"),
        ("4111 1111 one 111 1111", "card", "4111 1111 one 111 1111"),
    ],
)
def test_any_ending_and_single_spoken_digits_are_undone(text, kind, value):
    assert pii.may_be_spoken(pa.array([text])).tolist() == [True]
    found = [(pii.KINDS[s.kind], text[s.start : s.end]) for s in pii.find_spans(text) if not s.base]
    assert found == [(kind, value)]


@pytest.mark.parametrize("text", ["joe&#64;example&#46;com", "joe&#x40;example.com", "joe&commat;example&period;com"])
def test_entities_are_signs(text):
    assert [(s.start, s.end, s.base, s.sure) for s in pii.find_spans(text, spoken=False)] == [(0, len(text), False, True)]


def test_prose_is_no_address():
    for text in ("see (a) www.example.com", "choose (a) foo.bar", "take [a] b.c"):
        assert pii.find_spans(text) == []
    for text in ("look at example.com now", "meet me at node.js", "page 5 at example.com", "joe at example.com"):
        assert [s.sure for s in pii.find_spans(text)] == [False]
    for text in ("joe.doe at example.com", "joe7 at example.com", "joe at example dot com", "joe (at) example.com"):
        assert [s.sure for s in pii.find_spans(text)] == [True]


def test_figures_near_spoken_digits_stay_plain():
    for text in ("one 10.0.0.1 or two 10.0.0.2", "one five 10.0.0.1", "look at home. Then one 4111 1111 1111 1111"):
        assert not [s for s in pii.find_spans(text) if not s.base]


def test_clean_texts_have_no_spans(spark):
    texts = [None, "", "look at the polka dot dress", "um um dos tres", "x" * 300_000, "1" * 100_000, "a@" * 50_000, "one " * 40_000]
    rows = pii.find_identifiers(docs(spark, texts)).collect()
    assert len(rows) == len(texts) and all(r.spans == [] for r in rows)
    assert pii.find_identifiers(docs(spark, [])).count() == 0


def test_languages_are_told_apart_on_held_out_texts(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(frame.where("doc_id % 3 <> 1"))
    told = language.predict(frame.where("doc_id % 3 = 1"), model).where("language.lang = lang").count()
    assert told >= 0.9 * frame.where("doc_id % 3 = 1").count()


def test_language_of_odd_texts(spark):
    frame = docs(spark, [None, "", "123 !?", "der und die", "the of and", "x" * 100_000]).withColumn("language", F.lit(1))
    train = docs(spark, ["der und die nicht"] * 3, "de").unionByName(docs(spark, ["the of and is", None] * 3, "en"))
    train = train.unionByName(docs(spark, ["lost"], None))
    got = language.predict(frame, language.fit(train)).orderBy("doc_id").collect()
    assert [r.language.lang for r in got[:5]] == ["und", "und", "und", "de", "en"]
    assert all(0 <= r.language.score <= 1 for r in got)
    nothing = language.fit(train.limit(0))
    assert {r.language.lang for r in language.predict(frame, nothing).collect()} == {"und"}
    assert language.predict(frame.limit(0), nothing).count() == 0


def plain_languages(train, texts):
    """Known words first, then the longest known grams, all counts kept."""
    langs = sorted({lang for text, lang in train if text and re.search(r"[^\W\d_]", text)})
    cut = lambda t: re.findall(r"[a-z\x80-\U0010ffff]+", (t or "").lower())
    grams = lambda w, s: [f"^{w}$"[i : i + s] for i in range(len(w) + 3 - s)]
    counts = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    for text, lang in train:
        for word in cut(text):
            counts[0][lang][word] += 1
            for size in range(1, 5):
                counts[size][lang].update(grams(word, size))
    seen = {size: sum(counts[size].values(), collections.Counter()) for size in range(5)}

    def one(token, size):
        return np.array([
            math.log(0.9 * counts[size][x][token] / counts[size][x].total() + 0.1 * seen[size][token] / seen[size].total())
            for x in langs
        ])

    out = []
    for text in texts:
        total = np.zeros(len(langs))
        for word in cut(text):
            if word in seen[0]:
                total += one(word, 0)
                continue
            for size in (4, 3, 2, 1):
                found = [one(g, size) for g in grams(word, size) if g in seen[size]]
                if found:
                    total += np.mean(found, axis=0)
                    break
        share = np.exp(total - total.max())
        out.append((langs[int(np.round(total, 9).argmax())], (share / share.sum()).max()))
    return out


@pytest.mark.parametrize("head", [1, 40])
def test_languages_match_plain_counting(spark, head):
    rng = random.Random(6)
    sounds = {"en": "theandofws", "de": "derschunic", "ky": "жаңыбирок", "ja": "日本語の"}
    word = lambda x: "".join(rng.choices(sounds[x], k=rng.randint(1, 6)))
    train = [(" ".join(word(x) for _ in range(rng.randint(1, 30))), x) for x in sounds for _ in range(15)]
    texts = [" ".join(word(rng.choice([x, x, "en"])) for _ in range(rng.randint(1, 40))) for x in sounds for _ in range(15)]
    texts += ["zzz qqq", "the THE zq", "hot " * 3000, texts[0], texts[0], train[0][0]]
    frame = spark.createDataFrame(train, "text string, lang string")
    model = language.fit(frame, head=head)
    assert len(model.head.langs) <= head
    got = language.predict(docs(spark, texts, None), model, columns=["doc_id"]).orderBy("doc_id").collect()
    for row, (lang, score) in zip(got, plain_languages(train, texts), strict=True):
        assert row.language.lang == lang and row.language.score == pytest.approx(score, abs=1e-6)


def test_grams_sent_to_tasks_and_grams_joined_score_alike(spark):
    rng = random.Random(7)
    word = lambda sounds: "".join(rng.choices(sounds, k=rng.randint(1, 7)))
    train = [(" ".join(word(s) for _ in range(20)), s[:2]) for s in ("theandofws", "derschunic", "жаңыб日𐐀") for _ in range(15)]
    texts = [" ".join(word("theanderschжаң日𐐀") for _ in range(rng.randint(1, 40))) for _ in range(30)] + ["𐐀", "zzz", None]
    frame = spark.createDataFrame(train, "text string, lang string")
    sent, joined = language.fit(frame), language.fit(frame, head=1)
    assert sent.near is not None and joined.near is None
    for model in (sent, joined):
        got = language.predict(docs(spark, texts, None), model, columns=["doc_id"]).orderBy("doc_id").collect()
        for row, (lang, score) in zip(got, plain_languages(train, texts), strict=True):
            if row.language.lang != "und":
                assert row.language.lang == lang and row.language.score == pytest.approx(score, abs=1e-6)


@pytest.mark.parametrize("many", [350_000_000, 3_500_000_000])
def test_more_words_than_32_bits_can_count(spark, monkeypatch, many):
    """A few GB of text have so many words that those times a word's languages are beyond 32 bits."""
    rows = [("der", [("de", many)]), ("the", [("en", many)]), ("in", [("de", many), ("en", many)]), ("rare", [("en", 1)])]
    rows = [(word, counts, sum(n for _, n in counts)) for word, counts in rows]
    counted = spark.createDataFrame(rows, "word string, counts array<struct<lang: string, n: long>>, n long")
    monkeypatch.setattr(language, "word_counts", lambda *_: counted)
    model = language.fit(docs(spark, []))
    assert set(model.head.numbers) == {"der", "the", "in"} and model.grams.agg(F.max("n")).first()[0] > 2 * many
    got = language.predict(docs(spark, ["der in", "the in rare"], None), model).orderBy("doc_id").collect()
    assert [r.language.lang for r in got] == ["de", "en"]


def test_rare_words_are_staged_in_less_than_their_text(spark):
    rng = random.Random(8)
    common = ["".join(rng.choices("abcdefghijklmnop", k=8)) for _ in range(20_000)]
    texts = [" ".join(rng.choices(common, k=200)) for _ in range(1500)]
    train, frame = docs(spark, texts[:1000]), docs(spark, texts, None)
    folder = Path(scratch.run_folder(spark).removeprefix("file:"))
    held = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    before = held()
    told = language.predict(frame, language.fit(train, head=1000), columns=["doc_id"])
    assert told.where("language.lang = 'en'").count() == len(texts)
    assert held() - before < 0.75 * sum(map(len, texts)), (held() - before) / sum(map(len, texts))


def test_rare_languages_and_rare_words_are_learned(spark):
    train = docs(spark, ["the word is not for all of them"] * 7000, "en").unionByName(docs(spark, ["бул жаңы сөз эмес"], "ky"))
    many = [" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}x{'q' * (i // 17576)}" for i in range(a, a + 100))
            for a in range(0, 30_000, 100)]
    model = language.fit(train.unionByName(docs(spark, many, "xx")))
    assert model.langs == ["en", "ky", "xx"] and model.words.where("n = 1").count() >= 30_000
    got = language.predict(docs(spark, ["бул сөз", "not the word", many[7]], None), model).orderBy("doc_id").collect()
    assert [r.language.lang for r in got] == ["ky", "en", "xx"]
    assert all(r.language.score > 0.9 for r in got)


def test_predicting_keeps_clashing_columns_and_repeated_rows(spark):
    frame = docs(spark, ["the of", "the of", None]).selectExpr("doc_id", "text", "1 AS row", "2 AS _number", "3 AS language", "4 AS word")
    got = language.predict(frame.unionByName(frame), language.fit(docs(spark, ["the of and"])))
    assert got.columns == ["doc_id", "text", "row", "_number", "word", "language"] and got.count() == 6
    assert {(r.row, r._number, r.word) for r in got.collect()} == {(1, 2, 4)}


def test_tokens_are_the_library_s(spark):
    library, own = Tokenizer.from_file(PATH), bpe.load(PATH)
    rng = random.Random(3)
    pieces = [*"abcdefghij  '\t\n0123!?.ABCÉßΣ日本한́\x1c\x85\xa0²½ﬁ🙂", "<|endoftext|>", "'ll", "aaaa", "____", "the", "ing", "<|"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 25))) for _ in range(3000)] + ["ab" * 5000, "", " "]
    for text in texts:
        got = [t for c in own.encode_chunks(bpe._chunks(text)) for t in c]
        assert got == library.encode(text, add_special_tokens=False).ids
    rows = bpe.with_token_counts(docs(spark, [*texts[:50], None, "", "x" * 100_000]), PATH).orderBy("doc_id").collect()
    for row in rows:
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert (row.ids, row.n_tokens) == (want, len(want))
        assert row.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.with_token_counts(docs(spark, []), PATH).count() == 0


def test_checks_of_neighbours_agree_with_merging():
    own = bpe.load(PATH)
    rng = random.Random(4)
    tokens = [n for t, n in own.whole.items() if own.tokens[n].isalpha()]
    a, b = np.array(rng.choices(tokens, k=3000)), np.array(rng.choices(tokens, k=3000))
    apart = own.compatible(a, b)
    for x, y, good in zip(a.tolist(), b.tolist(), apart.tolist()):
        symbols = own.symbols_of(own.tokens[x]) + own.symbols_of(own.tokens[y])
        assert (own.merge(symbols) == [x, y]) == good
        assert own._merge_long(list(symbols)) == own._merge_short(list(symbols))


def test_words_come_back_from_tokens():
    own = bpe.load(PATH)
    ids = [t for c in own.encode_chunks("hello wörld of 日本".split()) for t in c]
    assert bpe.restore(own, ids) == "hello wörld of 日本 "


def plain_tree(train, texts, depth):
    """Context-tree weighting by its definition, one decision at a time."""
    counts = collections.defaultdict(lambda: [0, 0])

    def steps(text):
        words = lower(text).encode().split()
        data = b"\n" * depth + b"".join(w + b" " for w in words) + b"\n"
        for at in range(depth, len(data)):
            for bit in range(8):
                yield data[at - depth : at], (1 << bit) | data[at] >> (8 - bit), data[at] >> (7 - bit) & 1

    for text in train:
        for context, place, bit in steps(text):
            for k in range(depth + 1):
                counts[context[depth - k :], place][bit] += 1
    children = collections.defaultdict(list)
    for context, place in counts:
        if context:
            children[context[1:], place].append((context, place))

    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    weighted = {}

    def weight(node):
        if node not in weighted:
            own = kt(*counts[node]) if node in counts else 0.0
            below = sum(weight(c) for c in children.get(node, ()))
            weighted[node] = own if len(node[0]) == depth else float(np.logaddexp(own, below)) + math.log(0.5)
        return weighted[node]

    def chance(context, place, bit):
        p = None
        for k in range(depth, -1, -1):
            node = (context[depth - k :], place)
            a, b = counts.get(node, (0, 0))
            own = ((a, b)[bit] + 0.5) / (a + b + 1)
            share = 1.0 if p is None else math.exp(math.log(0.5) + kt(a, b) - weight(node))
            p = own if p is None else share * own + (1 - share) * p
        return p

    return [sum(math.log10(chance(*s)) for s in steps(t)) for t in texts]


def test_code_lengths_follow_the_definition(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "_PIECE_BYTES", 40)  # several pieces in a block
    texts = ["the cat sat", "The CAT  sat on the mat", None, "", "der hund", "the hat", "unseen zebra", "the cat sat"]
    frame = docs(spark, texts)
    got = {r.key: r for r in context_tree.score_texts(frame, F.col("doc_id") < 5, depth=3).collect()}
    want = plain_tree(texts[:5], texts, 3)
    assert [got[i].score for i in range(len(texts))] == pytest.approx(want, rel=1e-9)
    seen = collections.Counter(w for t in texts[:5] for w in [*lower(t).split(), "\n"])
    total = sum(seen.values())
    for i, text in enumerate(texts):
        tokens = [*lower(text).split(), "\n"]
        base = sum(math.log10((seen[w] + 0.5) / (total + 0.5 * (len(seen) + 1))) for w in tokens)
        assert (got[i].n_tokens, got[i].n_known) == (len(tokens), sum(seen[w] > 0 for w in tokens))
        assert got[i].base_score == pytest.approx(base) and got[i].train_tokens == total


def test_code_lengths_take_six_bytes_of_context(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "_PIECE_RUNS", 7)  # several pieces of runs in a task
    texts = ["the cat sat on the mat", "abcdefg abcdefh abcdxfg", None, "the catalogue", "abcdefg"]
    got = {r.key: r.score for r in context_tree.score_texts(docs(spark, texts), F.col("doc_id") < 3).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(plain_tree(texts[:3], texts, 6), rel=1e-9)


def test_questions_of_blocks_are_staged_in_less_than_their_text(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=200)) for _ in range(1000)]
    folder = Path(scratch.run_folder(spark).removeprefix("file:"))
    held = lambda: sum(f.stat().st_size for f in folder.rglob("*.parquet"))
    before = held()
    scores = [r.score for r in context_tree.score_texts(docs(spark, texts), F.col("doc_id") % 5 != 1).collect()]
    assert len(scores) == len(texts) and all(-10_000 < s < 0 for s in scores)
    assert held() - before < 3 * sum(map(len, texts)), (held() - before) / sum(map(len, texts))


def test_places_of_numbers_are_found_by_open_addressing():
    keys = np.unique(np.random.default_rng(3).integers(0, 1 << 56, 5000)) // 7 * 7
    keys = np.unique(np.concatenate([keys, np.arange(40) << 48]))
    asked = np.random.default_rng(4).integers(0, len(keys), 20_000)
    assert (context_tree.Places(keys).of(keys[asked]) == asked).all()
    assert len(context_tree.Places(keys[:0]).of(keys[:0])) == 0


def test_scores_without_training_and_without_rows(spark):
    frame = docs(spark, ["ab", None])
    got = {r.key: r.score for r in context_tree.score_texts(frame, F.lit(None).cast("boolean")).collect()}
    assert got[1] == pytest.approx(8 * math.log10(0.5)) and got[0] == pytest.approx(32 * math.log10(0.5))
    assert context_tree.score_texts(frame.limit(0), F.lit(True)).count() == 0
    assert hashlib.sha256(b"").hexdigest()  # the digest of no items


def test_tokens_of_chunks_are_kept_in_few_bytes():
    vocabulary, known = bpe.load(PATH), {}
    texts = pa.array(["the cat, the  cats", None, "", "naïve ÆØÅ 日本 x" + "y" * 300])
    got = bpe._encoded(vocabulary, texts, known).to_pylist()
    want = Tokenizer.from_file(PATH)
    assert got == [want.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert bpe._encoded(vocabulary, texts, known).to_pylist() == got
    # A chunk is kept as four bytes for each token, with no object for a token.
    assert known and all(isinstance(t, bytes) and len(t) % 4 == 0 for t in known.values())
