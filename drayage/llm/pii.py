"""Personal identifiers, also disguised ones, with their places in the source text.

The patterns run on the text as it is (base spans) and once more on a normalised text, in which
look-alike characters are ASCII, invisible ones are gone, spelled digits are digits, and
``(at)`` or ``dot`` are ``@`` and ``.``.  Every normalised character knows the source characters
it stands for, so what is found there is reported by its place in the source.

All scans are linear in the length of the text.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from drayage.llm.words import ALNUM, slices, split_words

KINDS = ("email", "ip", "card", "phone")
_SLICE_BYTES = 4 << 20

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
# A run of digits can only begin an address at its start, so later starts are not tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each ``@`` with what may stand before it, back to the last address, and a dotted domain."""
    end = 0
    sign = text.find("@")
    while sign >= 0:
        start = sign
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, sign + 1) if start < sign else None
        if domain:
            end = domain.end()
            yield start, end
        sign = text.find("@", sign + 1)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        if run.group().count(".") < 3:
            continue
        for match in _IP.finditer(run.group()):
            parts = [p.lstrip("0") for p in match.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                yield run.start() + match.start(), run.start() + match.end()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for match in _CARD.finditer(text):
        digits = [ord(c) - 48 for c in match.group() if c not in " -"]
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield match.span()


def _luhn(digits: list[int]) -> bool:
    doubled = (2 * d - 9 * (d > 4) for d in digits[-2::-2])
    return (sum(digits[::-2]) + sum(doubled)) % 10 == 0


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for match in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in match.group()) <= 15:
            yield match.span()


_FINDERS = dict(zip(KINDS, (emails, _ips, _cards, _phones)))

# Letters of other scripts and signs that look like ASCII ones.
_LOOKALIKES = {
    "aeopcyxijsdhqwtmkhb": "аеорсухіјѕԁһԛԝтмкнв",
    "ABEKMHOPCTXIJS": "АВЕКМНОРСТХІЈЅ",
    "oavikptux": "οανικρτυχ",
    "ABEZHIKMNOPTYX": "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
    "------": "\u2010\u2011\u2012\u2013\u2014\u2212",
    "    ": "\u00a0\u2007\u2009\u202f",
    "..@": "\u2024\u3002\ufe6b",
}
# Characters that do not show.
_HIDDEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"


def _lookalike_table() -> dict[int, str]:
    """Also by rule: decimal digits of any script, and full-width, circled and mathematical forms."""
    table = {ord(c): to for plain, like in _LOOKALIKES.items() for c, to in zip(like, plain, strict=True)}
    for code in [*range(0x660, 0x1000), *range(0x2070, 0x2100), *range(0x2460, 0x24EA), *range(0xFF01, 0xFF5F),
                 *range(0x1D400, 0x1D800)]:
        character = chr(code)
        digit = unicodedata.decimal(character, None)
        plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", character)
        if len(plain) == 1 and plain.isascii() and plain.isalnum() | (plain in "@.+-%_() "):
            table.setdefault(code, plain)
    return table


_TABLE = _lookalike_table()

# Digit words in English, German, French and Spanish.
_DIGIT_WORDS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
    "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7",
    "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8",
    "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7",
    "ocho": "8", "nueve": "9",
}
_SIGN_WORDS = {"plus": "+", "dot": ".", "point": ".", "punkt": ".", "punto": "."}
_SPOKEN = "|".join(sorted([*_DIGIT_WORDS, *_SIGN_WORDS], key=len, reverse=True))
_AT, _DOT = r"at|arroba|@", r"dot|point|punkt|punto|\."
_GAP = r"[\s,-]{1,3}"
_DISGUISE = re.compile(
    # [at], (dot) and the like
    rf"(?P<sign>[\s_]{{0,3}}[\[({{<]\s{{0,3}}(?:(?P<at>{_AT})|(?P<dot>{_DOT}))\s{{0,3}}[\])}}>][\s_]{{0,3}})"
    # spoken digits or signs next to others or to digits
    rf"|(?P<spoken>\b(?:[0-9]+{_GAP}(?:{_SPOKEN})\b|(?:{_SPOKEN}){_GAP}(?:{_SPOKEN}|[0-9]+)\b)(?:{_GAP}(?:{_SPOKEN}|[0-9]+)\b)*)"
    # name at host.com, name at host dot com
    rf"|(?P<plain>(?<=\w)[\s_]{{1,3}}at[\s_]{{1,3}}(?=(?:[a-z0-9-]{{1,63}}(?:[\s_]{{1,3}}dot[\s_]{{1,3}}|\.)){{1,5}}[a-z]{{2}}))"
    r"|(?P<stop>(?<=\w)[\s_]{1,3}dot[\s_]{1,3}(?=[a-z0-9-]))"
    # signs written as entities of HTML
    r"|(?P<at_sign>&(?:\#0{0,5}64|\#x0{0,5}40|commat);)|(?P<dot_sign>&(?:\#0{0,5}46|\#x0{0,5}2e|period);)"
    # characters that do not show
    rf"|(?P<hidden>[{_HIDDEN}]+)",
    re.IGNORECASE,
)
_WORD = re.compile(rf"(?:{_SPOKEN})\b|[0-9]+", re.IGNORECASE)
_LOOKS = frozenset(map(chr, _TABLE)) | frozenset(_HIDDEN)
_SIGNS = re.compile(r"[\[({<]\s{0,3}(?:a[tr]|do|p[uo]|@|\.)|&(?:#|commat;|period;)", re.IGNORECASE)
# A word before a spelled at and a plain host: an address, or prose such as "look at example.com".
_BARE_AT = re.compile(r"(\S+)\s{1,3}at\s{1,3}[a-z0-9.-]+", re.IGNORECASE)
_JOINED = re.compile(r"[A-Za-z0-9][._%+-]+[A-Za-z0-9]|[A-Za-z][0-9]|[0-9][A-Za-z]")
_SPOKEN_WORDS = pa.array([*_DIGIT_WORDS, *_SIGN_WORDS], pa.large_string())
_DOT_WORD = pa.array(["dot"], pa.large_string())
_AT_HOST = r"[\s_][aA][tT][\s_]{1,3}[A-Za-z0-9-]+\.[A-Za-z0-9]"


def may_be_spoken(texts: pa.Array) -> np.ndarray:
    """Which texts have a spoken digit or sign next to another or to digits, the word dot, or at before a dotted host."""
    words, rows = split_words(pc.utf8_lower(texts), ALNUM)
    said = pc.is_in(words, _SPOKEN_WORDS).to_numpy(zero_copy_only=False)
    hits = pc.is_in(words, _DOT_WORD).to_numpy(zero_copy_only=False).copy()
    if len(words):
        _, offsets, data = words.buffers()
        first = np.frombuffer(data, dtype=np.uint8)[np.frombuffer(offsets, dtype=np.int64)[: len(words)]]
        figure = (first >= 48) & (first <= 57)
        hits[1:] |= said[1:] & (said[:-1] | figure[:-1]) | figure[1:] & said[:-1]
    hosts = pc.fill_null(pc.match_substring_regex(texts, _AT_HOST), False).to_numpy(zero_copy_only=False)
    return (np.diff(np.concatenate([[0], np.cumsum(hits)])[rows]) > 0) | hosts


class Normalised(NamedTuple):
    """``text``, and pieces of it: where each begins here and in the source, and if it is changed."""

    text: str
    begins: list[int]
    pieces: list[tuple[int, int, bool]]  # source start, source end, changed as a whole

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source characters that the characters ``start`` to ``end`` stand for."""
        first, last = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        at, _, whole = self.pieces[first]
        begin = at if whole else at + start - self.begins[first]
        at, stop, whole = self.pieces[last]
        return begin, stop if whole else at + end - self.begins[last]

    def changed(self, start: int, end: int) -> bool:
        first, last = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        return first != last or self.pieces[first][2]


def normalise(text: str, spoken: bool = True) -> Normalised | None:
    """The text without disguises; None where there is nothing to change.

    ``spoken`` is false where ``may_be_spoken`` has ruled out spelled digits and dots.
    """
    looks = not text.isascii() and not _LOOKS.isdisjoint(set(text))
    if not (looks or spoken or _SIGNS.search(text)):
        return None
    plain = text.translate(_TABLE) if looks else text
    out: list[str] = []
    begins: list[int] = []
    pieces: list[tuple[int, int, bool]] = []
    length = 0

    def add(piece: str, start: int, end: int, whole: bool) -> None:
        nonlocal length
        if piece:
            out.append(piece)
            begins.append(length)
            pieces.append((start, end, whole))
            length += len(piece)

    done = 0
    for match in _DISGUISE.finditer(plain):
        add(plain[done : match.start()], done, match.start(), False)
        if match["spoken"]:
            for piece in _said(match["spoken"], match.start()):
                add(*piece)
        else:
            add(_undisguised(match), *match.span(), True)
        done = match.end()
    add(plain[done:], done, len(plain), False)
    return Normalised("".join(out), begins, pieces)


def _said(run: str, at: int) -> Iterator[tuple[str, int, int, bool]]:
    """Spoken digits and signs as such; what lies between figures and spoken digits stays."""
    end, last = 0, ""
    for match in _WORD.finditer(run):
        word = match.group().lower()
        plain = _DIGIT_WORDS.get(word) or _SIGN_WORDS.get(word)
        kind = "figure" if plain is None else "digit" if plain.isdigit() else "sign"
        if {kind, last} == {"figure", "digit"} or kind == last == "figure":
            yield run[end : match.start()], at + end, at + match.start(), False
        yield plain or match.group(), at + match.start(), at + match.end(), plain is not None
        end, last = match.end(), kind


def _undisguised(match: re.Match) -> str:
    if match["hidden"]:
        return ""
    return "@" if match["at"] or match["plain"] or match["at_sign"] else "."


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    base: bool
    sure: bool = True


def _doubtful(value: str) -> bool:
    """Whether all that makes it an address is an ``at`` that a sentence may have as well."""
    bare = _BARE_AT.fullmatch(value)
    return bool(bare) and bare[1].isascii() and not _JOINED.search(bare[1])


def find_spans(text: str, spoken: bool = True) -> list[Span]:
    """All spans by start, then kind; ends are exclusive and both count code points."""
    spans = [Span(a, k, b, True) for k, kind in enumerate(KINDS) for a, b in _FINDERS[kind](text)]
    normal = normalise(text, spoken)
    if normal is not None:
        plain = {k: [(s.start, s.end) for s in spans if s.kind == k] for k in range(len(KINDS))}
        for k, kind in enumerate(KINDS):
            for a, b in _FINDERS[kind](normal.text):
                start, end = normal.source(a, b)
                changed = normal.changed(a, b) or text[start:end] != normal.text[a:b]
                if changed and not _within(plain[k], start, end):
                    spans.append(Span(start, k, end, False, not (kind == "email" and _doubtful(text[start:end]))))
    return sorted(set(spans))


def _within(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of the spans, which are in order and apart, holds ``start`` to ``end``."""
    at = bisect_right(spans, start, key=lambda s: s[0]) - 1
    return at >= 0 and spans[at][1] >= end


_SPANS = "array<struct<kind: string, start: int, end: int, value: string, base: boolean, sure: boolean>>"


def find_identifiers(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans`` of every row: kind, start, end, the source text, whether plain, and whether sure.

    A plain (base) span is one that the patterns find in the text itself; the others were found
    after normalising and lie in no base span of their kind.  Not sure are those of a plain word, a
    spelled "at" and a plain host, as prose has them too.  Null and empty texts have
    no spans.  Repeated rows and null keys are returned as they are; an empty table gives an
    empty result.  Other columns are not read.
    """
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    spans = to_arrow_type(DataType.fromDDL(_SPANS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", _SLICE_BYTES):
                texts = part.column("text")
                found = [
                    [
                        {
                            "kind": KINDS[s.kind], "start": s.start, "end": s.end, "value": t[s.start : s.end],
                            "base": s.base, "sure": s.sure,
                        }
                        for s in find_spans(t, spoken)
                    ]
                    for t, spoken in zip((cell.as_py() or "" for cell in texts), may_be_spoken(texts).tolist())
                ]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(found, spans)], ["key", "spans"])

    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, spans {_SPANS}")
