"""Splitting whole Arrow columns of text into words, without a Python loop over words.

All separators are ASCII, and no byte of a longer UTF-8 sequence is ASCII, so words can be
cut on bytes.  Only A-Z are lower-cased.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_LOWER = np.frombuffer(LOWER, dtype=np.uint8)
_BYTES = np.arange(256)
# [^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing: digits, a-z and everything beyond ASCII.
ALNUM = ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)
# [^\x20\x09-\x0D]
NOT_SPACE = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))


class Words(NamedTuple):
    """``words`` of all rows in a row; row ``i`` has those from ``rows[i]`` to ``rows[i + 1]``."""

    words: pa.Array
    rows: np.ndarray


def split_words(texts: pa.Array, word_bytes: np.ndarray) -> Words:
    """The lower-cased words of each text; null and empty texts have none."""
    texts = texts.cast(pa.large_binary())  # no copy of the text
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or bounds[-1] == bounds[0]:
        return Words(pa.array([], pa.large_string()), np.zeros(len(texts) + 1, dtype=np.int64))
    raw = np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    text = _LOWER[raw]
    inside = word_bytes[text]
    # A word starts where the byte before is none of a word, or belongs to the row before.
    edges = bounds[(bounds > 0) & (bounds < len(text))]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[edges] = False
    starts = np.flatnonzero(inside & ~before)
    before[:-1] = inside[1:]
    before[-1] = False
    before[edges - 1] = False
    ends = np.flatnonzero(inside & ~before) + 1
    cuts = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(ends - starts, out=cuts[1:])
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts), pa.py_buffer(text[inside]))
    return Words(words, np.searchsorted(starts, bounds))


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``max_bytes`` of text; a longer text is a run of its own."""
    sizes = _sizes(batch.column(column))
    run = np.cumsum(sizes) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def give_back() -> None:
    """Return freed memory to the system: a Python worker goes from stage to stage and keeps what it once needed."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def _sizes(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
