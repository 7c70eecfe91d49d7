"""Whole columns of words and numbers as compressed bytes, for tables that would be wide in rows.

Sorted words and numbers that differ in few bytes take a fraction of the space that rows take in
a shuffle, and pass the JVM as one value.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import zstandard

BUCKET_WORDS = 2_000_000  # words asked for that one bucket holds
LEAST_BUCKETS = 16


def pack_words(words: Sequence[bytes]) -> bytes:
    """Words without line breaks."""
    return zstandard.compress(b"\n".join(words))


def unpack_words(packed: bytes) -> list[bytes]:
    """No words and one empty word are packed alike and come back as none."""
    lines = zstandard.decompress(packed)
    return lines.split(b"\n") if lines else []


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Eight-byte numbers, first bytes first: bytes that are alike lie together."""
    return zstandard.compress(np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack_numbers(packed: bytes, dtype: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view(dtype).ravel()


def bucket_count(words: int) -> int:
    """So many buckets that each gets a bounded share of ``words``."""
    return max(LEAST_BUCKETS, -(-words // BUCKET_WORDS))


def buckets_of(words: Sequence[bytes], buckets: int) -> np.ndarray:
    """The bucket of each word; Spark's ``crc32(word) % buckets`` is the same."""
    return np.array([zlib.crc32(w) for w in words], dtype=np.int64) % buckets


def by_bucket(words: list[bytes], buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that some of the words have, and the places of these words in order."""
    bucket = buckets_of(words, buckets)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for no in np.flatnonzero(np.diff(ends)).tolist():
        yield no, order[ends[no] : ends[no + 1]]
