"""Word splitting, hashing and small frame helpers shared by the corpus operators.

Words are runs of bytes other than space and 0x09-0x0D. ``bytes.lower`` folds A-Z only. Hashes are 64 bits wide,
computed for all words of a text at once; equal words always have equal hashes, in any process.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Odd multipliers, so that they have an inverse modulo 2**64.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHINGLE_STEP = 0xD6E8FEB86659FD93

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def _power_table(length: int, forward: bool) -> np.ndarray:
    table = _powers[forward]
    if len(table) < length:
        factors = np.full(1 << max(12, (length - 1).bit_length()), _STEP if forward else _STEP_INVERSE, np.uint64)
        factors[0] = 1
        table = _powers[forward] = np.cumprod(factors, dtype=np.uint64)
    return table[:length]


def word_bounds(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words of ``data``."""
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = _SPACE[np.frombuffer(data, np.uint8)]
    change = np.flatnonzero(space[1:] != space[:-1])
    return change[0::2], change[1::2]


def span_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of every ``data[start:end]``."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[np.frombuffer(data, np.uint8)] * _power_table(len(data), True), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _power_table(len(data) + 1, False)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(_SHINGLE_STEP))


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of ``data`` in order."""
    return span_hashes(data, *word_bounds(data))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` words; empty when there are fewer."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(width):
        out = out * np.uint64(_SHINGLE_STEP) + words[i:i + count]
    return mix(out + np.uint64(width))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text.

    A-Z are lower-cased. Fewer words than ``width`` make one shingle of the whole sequence; no words, no shingle.
    """
    words = word_hashes((text or "").encode().lower())
    if not len(words):
        return np.zeros(0, np.uint64)
    return np.unique(window_hashes(words, min(width, len(words))))


def texts_of(batch, column: str) -> list[str]:
    """The column's texts, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def slices(items: Iterable, size: int):
    """Consecutive lists of up to ``size`` items."""
    chunk: list = []
    for item in items:
        chunk.append(item)
        if len(chunk) >= size:
            yield chunk
            chunk = []
    if chunk:
        yield chunk


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null, inside the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(buckets)


def working(df: DataFrame, **columns: Column) -> DataFrame:
    """Only the named expressions of ``df``, so that other columns of any name cannot clash."""
    return df.select(*[c.alias(n) for n, c in columns.items()])
