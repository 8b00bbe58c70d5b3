"""Hashed words and character n-grams of texts, computed for a whole text at once."""

from __future__ import annotations

import numpy as np

from ledgerfeat.llm.text import mix, span_hashes, word_bounds

_BYTES = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_STEPS = [np.uint32(x | 1) for x in (mix(np.arange(1, 17, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)]
_FINAL = 0x9E3779B1
#: White space as spaces, so that a word looks the same at the end of a line.
_TO_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


def padded(text: str) -> bytes:
    """The text's bytes between two spaces."""
    return b" " + text.encode("utf-8", "replace").translate(_TO_SPACES) + b" "


def ngram_buckets(data: bytes, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte, 0 to 2**bits - 1."""
    count = len(data) - order + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    values = _BYTES[np.frombuffer(data, np.uint8)]
    out = np.full(count, order * _FINAL % (1 << 32), np.uint32)
    for j in range(order):
        out += values[j:j + count] * _STEPS[j]
    out ^= out >> np.uint32(15)
    out *= np.uint32(_FINAL)
    return (out >> np.uint32(32 - bits)).astype(np.int64)


def word_buckets(data: bytes, starts: np.ndarray, ends: np.ndarray, bits: int) -> np.ndarray:
    """Bucket of each word."""
    return (span_hashes(data, starts, ends) >> np.uint64(64 - bits)).astype(np.int64)


class Words:
    """Words of a text with the n-grams that lie in each word and the space on either side."""

    def __init__(self, text: str) -> None:
        self.data = padded(text)
        self.starts, self.ends = word_bounds(self.data)
        self.hashes = span_hashes(self.data, self.starts, self.ends)

    def distinct(self) -> Words:
        """First occurrence of each distinct word."""
        self.hashes, first = np.unique(self.hashes, return_index=True)
        self.starts, self.ends = self.starts[first], self.ends[first]
        return self

    def spans(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """First n-gram of each word and the one after its last."""
        low = self.starts - 1
        return low, np.maximum(low, self.ends + 2 - order)

    def sums(self, order: int, bits: int, weights: np.ndarray) -> np.ndarray:
        """Sum over each word's n-grams of their ``weights``."""
        buckets = ngram_buckets(self.data, order, bits)
        total = np.zeros(len(buckets) + 1)
        np.cumsum(weights[buckets], out=total[1:])
        low, high = self.spans(order)
        return total[np.minimum(high, len(buckets))] - total[np.minimum(low, len(buckets))]

    def entries(self, order: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Word index and bucket of every n-gram of every word."""
        buckets = ngram_buckets(self.data, order, bits)
        low, high = self.spans(order)
        counts = np.minimum(high, len(buckets)) - np.minimum(low, len(buckets))
        owner = np.repeat(np.arange(len(low)), counts)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        return owner, buckets[np.repeat(low, counts) + offset]
