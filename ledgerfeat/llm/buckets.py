"""Hashed buckets: counted in parts, and a bit filter over those that are wanted.

A bucket holds at least what is looked for, so a filter lets more through than wanted but never less.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most bits of a filter (32 MB).
FILTER_BITS = 1 << 28


def grouped(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their weights, and one place of each."""
    order = np.argsort(keys)
    ordered = keys[order]
    heads = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[:len(ordered)])
    return ordered[heads], np.add.reduceat(weights[order], heads) if len(heads) else weights[:0], order[heads]


def packed_counts(buckets: np.ndarray, sums: np.ndarray, low: int, kind: type = np.int64) -> pa.RecordBatch:
    """Ordered distinct buckets and their counts, a row per part: the bits above ``low``, arrays of the other bits and of counts."""
    shift = np.uint64(low)
    parts, starts = np.unique(buckets >> shift, return_index=True)
    rest = (buckets & ((np.uint64(1) << shift) - np.uint64(1))).astype(np.uint32)
    sums, ends = sums.astype(kind), np.append(starts[1:], len(buckets)).tolist()
    return pa.RecordBatch.from_arrays(
        [pa.array(parts.astype(np.int64)), pa.array([rest[a:b].tobytes() for a, b in zip(starts.tolist(), ends)], pa.binary()),
         pa.array([sums[a:b].tobytes() for a, b in zip(starts.tolist(), ends)], pa.binary())], names=["part", "buckets", "counts"])


def full_buckets(part: pa.Table, least: int, low: int, kind: type = np.int64) -> pa.Table:
    """The buckets of a part whose counts add up to at least ``least``."""
    keys = np.frombuffer(b"".join(part.column("buckets").to_pylist()), np.uint32)
    sums = np.frombuffer(b"".join(part.column("counts").to_pylist()), kind).astype(np.int64)
    buckets, sums, _ = grouped(keys, sums)
    first = part.column("part")[0].as_py() << low
    return pa.table({"bucket": pa.array(buckets[sums >= least].astype(np.int64) + first)})


def bucket_filter(buckets: DataFrame, most: int = FILTER_BITS) -> np.ndarray:
    """Bit filter over the column ``bucket``; at most ``most`` bits reach the driver, whatever the input."""
    wanted = max(1 << 10, 16 * buckets.count())
    size = min(most, 1 << (wanted - 1).bit_length())
    spot = F.col("bucket").bitwiseAND(size - 1)
    words = (buckets.select(F.shiftright(spot, 6).alias("word"), F.expr("shiftleft(1L, CAST(bucket & 63 AS INT))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    bits = np.zeros(size // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return bits.view(np.uint64)


def passes(bits: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """Whether the filter has the bucket of each of ``buckets`` (unsigned)."""
    spot = buckets & np.uint64(len(bits) * 64 - 1)
    return (bits[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1
