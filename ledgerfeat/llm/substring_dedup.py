"""Repeated passages removed by content-defined chunking with a gear rolling hash.

A gear hash rolls over the words of a text. A chunk starts where the hash is the least of its surroundings, which depends
on a few words only: an insertion moves no boundary beyond its own neighbourhood, so a passage is cut alike wherever it
stands. A window of ``WINDOW`` words can only be repeated if every pair of neighbouring chunks well inside it has a digest
that occurs in several texts; the hashes of those windows are compared, and of every window in several documents the
first one keeps it. Documents of equal text are seen at once: all but the first lose all their windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerfeat.llm.text import mix, texts_of, word_bounds, span_hashes

#: A passage of this many words that occurs in several documents is repeated.
WINDOW = 50
#: Words in the gear hash, and how far to either side a boundary's hash is the least. Chunks are 2 * RADIUS + 1 words on
#: average and RADIUS + 1 at least.
GEAR_WORDS, RADIUS = 4, 3
#: ``PAIR`` neighbouring chunks from ``INSIDE`` words after the start of a window to ``RADIUS`` + 1 words before its end is the same wherever the
#: window stands: all words that their boundaries depend on lie in the window.
INSIDE = RADIUS + GEAR_WORDS - 1
PAIR = 2
ROOM = WINDOW - INSIDE - RADIUS - 1
_STEP = 0xA24BAED4963EE407
_STEP_BACK = pow(_STEP, -1, 1 << 64)


def word_array(text: str) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Bytes of a text, start of each word (and the end of the text), hash of each word."""
    data = text.encode("utf-8", "replace")
    starts, ends = word_bounds(data)
    return data, np.append(starts, len(data)), span_hashes(data, starts, ends)


def cut_points(words: np.ndarray) -> np.ndarray:
    """First words of the chunks of a text: 0 and every local least of the gear hash."""
    gear = np.zeros(len(words), np.uint64)
    for j in range(min(GEAR_WORDS, len(words))):
        gear[j:] += words[:len(words) - j] << np.uint64(j)
    key = np.full(len(words) + 2 * RADIUS, np.iinfo(np.uint64).max, np.uint64)
    key[RADIUS:RADIUS + len(words)] = mix(gear)
    own = key[RADIUS:RADIUS + len(words)]
    least = np.ones(len(words), bool)
    for j in range(1, RADIUS + 1):
        least &= own < key[RADIUS - j:RADIUS - j + len(words)]
        least &= own <= key[RADIUS + j:RADIUS + j + len(words)]
    return np.union1d([0], np.flatnonzero(least))


def units(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words, and words after the last, of the stretches of ``PAIR`` neighbouring chunks (fewer at the end)."""
    cuts = cut_points(words)
    return cuts, np.append(cuts[PAIR:], np.full(min(PAIR, len(cuts)), len(words)))


def _powers(count: int, step: int) -> np.ndarray:
    factors = np.full(count, step, np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def stretch_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the words from each start to its end."""
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * _powers(len(words), _STEP), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * _powers(len(words) + 1, _STEP_BACK)[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, digests, starts, loose = [], [], [], []
        for key, text in zip(batch.column("key").to_pylist(), texts_of(batch, "text")):
            words = word_array(text)[2]
            if len(words) < WINDOW:
                continue
            cuts, ends = units(words)
            keys.append(np.full(len(cuts), key, np.int64))
            digests.append(stretch_hashes(words, cuts, ends).view(np.int64))
            starts.append(cuts)
            # Where a pair and the chunk before it are long, a window fits that has no pair well inside.
            loose.append(ends - np.append(0, cuts[:-1]) > ROOM)
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (keys, digests, starts, loose)]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(bool) if t == pa.bool_() else c, t) for c, t in zip(columns, types)],
                                         names=["key", "digest", "start", "loose"])


def possible_windows(cuts: np.ndarray, ends: np.ndarray, count: int, repeated: np.ndarray) -> np.ndarray:
    """First words of the windows whose inner pairs of chunks are all repeated, among ``count`` words."""
    at = np.arange(count - WINDOW + 1)
    single = np.concatenate([[0], np.cumsum(~repeated)])
    first = np.searchsorted(cuts, at + INSIDE)
    last = np.searchsorted(ends, at + INSIDE + ROOM, "right")
    return at[single[np.maximum(first, last)] == single[first]]


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys, places, hashes = [], [], [], []
        for doc, key, text, chunks in zip(batch.column("doc").to_pylist(), batch.column("key").to_pylist(),
                                          texts_of(batch, "text"), batch.column("chunks").to_pylist()):
            words = word_array(text)[2]
            cuts, ends = units(words)
            at = possible_windows(cuts, ends, len(words), np.isin(cuts, chunks))
            keys.append(np.full(len(at), key, np.int64))
            ids += [doc] * len(at)
            places.append(at)
            hashes.append(stretch_hashes(words, at, at + WINDOW).view(np.int64))
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (keys, places, hashes)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())],
            names=["doc", "key", "place", "hash"])


def _cut(text: str, places: list[int]) -> tuple[str, int]:
    """The text without the words of the windows at ``places`` (and the white space after them), and their number."""
    data, starts, words = word_array(text)
    gone = np.zeros(len(words) + 1, np.int64)
    at = np.asarray(places)
    np.add.at(gone, at, 1)
    np.add.at(gone, at + WINDOW, -1)
    gone = np.cumsum(gone[:-1]) > 0
    change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
    kept, last = [], 0
    for a, b in zip(change[0::2], change[1::2]):
        kept.append(data[last:starts[a]])
        last = starts[b]
    kept.append(data[last:])
    return b"".join(kept).decode("utf-8", "replace"), int(gone.sum())


def _cut_batches(batches: Iterator[pa.RecordBatch], text_col: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, removed = batch.column(text_col).to_pylist(), []
        for i, (places, copy) in enumerate(zip(batch.column("places").to_pylist(), batch.column("copy").to_pylist())):
            count = 0
            if copy and texts[i]:
                places = np.arange(max(0, len(word_array(texts[i])[2]) - WINDOW + 1))
            if places is not None and len(places):
                texts[i], count = _cut(texts[i], places)
            removed.append(count)
        columns = [batch.column(i) for i in range(batch.num_columns - 2)]
        columns[text_col] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays([*columns, pa.array(removed, pa.int64())],
                                         names=[*batch.schema.names[:-2], "removed_words"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut from its texts, all its columns in order and ``removed_words`` (last).

    A word goes when it lies in a stretch of ``WINDOW`` words that also occurs in a document with a smaller id. White
    space after a removed word goes with it. Repeats inside one document stay; rows that share an id count as one
    document, and so do rows with a null id, which comes last. Null texts stay null; short and empty texts stay as they
    are. A column called ``removed_words`` in the input is replaced. An empty table gives an empty table. Nothing of
    the documents reaches the driver; a passage of a third of all documents is counted before it is shuffled.
    """
    names = [c for c in docs.columns if c != "removed_words"]
    docs = docs.select(names)
    # Names of our own, so that input columns of any name do not clash.
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc, text = F.col(f"c{names.index(id_col)}").cast("long"), F.col(f"c{names.index(text_col)}")
    keyed = inner.withColumns({"key": F.xxhash64(text), "doc": F.coalesce(doc, F.lit((1 << 63) - 1))})
    chunks = keyed.select("key", text.alias("text")).mapInArrow(
        _chunk_batches, "key long, digest long, start int, loose boolean")
    spread = (chunks.groupBy("digest").agg(F.min("key").alias("low"), F.max("key").alias("high"))
              .where("low < high").select("digest", F.lit(True).alias("repeated")))
    found = (chunks.join(spread, "digest", "left").where("repeated OR loose").groupBy("key")
             .agg(F.collect_list(F.when(F.col("repeated"), F.col("start"))).alias("chunks")))  # of one document
    # All columns are read here although few are needed: the last join then reads the same shuffled rows.
    near = keyed.join(found, "key").withColumn("text", text)
    # One of the documents of equal text stands for them.
    first = F.row_number().over(Window.partitionBy("key").orderBy("doc"))
    windows = (near.withColumn("first", first).where("first = 1")
               .mapInArrow(_window_batches, "doc long, key long, place int, hash long"))
    firsts = (windows.groupBy("hash").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
              .where("low < high").select("hash", "low"))
    later = (windows.join(firsts, "hash").where("doc > low").groupBy("key")
             .agg(F.array_sort(F.collect_set("place")).alias("places")))  # windows of one document
    copies = (keyed.groupBy("key").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high")
              .select("key", "low"))
    place = names.index(text_col)
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields)) + ", removed_words bigint"
    cut = (keyed.join(later, "key", "left").join(copies, "key", "left")
           .select(*inner.columns, "places", F.coalesce(F.col("doc") > F.col("low"), F.lit(False)).alias("copy"))
           .mapInArrow(lambda it: _cut_batches(it, place), schema))
    return cut.toDF(*names, "removed_words")
