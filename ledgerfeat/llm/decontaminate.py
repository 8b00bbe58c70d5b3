"""Benchmark passages in documents, found by spaced seeds.

A window of ``SPAN`` words is hashed under fixed masks that each ignore two of four groups of positions. Two windows that
differ in up to ``SUBSTITUTIONS`` words agree under at least one mask, so joining the masked hashes of benchmark items and
documents loses no such pair; every hit is then verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.llm.text import mix, texts_of, word_hashes

SPAN, SUBSTITUTIONS = 13, 2
GROUPS = 4
#: Bits of the filter that keeps document windows without any partner from being shuffled; its size is fixed.
FILTER_BITS = 23
#: Stands for a null item id while items are looked for.
NO_ID = -(1 << 63)
_STEP = np.uint64(0x9FB21C651E98DF25)
#: ASCII punctuation separates words; letters are lower-cased before.
_PLAIN = bytes(32 if not (48 <= i <= 57 or 97 <= i <= 122 or i >= 128) else i for i in range(256))


def words_of(text: str) -> np.ndarray:
    """Hashes of the words of a text: lower case, cut at ASCII characters that are neither letters nor digits."""
    return word_hashes(text.lower().encode("utf-8", "replace").translate(_PLAIN))


def masks(span: int, substitutions: int) -> list[np.ndarray]:
    """Positions that count, one array per mask; every choice of ``substitutions`` positions is ignored by some mask."""
    groups = [g for g in np.array_split(np.arange(span), GROUPS) if len(g)]
    ignored = min(substitutions, len(groups) - 1)
    return [np.sort(np.concatenate([groups[i] for i in kept])) for kept in combinations(range(len(groups)), len(groups) - ignored)]


def allowed(span: int) -> int:
    """Substitutions in a window: ``SUBSTITUTIONS`` in ``SPAN`` words, fewer in shorter items in proportion."""
    return SUBSTITUTIONS * span // SPAN


def masked_hashes(words: np.ndarray, span: int) -> list[np.ndarray]:
    """For each mask the hash of every window of ``span`` words."""
    count = len(words) - span + 1
    out = []
    for number, mask in enumerate(masks(span, allowed(span))):
        total = np.full(count, 64 * span + number, np.uint64)
        for i in mask:
            total = total * _STEP + words[i:i + count]
        out.append(mix(total))
    return out


def windows(words: np.ndarray, span: int, at: np.ndarray) -> np.ndarray:
    """The words of the windows that start at ``at``, one row each."""
    return words[at[:, None] + np.arange(span)]


_SEED_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]


def _rows(ids: list[int], spans: list[int], hashes: list[np.ndarray], held: list[np.ndarray], first: str) -> pa.RecordBatch:
    """Rows (id, span, hash, window words)."""
    counts = [len(h) for h in hashes]
    flat = np.concatenate([h.ravel() for h in held]).view(np.int64) if held else np.zeros(0, np.int64)
    widths = np.repeat(spans, counts) if counts else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(widths)]).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.array(ids, np.int64), counts) if counts else [], pa.int64()),
        pa.array(widths.astype(np.int32), pa.int32()),
        pa.array(np.concatenate(hashes).view(np.int64) if hashes else [], pa.int64()),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))], names=[first, "span", "hash", "held"])


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, spans, hashes, held = [], [], [], []
        for item, text in zip(batch.column("item").to_pylist(), texts_of(batch, "text")):
            words = words_of(text)
            span = min(SPAN, len(words))
            if span:
                for found in masked_hashes(words, span):
                    ids.append(item)
                    spans.append(span)
                    hashes.append(found)
                    held.append(windows(words, span, np.arange(len(found))))
        yield _rows(ids, spans, hashes, held, "item")


def _document_batches(batches: Iterator[pa.RecordBatch], spans: list[int], table: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, widths, hashes, held = [], [], [], []
        for key, text in zip(batch.column("key").to_pylist(), texts_of(batch, "text")):
            words = words_of(text)
            for span in spans:
                if len(words) < span:
                    continue
                for found in masked_hashes(words, span):
                    at = np.flatnonzero(table[found >> np.uint64(64 - FILTER_BITS)])
                    if len(at):
                        ids.append(key)
                        widths.append(span)
                        hashes.append(found[at])
                        held.append(windows(words, span, at))
        yield _rows(ids, widths, hashes, held, "key")


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``key`` (of the row, see `row_key`) and ``items`` (sorted ids of the items found in it) of each contaminated row.

    An item is found when a window of ``SPAN`` words of it (the whole item when shorter) stands in the text with at most
    ``allowed`` of them replaced. Case and ASCII punctuation do not count. Items without words are found nowhere; null
    texts are empty; items with a null id are found but add no id. Empty tables give an empty table. To the driver come
    the different spans (at most ``SPAN``) and a filter of 2**FILTER_BITS bits, whatever the size of either table.
    """
    spark = docs.sparkSession
    source = items.select(F.coalesce(F.col(item_id_col).cast("long"), F.lit(NO_ID)).alias("item"), F.col(item_text_col).alias("text"))
    seeds = source.mapInArrow(_item_batches, "item long, span int, hash long, held array<long>")
    spans = sorted(r["span"] for r in seeds.select("span").distinct().collect())
    table = np.zeros(1 << FILTER_BITS, bool)
    slots = seeds.select(F.shiftrightunsigned("hash", 64 - FILTER_BITS).cast("int").alias("slot")).distinct()
    for row in slots.toLocalIterator():  # at most 2**FILTER_BITS rows
        table[row["slot"]] = True
    packed = spark.sparkContext.broadcast(np.packbits(table))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _document_batches(batches, spans, np.unpackbits(packed.value).astype(bool))

    rows = docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    hits = rows.mapInArrow(find, "key long, span int, hash long, held array<long>")
    tests = seeds.withColumnRenamed("held", "asked")
    equal = "size(filter(zip_with(held, asked, (x, y) -> x = y), e -> e))"
    limits = F.array(*[F.lit(allowed(n)) for n in range(SPAN + 1)])
    pairs = (hits.join(tests, ["span", "hash"]).where(F.col("span") - F.expr(equal) <= F.get(limits, F.col("span"))))
    return pairs.groupBy("key").agg(F.sort_array(F.collect_set(F.when(F.col("item") != NO_ID, F.col("item")))).alias("items"))


def row_key(id_col: str, text_col: str):
    """Number of a row, from its id and text; rows that repeat both are alike."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``contaminated`` and ``items`` for every row of ``docs``; see `contaminated`."""
    found = contaminated(docs, items, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"))
    return rows.join(found, "key", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("items", F.array().cast("array<long>")).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item is found; columns stay as they are."""
    key = "key"
    while key in docs.columns:
        key += "_"
    found = contaminated(docs, items, id_col, text_col).select(F.col("key").alias(key))
    return docs.withColumn(key, row_key(id_col, text_col)).join(found, key, "left_anti").select(docs.columns)
