"""Ranked lexical search by scanning documents with an Aho-Corasick automaton of all query terms.

There is no index of the documents. The terms of the items become one automaton whose patterns are guarded by a blank on both
sides, so a pattern meets whole terms only; texts are scanned with everything between terms turned into blanks. A scan gives
the number of occurrences of every term in a text at once, and each term leads to the items that hold it.

Items are taken in blocks of about ``BLOCK_BYTES`` of text: that bounds the automaton that goes to the executors. Each block
scans all documents twice: once for the number of documents and of terms, and the documents that hold each term; once for
the scores. A task keeps ``top`` documents per item, and only those meet in the last ordering.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bytes of item text in a block, scores held at once by a task, and entries between two prunings of its best documents.
BLOCK_BYTES, SCORES, POOL = 1 << 20, 1 << 20, 1 << 16
#: Fixed values of the ranking: saturation and length parameters in hundredths, and the scale of a term's share.
SATURATION, LENGTH_PERCENT, SCALE = 12, 25, 1_000_000_000

_BLANKED = bytearray(range(256))
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _BLANKED[_low:_high + 1] = b" " * (_high - _low + 1)
_BLANKED = bytes(_BLANKED)


def blanked(text: bytes | None) -> bytes:
    """The terms of a text, A-Z lower-cased, with blanks for everything else and one at both ends."""
    return b" " + (text or b"").lower().translate(_BLANKED) + b" "


def item_terms(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of items, and as a sparse matrix by term: where its entries start, their items and occurrences."""
    held = [Counter(blanked(t).split()) for t in texts]
    terms = sorted(set().union(*held)) if held else []
    place = {t: i for i, t in enumerate(terms)}
    entries = sorted((place[t], item, times) for item, counts in enumerate(held) for t, times in counts.items())
    found = np.array(entries, np.int64).reshape(-1, 3)
    return terms, np.searchsorted(found[:, 0], np.arange(len(terms) + 1)), found[:, 1].copy(), found[:, 2].copy()


class Scanner:
    """The automaton of a block's terms with their items."""

    def __init__(self, terms: list[bytes], starts: np.ndarray, items: np.ndarray, times: np.ndarray) -> None:
        self.terms, self.starts, self.items, self.times = terms, starts, items, times
        self.automaton = ahocorasick.Automaton()
        for i, term in enumerate(terms):
            self.automaton.add_word(f" {term.decode('utf-8', 'replace')} ", i)
        self.automaton.make_automaton()

    def scan(self, text: bytes | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms in a text, and the block's terms in it with their occurrences."""
        data = blanked(text)
        blank = np.frombuffer(data, np.uint8) == 0x20
        count = int(np.count_nonzero(blank[:-1] & ~blank[1:]))
        if not count or not self.terms:
            return count, np.zeros(0, np.int64), np.zeros(0, np.int64)
        tf = Counter(i for _, i in self.automaton.iter(data.decode("utf-8", "replace")))
        return count, np.fromiter(tf.keys(), np.int64, len(tf)), np.fromiter(tf.values(), np.int64, len(tf))


def _count_batches(batches: Iterator[pa.RecordBatch], terms) -> Iterator[pa.RecordBatch]:
    """Documents that hold each term; -1 counts documents with terms and -2 their terms."""
    block = Scanner(*terms.value)
    df, documents, total = np.zeros(len(block.terms), np.int64), 0, 0
    for batch in batches:
        for text in batch.column("text"):
            count, found, _ = block.scan(text.as_py())
            documents += count > 0
            total += count
            df[found] += 1
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(held, [-1, -2])), pa.array(np.append(df[held], [documents, total]))],
                                     names=["term", "count"])


class _Best:
    """The best documents of every item among those offered."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top = top
        self.floor = np.ones(n_items, np.int64)
        self.pool: list[np.ndarray] = []
        self.waiting = 0

    def offer(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """``scores`` of documents (rows) for items (columns)."""
        doc, item = np.nonzero(scores >= self.floor)
        self.pool.append(np.stack([item, -scores[doc, item], missing[doc], ids[doc]]))
        self.waiting += len(doc)
        if self.waiting > POOL:
            self.prune()

    def prune(self) -> np.ndarray:
        rows = np.concatenate(self.pool, axis=1) if self.pool else np.zeros((4, 0), np.int64)
        rows = rows[:, np.lexsort(rows[::-1])]
        starts = np.searchsorted(rows[0], rows[0])
        rows = rows[:, np.arange(rows.shape[1]) - starts < self.top]
        items, counts = np.unique(rows[0], return_counts=True)
        full = counts == self.top
        self.floor[items[full]] = -rows[1, np.cumsum(counts)[full] - 1]
        self.pool, self.waiting = [rows], 0
        return rows


def _score_batches(batches: Iterator[pa.RecordBatch], terms, weights, n_items: int, documents: int, total: int, top: int) -> Iterator[pa.RecordBatch]:
    block, w = Scanner(*terms.value), weights.value
    best = _Best(n_items, top)
    room = max(1, SCORES // max(1, n_items))
    for batch in batches:
        ids = batch.column("doc_id")
        missing = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = ids.fill_null(0).to_numpy()
        for low in range(0, batch.num_rows, room):
            scores = np.zeros((min(room, batch.num_rows - low), n_items), np.int64)
            for row, text in enumerate(batch.column("text").slice(low, room)):
                count, found, tf = block.scan(text.as_py())
                if not len(found):
                    continue
                m = 100 - LENGTH_PERCENT + (LENGTH_PERCENT * count * documents) // total
                gain = w[found] * ((SCALE * tf) // (1000 * tf + SATURATION * m))
                sizes = block.starts[found + 1] - block.starts[found]
                at = np.repeat(block.starts[found] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                np.add.at(scores[row], block.items[at], np.repeat(gain, sizes) * block.times[at])
            best.offer(scores, ids[low:low + room], missing[low:low + room])
    item, score, gone, doc = best.prune()
    yield pa.RecordBatch.from_arrays(
        [pa.array(item), pa.array(doc, pa.int64(), mask=gone.astype(bool)), pa.array(-score)], names=["item", "doc_id", "score"])


def term_weight(documents: int, df: int) -> int:
    """floor(1000 * ln((2N + 2) / (2df + 1)))."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _ranked_block(docs: DataFrame, items: list[tuple[int | None, bytes | None]], top: int) -> DataFrame:
    spark = docs.sparkSession
    block = item_terms([text for _, text in items])
    terms = spark.sparkContext.broadcast(block)
    counts = (docs.select("text").mapInArrow(lambda it: _count_batches(it, terms), "term long, count long")
              .groupBy("term").agg(F.sum("count").alias("count")).toArrow())  # a row per term of the block
    counts = dict(zip(counts.column("term").to_pylist(), counts.column("count").to_pylist()))
    documents, total = counts.get(-1, 0), counts.get(-2, 0)
    weights = spark.sparkContext.broadcast(
        np.array([term_weight(documents, counts.get(i, 0)) for i in range(len(block[0]))], np.int64))
    found = docs.mapInArrow(lambda it: _score_batches(it, terms, weights, len(items), documents, total, top),
                            "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", top: int = 20) -> DataFrame:
    """The ``top`` documents of every item: ``item_id``, ``rank``, ``doc_id`` and ``score``.

    Terms are the longest runs of digits, letters and bytes above 0x7F, A-Z lower-cased; a null text has none. A document
    needs a score above 0. Equal scores rank by id, a null id last. Every row of ``docs`` is a document and every row of
    ``items`` an item of its own, also when ids repeat; an item without terms has no rows. Other columns are not read. Empty
    tables give an empty table. Texts are scanned whole. An item longer than a block is a block of its own.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("binary").alias("text"))
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).toArrow()
        found = list(zip(rows.column("item_id").to_pylist(), rows.column("text").to_pylist()))
        if found or (out is None and b == blocks - 1):
            part = _ranked_block(docs, found, top)
            out = part if out is None else out.unionByName(part)
    return out
