"""What the n-gram join sends: entries of columns that several rows hold, and whole rows of the documents in lists only."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ledgerfeat.llm import ngram_join
from ledgerfeat.llm.buckets import bucket_filter, passes
from ledgerfeat.llm.stages import Stages
from ledgerfeat.llm.text import shingle_set
from test_corpus_operators import words


def test_entries_of_one_row_are_not_sent(spark):
    texts = [" ".join(words(200, 500 + i, 10**6)) for i in range(200)]
    texts.append(texts[7].replace(texts[7].split()[100], "edited"))
    docs = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "id long, text binary").repartition(4)
    firsts = [set(g[:ngram_join.first_block(len(g), 85)].tolist()) for g in (shingle_set(t, 4) for t in texts)]
    with Stages(spark) as stages:
        bits = ngram_join._shared_columns(docs, sum(map(len, firsts)), stages, 85, 4)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], names=["id", "text"])
    (sent,) = ngram_join._row_batches(iter([batch]), 4, 85, bits)
    columns = sent.column("first").flatten().to_numpy().view("uint64").tolist()
    shared = firsts[7] & firsts[200]
    assert shared and all(columns.count(c) == 2 for c in shared)
    assert len(columns) < 2 * len(shared) + sum(map(len, firsts)) // 10


def test_places_of_columns_left_out_are_used_up():
    """A row keeps as many places in lists as when its own columns are sent along."""
    text = " ".join(words(120, 9, 10**6))
    grams = shingle_set(text, 4)
    first = grams[:ngram_join.first_block(len(grams), 85)]
    bits = bytearray(8 * (1 << 10))
    for c in first[-5:].tolist():
        spot = c & ((1 << 16) - 1)
        bits[spot >> 3] |= 1 << (spot & 7)
    bits = np.frombuffer(bytes(bits), "uint64")
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text.encode()])], names=["id", "text"])
    (sent,) = ngram_join._row_batches(iter([batch]), 4, 85, bits)
    kept, listed = sent.column("first")[0].as_py(), sent.column("listed")[0].as_py()
    assert 5 <= len(kept) < len(first)
    assert listed - len(kept) == len(first) - ngram_join.left_out(len(grams), 85) - len(first)


def test_whole_rows_of_wanted_documents_only(spark):
    ids = spark.createDataFrame([(-(2**63),), (-5,), (77,)], "bucket long")
    bits = bucket_filter(ids)
    batch = pa.RecordBatch.from_arrays([pa.array([-(2**63), 12, -5, 77]), pa.array([b"a b c d e", b"x y", b"a", None])], names=["bucket", "text"])
    (rows,) = ngram_join._full_batches(iter([batch]), 4, bits)
    assert [len(g) for g in rows.column("grams")] == [2, 1, 0]
    assert passes(bits, batch.column("bucket").to_numpy().view("uint64")).tolist() == [True, False, True, True]
