"""What a Python worker holds at once does not follow the size of Spark's default Arrow batches."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa

from ledgerfeat.llm import collocations, near_dedup
from ledgerfeat.llm.stages import BATCH_ROWS, Stages


def chunk_batches(rng, batches, rows):
    for _ in range(batches):
        chunks = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(6)).encode() + b"\n" for _ in range(rows)]
        yield pa.RecordBatch.from_arrays([pa.array(["en"] * rows), pa.array([4] * rows, pa.int32()), pa.array(chunks, pa.binary()),
                                          pa.array([1] * rows, pa.int64())], names=["lang", "own", "chunk", "freq"])


def test_chunks_are_counted_in_small_slices():
    tracemalloc.start()
    rows = sum(b.num_rows for b in collocations._bucket_batches(chunk_batches(random.Random(1), 100, 2000), 3, 30, 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows and peak < 120e6  # 272 MB with slices of 4 MB


def test_stages_bound_arrow_batches(spark):
    before = spark.conf.get(BATCH_ROWS)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], names=["rows"])
    with Stages(spark, 100) as stages:
        seen = stages.write(spark.range(0, 1000, 1, 1).mapInArrow(sizes, "rows long"))
        assert [r.rows for r in seen.collect()] == [100] * 10
    assert spark.conf.get(BATCH_ROWS) == before


def test_near_duplicates_bound_arrow_batches(spark, monkeypatch):
    seen, write = [], Stages.write
    monkeypatch.setattr(Stages, "write", lambda self, df: (seen.append(int(self.spark.conf.get(BATCH_ROWS))), write(self, df))[1])
    docs = spark.createDataFrame([(i, f"a b c d e f g h i {i % 3}") for i in range(9)], "doc_id long, text string")
    assert near_dedup.near_duplicate_groups(docs).where("kept").count() == 3
    assert seen and max(seen) <= 512
