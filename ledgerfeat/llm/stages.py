"""Intermediate tables of an operator as compressed Parquet in the shared checkpoint folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerfeat.session import ensure_checkpoint_dir

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


class Stages:
    """Writes tables that are read more than once, and removes them after their last reader.

    A written table cuts the lineage: a lost executor costs the tasks it ran, not the stages before. Within a ``with`` block
    `write` stores a table, `drop` removes one early and `last` stores the result; on leaving all but the result go. Tables
    live in a database of their own inside the folder of ``spark.checkpoint.dir``.

    ``batch_rows`` bounds the rows of an Arrow batch inside the block: a batch of long texts or sets is held several times over,
    by the JVM and by its Python worker, outside the heap.
    """

    def __init__(self, spark: SparkSession, batch_rows: int | None = None) -> None:
        self.spark = spark
        self.batch_rows = batch_rows
        self.name = f"stages_{uuid.uuid4().hex}"
        self.folder = f"{ensure_checkpoint_dir(spark)}/{self.name}"
        spark.sql(f"CREATE DATABASE {self.name} LOCATION '{self.folder}'")
        self.count = 0

    @property
    def buckets(self) -> int:
        """Buckets of a table with a key: the session's shuffle partitions."""
        return int(self.spark.conf.get("spark.sql.shuffle.partitions"))

    def write(self, df: DataFrame, key: str | None = None) -> DataFrame:
        """``df`` read back from its table; with a ``key`` bucketed by it, so that joins by the key do not shuffle it."""
        self.count += 1
        name = f"{self.name}.t{self.count}"
        writer = df.write.option("compression", "zstd")
        if key:
            writer = writer.bucketBy(self.buckets, key).sortBy(key)
        writer.saveAsTable(name, format="parquet")
        return self.spark.table(name)

    def last(self, df: DataFrame) -> DataFrame:
        """The result, which stays when the other tables go."""
        path = f"{self.folder}_result"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Stages:
        self.before = self.spark.conf.get(BATCH_ROWS)
        if self.batch_rows:
            self.spark.conf.set(BATCH_ROWS, min(self.batch_rows, int(self.before)) if int(self.before) > 0 else self.batch_rows)
        return self

    def __exit__(self, *_) -> None:
        self.spark.conf.set(BATCH_ROWS, self.before)
        self.spark.sql(f"DROP DATABASE {self.name} CASCADE")
