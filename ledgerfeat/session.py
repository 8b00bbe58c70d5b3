"""Session helpers: configuration and the shared checkpoint folder."""

from __future__ import annotations

import itertools
import tempfile
from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "ledgerfeat", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints: the cluster's own setting, or a scratch folder in local mode only."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="ledgerfeat-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def file_stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as Parquet in the shared checkpoint folder; later steps read the columns they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/stage-{uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class StageTables:
    """Stages of a job, kept in a database of their own in the checkpoint folder until ``drop`` removes them with their files.

    ``by_account`` writes as ``account_stage`` says, ``plain`` without buckets. After ``drop`` further tables can be written.
    """

    def __init__(self, spark: SparkSession, buckets: int, key: str = "account_id"):
        self.spark, self.buckets, self.key = spark, buckets, key
        self.name = f"ledgerfeat_stages_{uuid4().hex}"
        self.folder = f"{ensure_checkpoint_dir(spark)}/{self.name}"

    def _write(self, df: DataFrame, bucketed: bool) -> DataFrame:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.name} LOCATION '{self.folder}'")
        name = f"{self.name}.t_{uuid4().hex}"
        writer = (df.repartition(self.buckets, self.key).write.bucketBy(self.buckets, self.key).sortBy(self.key)
                  if bucketed else df.write)
        writer.format("parquet").option("compression", "zstd").saveAsTable(name)
        return self.spark.table(name)

    def by_account(self, df: DataFrame) -> DataFrame:
        return self._write(df, True)

    def plain(self, df: DataFrame) -> DataFrame:
        return self._write(df, False)

    def drop(self) -> None:
        self.spark.sql(f"DROP DATABASE IF EXISTS {self.name} CASCADE")


def account_stage(spark: SparkSession, buckets: int, key: str = "account_id") -> Callable[[DataFrame], DataFrame]:
    """A stage of Parquet tables in the checkpoint folder, bucketed by ``key``, one file a bucket.

    Steps by account read their buckets without a shuffle. What is spread over ``buckets`` tasks by account already is
    written as it lies. Not for rows of hot accounts: one bucket would hold all of such an account.
    """
    return StageTables(spark, buckets, key).by_account


def bucketed_stage(spark: SparkSession, prefix: str, buckets: int, key: str = "account_id") -> Callable[[DataFrame], DataFrame]:
    """A stage that writes tables bucketed and sorted by ``key`` to the warehouse.

    Aggregations and joins by the key then read their buckets without a shuffle, and each reader
    scans only its columns. Not for inputs with hot accounts: one bucket would hold all of such an account.
    """
    counter = itertools.count(1)

    def stage(df: DataFrame) -> DataFrame:
        name = f"{prefix}_{next(counter)}"
        df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(name)
        return spark.table(name)

    return stage
