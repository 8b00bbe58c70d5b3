"""Work by account: spread once, staged in buckets, in as many tasks as the input asks for."""

import re
from pathlib import Path

import pytest
from builders import random_ledger
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import rows_of
from ledgerfeat.operators import summaries, transactions
from ledgerfeat.operators.skew import NONE, HotKeys
from ledgerfeat.plans.features import FeaturePlan
from ledgerfeat.session import account_stage, file_stage
from ledgerfeat.sources import orders, readers


def shuffled_by(df):
    return set(re.findall(r"hashpartitioning\(([a-z_]+)#\d+L?(?:, ([a-z_]+)#\d+)?", df._jdf.queryExecution().executedPlan().toString()))


@pytest.mark.parametrize("make", [summaries.summary_annual, summaries.summary_semester, summaries.summary_quarter])
def test_summaries_shuffle_statements_only(spark, make):
    assert shuffled_by(make(FeaturePlan(random_ledger(spark)).enriched)) == {("account_id", "")}


@pytest.mark.parametrize("hot", [NONE, HotKeys((1, 2)), HotKeys(every=True)])
def test_profile_spread_by_account_is_the_same(spark, hot):
    rows = random_ledger(spark).transactions
    plain = transactions.category_profile(rows, ["city", "category"])
    spread = transactions.category_profile(rows, ["city", "category"], hot=hot, parts=3)
    assert rows_of(spread) == rows_of(plain)
    assert hot or shuffled_by(spread) == {("account_id", "")}


def test_staged_tables_meet_without_a_shuffle(spark):
    stage = account_stage(spark, 3)
    left = stage(spark.range(50).select(F.col("id").alias("account_id"), (F.col("id") * 2).alias("x")))
    right = stage(spark.range(40).select(F.col("id").alias("account_id"), (F.col("id") * 3).alias("y")))
    joined = left.hint("merge").join(right, "account_id", "left")
    assert not shuffled_by(joined) and joined.agg(F.sum("x"), F.sum("y")).first() == (2450, 2340)


def test_tasks_grow_with_accounts_and_statements(spark, monkeypatch):
    ledger = random_ledger(spark)
    accounts, statements = ledger.accounts.count(), ledger.statements.count()
    monkeypatch.setattr(readers, "STATEMENTS_PER_TASK", 5)
    assert ledger.tasks() == -(-statements // 5)
    assert FeaturePlan(ledger).enriched.rdd.getNumPartitions() == -(-statements // 5)
    monkeypatch.setattr(readers, "STATEMENTS_PER_TASK", 10**6)
    monkeypatch.setattr(readers, "ACCOUNTS_PER_TASK", 1)
    assert ledger.tasks() == max(accounts, spark.sparkContext.defaultParallelism)


def test_counted_transactions_find_the_same_hot_accounts(spark):
    ledger = orders.load_orders(spark, "/root/testdata/sf0.001")
    whole = ledger.transactions.groupBy("account_id").agg(F.count(F.lit(1)).alias("rows"))
    assert rows_of(ledger.transaction_counts.groupBy("account_id").agg(F.sum("rows").alias("rows"))) == rows_of(whole)
    floor = whole.agg(F.max("rows")).first()[0]
    hot = ledger.with_hot_accounts(floor=floor).hot_transactions
    assert hot.keys == tuple(sorted(r[0] for r in whole.filter(F.col("rows") >= floor).collect()))


def test_orders_are_counted_in_as_many_tasks_as_the_input_asks_for(spark, monkeypatch):
    monkeypatch.setattr(orders, "ORDERS_PER_TASK", 40)
    counts = orders.transaction_counts(spark, "/root/testdata/sf0.001")
    tasks = -(-spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count() // 40)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"hashpartitioning\([lo]_orderkey#\d+L?, (\d+)\)", plan)) == {str(tasks)}


def test_levels_are_made_in_as_many_tasks_as_the_input_asks_for(spark, monkeypatch):
    ledger = random_ledger(spark)
    monkeypatch.setattr(readers, "ACCOUNTS_PER_TASK", 1)
    tasks = max(ledger.accounts.count(), spark.sparkContext.defaultParallelism)
    assert entry.levels_of(ledger).rdd.getNumPartitions() == tasks


def test_stages_are_written_with_the_stronger_compression(spark):
    rows = spark.range(50).withColumnRenamed("id", "account_id")
    for staged in (account_stage(spark, 3)(rows), file_stage(rows)):
        files = staged.inputFiles()
        assert files and all(f.endswith(".zstd.parquet") for f in files) and staged.count() == 50


def test_staged_tables_go_after_their_last_reader(spark):
    plan = FeaturePlan.staged(random_ledger(spark))
    families = plan.staged_families()
    shared, kept = (Path(t.folder.removeprefix("file:")) for t in (plan._shared_tables, plan._family_tables))
    assert not shared.exists() and kept.exists()
    assert all(f.count() for f in families)
    assert plan.enriched.count() == plan.ledger.statements.count()  # made again
    plan.drop_families()
    assert not kept.exists()
