import statistics

import pytest
from builders import months, random_ledger, statements

from conftest import rows_of
from ledgerfeat.operators import payments as pm
from ledgerfeat.operators import skew, summaries, transactions, trends
from ledgerfeat.operators.skew import HotKeys
from ledgerfeat.operators.statements import enrich_statements


def test_sample_moments_match_their_definition(spark):
    values = [1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(1, v) for v in values], "account_id long, x double")
    from ledgerfeat.functions.stats import sample_kurtosis, sample_skewness
    row = df.groupBy("account_id").agg(sample_skewness("x").alias("s"), sample_kurtosis("x").alias("k")).first()
    m, sd = statistics.mean(values), statistics.stdev(values)
    assert row.s == pytest.approx(sum((v - m) ** 3 for v in values) / 4 / sd ** 3)
    assert row.k == pytest.approx(sum((v - m) ** 4 for v in values) / 4 / sd ** 4 - 3)


def test_constant_and_single_rows_have_no_moments_or_slope(spark):
    enriched = enrich_statements(statements(spark, months(1, 3) + months(2, 1, first_id=10)))
    rows = {r.account_id: r for r in summaries.summary_annual(enriched).collect()}
    assert rows[1].skewness_total_balance is None and rows[1].kurtosis_total_balance is None
    assert rows[2].sd_total_balance is None
    assert {r.account_id: r.trend_credit_ratio for r in trends.trend_ratios(enriched).collect()} == {1: 0.0, 2: None}


def test_number_of_measures(spark):
    enriched = enrich_statements(statements(spark, months(1, 14)))
    assert len(summaries.summary_quarter(enriched).columns) == 1 + 5 * 62
    assert len(summaries.summary_annual(enriched).columns) == 1 + 62 + 1 + 1 + 14 + 6 + 6


def test_extreme_flags_and_deltas(spark):
    rows = months(1, 3)
    rows = [(a, i, d, t, c, l, q) for (a, i, d, _, c, l, q), t in zip(rows, [100, 50, 200])]
    row = summaries.summary_annual(enrich_statements(statements(spark, rows))).first()
    assert row.at_new_max_credit_ratio == 1 and row.at_new_min_credit_ratio == 0
    assert row.at_new_max_credit_limit == 0 and row.annual_delta_total_balance == 100
    assert row.last_on_max_credit_ratio == 1.0


def test_quarter_ratio_threshold(spark):
    df = spark.createDataFrame(
        [(0.5, 2.0), (1.5, 2.0), (2.0, 1.0), (1.0, None)], "mean_credit_ratio_Q4 double, mean_credit_ratio_Q1 double")
    got = [r[0] for r in df.select(summaries.quarter_ratio()).collect()]
    assert got == [0.25, 0.75, 1.0, None]
    assert df.select(summaries.quarter_ratio(0.5)).collect()[2][0] == 2.0


HOT = [HotKeys((1, 3)), HotKeys(every=True)]


@pytest.mark.parametrize("hot", HOT)
@pytest.mark.parametrize("summary", [summaries.summary_quarter, summaries.summary_semester, summaries.summary_annual])
def test_hot_accounts_give_the_same_summaries(spark, summary, hot):
    enriched = enrich_statements(random_ledger(spark).statements)
    plain = summary(enriched)
    assert rows_of(summary(enriched, hot).select(*plain.columns)) == rows_of(plain)


@pytest.mark.parametrize("hot", HOT)
def test_hot_accounts_give_the_same_transaction_summaries(spark, hot):
    ledger = random_ledger(spark)
    enriched = enrich_statements(ledger.statements)
    plain = transactions.transactions_annual(ledger.transactions)
    assert rows_of(transactions.transactions_annual(ledger.transactions, hot).select(*plain.columns)) == rows_of(plain)
    placed = transactions.transactions_in_quarters(ledger.transactions, enriched)
    split = transactions.transactions_in_quarters(ledger.transactions, enriched, hot)
    assert rows_of(split.select(*placed.columns)) == rows_of(placed)
    plain = transactions.transactions_quarter(placed)
    assert rows_of(transactions.transactions_quarter(placed, hot).select(*plain.columns)) == rows_of(plain)


def test_hot_keys_are_found_by_size(spark):
    ledger = random_ledger(spark)
    assert skew.hot_keys(ledger.statements, "account_id", floor=300) == HotKeys((1,))
    found = ledger.with_hot_accounts(floor=300)
    assert found.hot_statements == HotKeys((1,)) and found.hot_transactions == HotKeys((1,))
    assert not ledger.with_hot_accounts().hot_statements
    assert skew.hot_keys(ledger.statements, "account_id", floor=1, at_most=3) == HotKeys(every=True)


def test_large_group_quantiles(spark):
    df = spark.range(0, 1001).selectExpr("id % 3 AS g", "CAST(id % 97 AS DOUBLE) AS x")
    got = skew.large_group_quantiles(df, ["g"], "x", {"p25": 0.25, "p75": 0.75, "top": 1.0})
    want = df.groupBy("g").agg(*[
        __import__("pyspark.sql.functions", fromlist=["expr"]).expr(f"percentile(x, {p}D) AS {n}")
        for n, p in {"p25": 0.25, "p75": 0.75, "top": 1.0}.items()])
    assert rows_of(got) == rows_of(want)


def test_distributed_ntile_and_running_totals(spark):
    df = spark.range(0, 1003).selectExpr("id", "id % 10 AS v", "id % 3 AS g")
    df.createOrReplaceTempView("nt")
    for buckets in (10, 7):
        got = skew.distributed_ntile(df, ["v", "id"], buckets, "b")
        want = spark.sql(f"SELECT id, v, g, ntile({buckets}) OVER (ORDER BY v, id) AS b FROM nt")
        assert rows_of(got) == rows_of(want)
    few = spark.range(0, 3).selectExpr("id")
    assert [r.b for r in sorted(skew.distributed_ntile(few, ["id"], 10, "b").collect())] == [1, 2, 3]
    from pyspark.sql import functions as F
    got = skew.running_totals(df, ["v", "id"], {"t": F.col("v")}, within=["g"])
    want = spark.sql("SELECT id, v, g, sum(v) OVER (PARTITION BY g ORDER BY v, id) AS t FROM nt")
    assert rows_of(got) == rows_of(want)


def test_trend_of_share_paid_uses_statement_positions(spark):
    ledger = random_ledger(spark)
    paid = pm.pct_paid(enrich_statements(ledger.statements), ledger.payments)
    slopes = {r.account_id: r.trend_pct_paid for r in trends.trend_pct_paid(paid).collect()}
    rows = sorted((r.rank_from_last, r.pct_paid) for r in paid.filter("account_id = 1 AND is_last_statement = 0").collect())
    ys = [y for _, y in reversed(rows)]
    assert slopes[1] == pytest.approx(statistics.linear_regression(range(len(ys)), ys).slope)
