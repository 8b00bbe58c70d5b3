from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from builders import accounts, months, payments, random_ledger, statements, transactions

from conftest import rows_of
from ledgerfeat.operators import statements as st
from ledgerfeat.operators.skew import HotKeys
from ledgerfeat.plans.features import FeaturePlan
from ledgerfeat.sources.readers import Ledger


def test_balance_below_cash_and_null_balance(spark):
    rows = [(1, 1, date(2017, 1, 1), "0.00", "1.05", 100, 0), (1, 2, date(2017, 2, 1), None, 5, 100, 0)]
    out = {r.statement_id: r for r in st.enrich_statements(statements(spark, rows)).collect()}
    assert float(out[1].total_balance) == 1.05 and float(out[1].raw_total_balance) == 0.0
    assert out[2].total_balance is None and out[2].credit_ratio is None


def test_overflow_ranks_and_buckets(spark):
    out = {r.rank_from_last: (r.q, r.h) for r in st.enrich_statements(statements(spark, months(1, 16))).collect()}
    assert [out[k][0] for k in range(1, 17)] == [4] * 4 + [3] * 3 + [2] * 3 + [1] * 4 + [5] * 2
    assert [out[k][1] for k in range(1, 17)] == [1] * 7 + [2] * 7 + [5] * 2


def test_short_history_has_closed_first_quarter(spark):
    enriched = st.enrich_statements(statements(spark, months(1, 6)))
    limits = {r.q: (r.start_date, r.end_date) for r in st.quarter_limits(enriched).collect()}
    assert limits == {3: (date(2017, 1, 15), date(2017, 3, 14)), 4: (date(2017, 3, 15), None)}


def test_last_statement_gets_thirty_days(spark):
    row = st.enrich_statements(statements(spark, months(1, 1))).first()
    assert row.next_statement_date == row.statement_date + timedelta(days=30)
    assert row.is_last_statement == 1 and row.balance_delta is None


def test_zero_limit_gives_null_ratio(spark):
    row = st.enrich_statements(statements(spark, months(1, 1, limit=0))).first()
    assert row.credit_ratio is None and row.cash_ratio is None and row.cash_on_credit_ratio == 0.0


def test_same_day_statements_follow_their_ids(spark):
    d = date(2017, 1, 1)
    rows = [(1, 1, d, 10, 0, 100, 0), (1, 2, d, 30, 0, 100, 0)]
    out = {r.statement_id: r for r in st.enrich_statements(statements(spark, rows)).collect()}
    assert out[1].next_statement_date == d and out[2].rank_from_last == 1
    assert float(out[2].balance_delta) == 20


def test_windows_stay_inside_accounts(spark):
    enriched = st.enrich_statements(statements(spark, months(1, 3) + months(2, 2, first_id=10)))
    assert enriched.filter("balance_delta IS NULL").count() == 2
    assert sorted(r.rank_from_last for r in enriched.filter("account_id = 2").collect()) == [1, 2]


def test_wide_series_has_a_column_per_rank(spark):
    wide = st.wide_statement_features(st.enrich_statements(statements(spark, months(1, 3, total=250))))
    row = wide.first()
    assert len(wide.columns) == 1 + 3 * 14
    assert row.credit_ratio_t_minus_1 == 0.25 and row.credit_ratio_t_minus_4 is None
    assert row.balance_delta_t_minus_3 is None and float(row.balance_delta_t_minus_2) == 0


def test_series_of_a_very_long_account(spark):
    rows = spark.range(100_000).selectExpr("1L AS account_id", "CAST(id + 1 AS INT) AS rank_from_last", "id * 0.5D AS credit_ratio",
                                           "CAST(NULL AS DOUBLE) AS balance_delta", "CAST(id AS DOUBLE) AS total_balance")
    rows = rows.unionByName(rows.filter("rank_from_last <= 3").withColumn("account_id", F.lit(2).cast("long")))
    series = st.statement_series(rows)
    sizes = {(r.account_id, r.block): (r.ranks[0], len(r.ranks), len(r.credit_ratio)) for r in series.collect()}
    assert len(sizes) == -(-100_000 // st.SERIES_BLOCK) + 1 and sizes[2, 0] == (1, 3, 3) and sizes[1, 2] == (129, 64, 64)
    found = {r.account_id: r for r in st.values_at(series, [1, 64, 65, 100_000, 100_001]).collect()}
    assert found[1].credit_ratio_t_minus_64 == 31.5 and found[1].total_balance_t_minus_65 == 64 and found[1].total_balance_t_minus_100000 == 99_999
    assert found[1].total_balance_t_minus_100001 is None and found[1].balance_delta_t_minus_1 is None
    assert found[2].total_balance_t_minus_1 == 0 and found[2].credit_ratio_t_minus_64 is None
    assert st.wide_statement_features(rows).count() == 2 and len(st.wide_statement_features(rows).columns) == 43


def test_series_and_columns_agree(spark):
    enriched = st.enrich_statements(random_ledger(spark).statements)
    wide = st.wide_statement_features(enriched, [1, 2, 30])
    wide = wide.select("account_id", *[F.col(c).cast("double") for c in wide.columns[1:]])
    assert rows_of(st.values_at(st.statement_series(enriched, block=4), [1, 2, 30], block=4).select(*wide.columns)) == rows_of(wide)


@pytest.mark.parametrize("hot", [HotKeys((1, 2)), HotKeys(every=True)])
def test_hot_accounts_give_the_same_columns(spark, hot):
    ledger = random_ledger(spark)
    plain = st.enrich_statements(ledger.statements)
    split = st.enrich_statements(ledger.statements, hot)
    assert split.columns == plain.columns
    assert rows_of(split) == rows_of(plain)


def test_plan_gives_every_rank_a_column(spark):
    plan = FeaturePlan(Ledger(accounts(spark, [(1, 0)]), statements(spark, months(1, 20)), payments(spark, [(1, date(2017, 1, 20), 100)]),
                              transactions(spark, [])))
    wide, paid = plan.wide_statements.first(), plan.paid_summary.first()
    assert wide.total_balance_t_minus_20 == 100 and "total_balance_t_minus_21" not in wide
    assert paid.pct_paid_t_minus_20 == 1.0 and paid.pct_paid_t_minus_15 == 0.0
