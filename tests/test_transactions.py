from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from builders import months, random_ledger, statements, transactions

from conftest import rows_of
from ledgerfeat import schema
from ledgerfeat.operators import transactions as tx
from ledgerfeat.operators.statements import enrich_statements, quarter_limits

DAY = date(2017, 1, 1)


def favorites(spark, rows, **options):
    profile = tx.category_profile(transactions(spark, rows), ["city", "category"])
    return {r[0]: r[1] for r in tx.favorite_value(profile, options.pop("variable", "city"), "f", **options).collect()}


def test_favorite_tie_takes_smaller_code(spark):
    rows = [(1, DAY, 1, c, "A") for c in ("10", "9", "10", "9", "7")]
    assert favorites(spark, rows, numeric=True) == {1: "9"}
    assert favorites(spark, rows) == {1: "10"}


def test_favorite_puts_null_last_and_counts_it(spark):
    assert favorites(spark, [(1, DAY, 1, None, "A"), (1, DAY, 1, "5", "A")]) == {1: "5"}
    assert favorites(spark, [(1, DAY, 1, None, "A"), (1, DAY, 1, None, "A"), (1, DAY, 1, "5", "A")]) == {1: None}


def test_excluded_categories_give_the_next_best(spark):
    rows = [(1, DAY, 1, "5", c) for c in ("WW", "WW", "D", "D", "B", None)]
    assert favorites(spark, rows, variable="category", exclude=tx.EXCLUDED_CATEGORIES) == {1: "B"}


def test_pooling_threshold(spark):
    rows = [(i, "a") for i in range(10)] + [(100 + i, "b") for i in range(11)] + [(999, None)]
    df = spark.createDataFrame(rows, "account_id long, city string")
    codes = {(r.city, r.code) for r in tx.pool_rare(df, "city", "code").collect()}
    assert codes == {("a", tx.OTHER_CODE), ("b", "b"), (None, None)}


def test_city_moves_with_a_missing_quarter(spark):
    rows = [(a, q, c) for a in range(12) for q, c in ((1, "x"), (2, "y"), (4, "y"))]
    df = spark.createDataFrame(rows, "account_id long, q int, favorite_city string")
    row = tx.city_moves(df).first()
    assert (row.moved_q2, row.moved_q3, row.moved_q4, row.moves) == (1, 0, 0, 1)


def test_single_day_shopper_has_no_gaps(spark):
    df = transactions(spark, [(1, DAY, 1, "5", "A"), (1, DAY, 2, "5", "A"), (2, DAY, 1, "5", "A"),
                              (2, DAY + timedelta(3), 1, "5", "A"), (2, DAY + timedelta(10), 1, "5", "A")])
    out = tx.days_between_summary(df).collect()
    assert [(r.account_id, r.mean_days_between, r.p25_days_between) for r in out] == [(2, 5.0, 4.0)]


def test_shares_sum_to_one_and_diversity_is_bounded(spark):
    ledger = random_ledger(spark)
    profile = tx.category_profile(ledger.transactions, ["category", "city", "country"])
    values = tx.distinct_values(ledger.transactions, "category")
    for r in tx.spend_share(profile, "category", values).collect():
        assert sum(r[1:]) == pytest.approx(1)
    kinds = {r.account_id: r.n_distinct_city for r in tx.distinct_counts(profile, ["city"]).collect()}
    for r in tx.diversity_index(profile).collect():
        assert 1 / kinds[r.account_id] - 1e-12 <= r.index_city <= 1 and r.index_country == 1


def test_null_category_keeps_its_share_and_name(spark):
    df = transactions(spark, [(1, DAY, 30, "5", None), (1, DAY, 10, "5", "A")])
    values = tx.distinct_values(df, "category")
    assert values == ["A", None]
    row = tx.spend_share(tx.category_profile(df, ["category"]), "category", values).first()
    assert (row.category_pct_sum_A, row.category_pct_sum_NA) == (0.25, 0.75)


def test_null_and_the_text_na_are_two_values(spark):
    df = transactions(spark, [(1, DAY, 30, "5", None), (1, DAY, 10, "5", "NA")])
    values = tx.distinct_values(df, "category")
    assert values == ["NA", None]
    row = tx.spend_share(tx.category_profile(df, ["category"]), "category", values).first()
    assert (row["category_pct_sum_NA"], row["category_pct_sum_NA_"]) == (0.25, 0.75)


def test_too_many_feature_columns_are_refused(spark):
    with pytest.raises(ValueError):
        tx.distinct_values(spark.range(20), "id", at_most=10)


def test_quarters_partition_time(spark):
    enriched = enrich_statements(statements(spark, months(1, 14)))
    limits = {r.q: (r.start_date, r.end_date) for r in quarter_limits(enriched).collect()}
    days = [date(2016, 1, 1) + timedelta(k) for k in range(0, 1200, 5)]
    placed = tx.transactions_in_quarters(transactions(spark, [(1, d, 1, "5", "A") for d in days]), enriched)
    got = {r.txn_date: r.q for r in placed.collect()}
    assert len(got) == len(days)
    for d, q in got.items():
        start, end = limits[q]
        assert (start is None or d >= start) and (end is None or d <= end)


def test_distinct_counts_take_null_as_a_value(spark):
    df = spark.createDataFrame([
        (1, datetime(2017, 1, 1), None, None, "A", "CA", "A", "G", "P", "T"),
        (1, datetime(2017, 1, 1), None, "5", "A", "CA", "A", "G", "P", "T")], schema.TRANSACTIONS)
    row = tx.distinct_counts(tx.category_profile(df, tx.DISTINCT_COLUMNS)).first()
    assert (row.n_distinct_city, row.n_distinct_category) == (2, 1)


def test_frequency_buckets_follow_row_counts(spark):
    ledger = random_ledger(spark)
    sizes = Counter(r.city for r in ledger.transactions.select("city").collect())
    buckets = {r.city: r.city_decile for r in tx.frequency_ntile(ledger.transactions, "city").collect()}
    ranked = sorted(sizes, key=lambda c: (sizes[c], c))
    assert [buckets[c] for c in ranked] == sorted(buckets.values())
    looked = tx.bucket_lookup(ledger.transactions, ["city"])
    assert looked.count() == ledger.transactions.count()
    assert rows_of(looked.select("city", "city_decile").distinct()) == sorted((c, b) for c, b in buckets.items())
