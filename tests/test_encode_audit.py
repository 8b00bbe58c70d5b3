from collections import Counter, defaultdict

import pytest

from conftest import rows_of
from ledgerfeat.functions import columns as cols
from ledgerfeat.operators import audit, encode


def people(spark, rows):
    return spark.createDataFrame(rows, "account_id long, code string, y int, fold int")


def test_out_of_fold_means_against_a_loop(spark):
    rows = [(i, "abc"[i % 3] if i % 7 else None, None if i % 5 == 0 else int(i % 4 == 0), i % 6) for i in range(200)]
    got = {r.account_id: r.m for r in encode.oof_target_encode(people(spark, rows), "code", "y", "fold", "m").collect()}
    for i, code, y, fold in rows:
        others = [b for _, c, b, f in rows if b is not None and c == code and (y is None or f != fold)]
        assert got[i] == pytest.approx(sum(others) / len(others))


def test_own_fold_labels_do_not_matter(spark):
    rows = [(i, "a", int(i % 3 == 0), i % 4) for i in range(40)]
    flipped = [(i, c, 1 - y if f == 0 else y, f) for i, c, y, f in rows]
    encoded = lambda data: {r.account_id: r.m for r in encode.oof_target_encode(
        people(spark, data), "code", "y", "fold", "m").filter("fold = 0").collect()}
    assert encoded(rows) == encoded(flipped)


def test_code_inside_one_fold_has_no_value(spark):
    rows = [(i, "a", 1, 3) for i in range(11)] + [(50, "a", None, None), (51, "zz", None, None)]
    got = {r.account_id: r.m for r in encode.oof_target_encode(people(spark, rows), "code", "y", "fold", "m").collect()}
    assert got[0] is None and got[50] == 1.0 and got[51] is None


def test_folds_are_complete_balanced_and_repeatable(spark):
    df = spark.range(500).selectExpr("id AS account_id", "CAST(id % 11 = 0 AS INT) AS y")
    out = encode.stratified_folds(df, "y", 7)
    rows = out.collect()
    assert len({r.account_id for r in rows}) == 500
    for label in (0, 1):
        sizes = Counter(r.fold for r in rows if r.y == label)
        assert set(sizes) == set(range(1, 8)) and max(sizes.values()) - min(sizes.values()) <= 1
    assert rows_of(out) == rows_of(encode.stratified_folds(df.orderBy("y"), "y", 7))
    assert rows_of(out) != rows_of(encode.stratified_folds(df, "y", 7, seed=5))


def test_split_keeps_the_share_of_each_label(spark):
    df = spark.range(400).selectExpr("id AS account_id", "CAST(id % 4 = 0 AS INT) AS y")
    sizes = Counter((r.y, r.in_train) for r in encode.stratified_split(df, "y", 0.9).collect())
    assert sizes == {(0, 1): 270, (0, 0): 30, (1, 1): 90, (1, 0): 10}


def test_value_ntile_leaves_null_out(spark):
    df = spark.createDataFrame([(i, None if i == 3 else float(i)) for i in range(21)], "account_id long, v double")
    got = {r.account_id: r.v_ntile for r in encode.value_ntile(df, "v").collect()}
    assert got[3] is None and got[0] == 1 and got[20] == 10 and Counter(got.values())[5] == 2


def test_one_hot_drops_the_first_level_and_keeps_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "account_id long, c string")
    out = encode.one_hot(df, ["c"])
    assert out.columns == ["account_id", "c_b", "c_NA"]
    assert rows_of(out) == [(1, 0, 0), (2, 1, 0), (3, 0, 1)]


def test_one_hot_keeps_null_apart_from_the_text_na(spark):
    df = spark.createDataFrame([(1, "A"), (2, "NA"), (3, None)], "account_id long, c string")
    out = encode.one_hot(df, ["c"])
    assert out.columns == ["account_id", "c_NA", "c_NA_"]
    assert rows_of(out) == [(1, 0, 0), (2, 1, 0), (3, 0, 1)]


def test_one_hot_refuses_values_outside_given_levels(spark):
    df = spark.createDataFrame([(1, "a"), (2, "z")], "account_id long, c string")
    with pytest.raises(Exception, match="level outside those of c: z"):
        encode.one_hot(df, ["c"], {"c": ["a", "b"]}).collect()


def test_scaling_leaves_narrow_columns(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 10.0, 1.0), (3, 20.0, 1.0)], "account_id long, a double, b double")
    assert rows_of(encode.zscore_wide_columns(df, ["a", "b"])) == [(1, -1.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 1.0)]


def test_audits(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None, "x"), (2, float("nan"), 2.0, None), (3, float("inf"), 3.0, "y")],
        "account_id long, a double, b double, c string")
    assert rows_of(audit.missing_audit(df)) == [("b", 1), ("c", 1)]
    assert rows_of(audit.nonfinite_audit(df)) == [("a", 2), ("b", 1)]
    assert audit.drop_unusable_columns(df, keep=["c"]).columns == ["account_id", "c"]


def test_histogram_counts_everything_known(spark):
    df = spark.createDataFrame([(x,) for x in (-2.0, 0.0, 0.24, 0.25, 0.99, 1.0, None)], "x double")
    assert rows_of(audit.histogram(df, "x", 0.0, 1.0, 4)) == [(0, 1), (1, 2), (2, 1), (4, 1), (5, 1)]


def test_auc_with_ties_and_groups(spark):
    rows = [(m, y, s) for m in ("a", "b") for y, s in [(1, 3.0), (0, 3.0), (1, 2.0), (0, 1.0), (0, 2.0), (None, 9.0)]]
    df = spark.createDataFrame(rows, "model string, y int, s double")
    wins = {r.model: r.auc for r in audit.auc_score(df, "y", "s", by=["model"]).collect()}
    assert wins == {"a": pytest.approx(4.0 / 6), "b": pytest.approx(4.0 / 6)}
    only = audit.auc_score(df.filter("y = 1"), "y", "s").first()
    assert only.auc is None and only.n_pos == 4


def test_class_metrics(spark):
    df = spark.createDataFrame([(1, .9), (1, .1), (0, .2), (0, .8), (0, .3)], "y int, s double")
    row = audit.class_metrics(df, "y", "s").first()
    assert (row.true_pos, row.false_neg, row.false_pos, row.true_neg) == (1, 1, 1, 2)
    assert (row.sensitivity, row.specificity, row.accuracy) == (0.5, 2 / 3, 0.6)


def test_column_choices(spark):
    df = spark.sql("SELECT 1 AS account_id, 2.0D AS kurtosis_x, DATE '1970-01-05' AS d, 'a' AS Default_name, 3 AS skewness_y")
    assert cols.names_by_pattern(df, contains=["default"]) == ["Default_name"]
    assert cols.drop_higher_moments(df).columns == ["account_id", "d", "Default_name"]
    assert cols.dates_to_numeric(df).first().d == 4
    assert set(dict(cols.numbers_to_double(df, skip=["account_id"]).dtypes).values()) == {"int", "double", "date", "string"}
    counts = defaultdict(int)
    for name in cols.names_by_type(df, *cols.NUMERIC):
        counts[name] += 1
    assert set(counts) == {"account_id", "kurtosis_x", "skewness_y"}
