from datetime import date

import pytest
from builders import accounts, months, payments, random_ledger, statements, transactions

from conftest import rows_of
from ledgerfeat import schema
from ledgerfeat.operators import encode
from ledgerfeat.plans import features, scoring, search
from ledgerfeat.session import bucketed_stage, pin
from ledgerfeat.sources import readers, sinks
from ledgerfeat.sources.readers import Ledger


@pytest.fixture(scope="module")
def small(spark):
    """Three accounts: active, without transactions, and only to be scored."""
    return Ledger(
        accounts(spark, [(1, 0), (2, 1), (3, None)]),
        statements(spark, months(1, 14) + months(2, 2, first_id=50) + months(3, 1, first_id=60, total=0)),
        payments(spark, [(1, date(2017, 1, 20), 100), (1, date(2017, 5, 1), 20)]),
        transactions(spark, [(1, date(2017, 2, 1), 10, "5", "A"), (1, date(2018, 2, 9), 30, "6", "B"),
                             (3, date(2017, 2, 1), 10, "5", "A")]))


@pytest.fixture(scope="module")
def table(spark, small):
    return features.feature_table(small)


def test_feature_table_has_one_row_per_account(table):
    rows = {r.account_id: r for r in table.collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[2].has_transaction_data == 0 and rows[2].favorite_city_code is None
    assert rows[1].has_14_statements == 1 and rows[2].has_14_statements == 0
    assert rows[3].has_no_bill == 1 and rows[1].has_no_bill == 0
    assert rows[2].count_payments == 0 and rows[2].has_payment_data == 0 and rows[1].has_full_payment == 1
    assert rows[1].credit_limit_spent_per_year == 0.04 and rows[1].year == 2018


def test_feature_table_columns(table):
    names = table.columns
    assert len(names) == len(set(names))
    assert not [c for c in names if c.startswith(("kurtosis", "skewness"))]
    assert "last_credit_ratio" not in names and "last_credit_ratio_x_last_delq_cycle" in names
    assert not [f.name for f in table.schema.fields if f.dataType.typeName() in ("date", "timestamp_ntz")]


def test_hot_accounts_give_the_same_feature_table(spark):
    ledger = random_ledger(spark, hot_rows=60, others=12)
    plain = features.feature_table(ledger)
    split = features.feature_table(ledger.with_hot_accounts(floor=50))
    assert rows_of(split.select(*plain.columns)) == rows_of(plain)


def test_bucketed_tables_need_no_shuffle(spark, small):
    stage = bucketed_stage(spark, "ledgerfeat_test", 4)
    enriched = stage(features.FeaturePlan(small).enriched)
    plan = enriched.groupBy("account_id").agg({"total_balance": "max"})._jdf.queryExecution().toString()
    assert "Exchange" not in plan
    spark.sql("DROP TABLE ledgerfeat_test_1")


def test_card_csv_round_trip(spark, tmp_path):
    header = "ID_CPTE,StatementDate,PERIODID_MY,CurrentTotalBalance,CashBalance,CreditLimit,DelqCycle\n"
    files = {
        "facturation_train": header + "1,2017-01-15,2017-01-01,100.50,0,1000,0\n",
        "facturation_test": header + "2,2017-01-15,2017-01-01,20,5,500,1\n",
        "paiements_train": "ID_CPTE,TRANSACTION_DTTM,TRANSACTION_AMT,PAYMENT_REVERSAL_XFLG\n"
                           "1,2017-01-20 10:00:00,40,N\n1,2017-01-21 10:00:00,,N\n",
        "paiements_test": "ID_CPTE,TRANSACTION_DTTM,TRANSACTION_AMT,PAYMENT_REVERSAL_XFLG\n",
        "performance_train": "ID_CPTE,PERIODID_MY,Default\n1,2018-01-01,1\n",
        "performance_test": "ID_CPTE,PERIODID_MY\n2,2018-01-01\n",
    }
    txn = ("ID_CPTE,TRANSACTION_DTTM,TRANSACTION_AMT,MERCHANT_CITY_NAME,MERCHANT_CATEGORY_XCD,MERCHANT_COUNTRY_XCD,"
           "DECISION_XCD,SICGROUP,TRANSACTION_CATEGORY_XCD,TRANSACTION_TYPE_XCD\n")
    for stem in schema.CSV_FILES["transactions"]:
        files[stem] = txn + "1,2017-01-20 10:00:00,7.25,55,A,CA,C,X,B,F\n"
    for stem, text in files.items():
        (tmp_path / f"{stem}.csv").write_text(text)
    ledger = readers.load_card_csv(spark, str(tmp_path))
    assert rows_of(ledger.accounts) == [(1, date(2018, 1, 1), 1), (2, date(2018, 1, 1), None)]
    assert ledger.payments.count() == 1 and ledger.transactions.count() == 4
    assert ledger.transactions.dtypes == [(f.name, f.dataType.simpleString()) for f in schema.TRANSACTIONS]
    assert {r.account_id: float(r.total_balance) for r in ledger.statements.collect()} == {1: 100.5, 2: 20.0}
    assert features.feature_table(ledger).count() == 2


def test_sinks_and_parquet_reader(spark, small, tmp_path):
    for name in schema.SCHEMAS:
        sinks.write_features(getattr(small, name), f"{tmp_path}/{name}")
    again = readers.load_parquet(spark, str(tmp_path))
    assert rows_of(again.statements) == rows_of(small.statements)
    assert readers.read_table(spark, f"{tmp_path}/accounts", ["account_id"]).columns == ["account_id"]
    trend = sinks.write_trends(small.accounts.select("account_id"), f"{tmp_path}/trend")
    assert trend.count() == 3
    sinks.write_csv_table(small.accounts.select("account_id", "default_flag"), f"{tmp_path}/csv")
    back = readers.read_csv_table(spark, f"{tmp_path}/csv", small.accounts.select("account_id", "default_flag").schema)
    assert rows_of(back) == [(1, 0), (2, 1), (3, None)]
    sinks.write_search_results(search.param_table(spark, search.random_params(4, 5)), f"{tmp_path}/params")
    assert spark.read.parquet(f"{tmp_path}/params").count() == 4
    sinks.write_submission(small.accounts.selectExpr("account_id", "0.5D AS default_score", "as_of"), f"{tmp_path}/sub")
    assert spark.read.parquet(f"{tmp_path}/sub").columns == ["account_id", "default_score"]


@pytest.fixture(scope="module")
def vectors(spark):
    df = spark.range(240).selectExpr(
        "id AS account_id", "CASE WHEN id % 6 <> 5 THEN CAST((id * 37) % 10 >= 6 AS INT) END AS default_flag",
        "CAST((id * 37) % 10 AS DOUBLE) AS signal", "CAST((id * 17) % 7 AS DOUBLE) AS noise",
        "CASE WHEN id % 9 <> 0 THEN CAST(id % 5 AS DOUBLE) END AS holes", "CAST(NULL AS DOUBLE) AS empty",
        "CAST(id AS DOUBLE) AS default_leak", "CASE WHEN id % 4 > 0 THEN CONCAT('c', id % 4) END AS kind")
    df = pin(encode.stratified_folds(df, "default_flag", 3))
    used = scoring.known_columns(df, [c for c in scoring.feature_names(df) if c != "fold"])
    return df, pin(scoring.design_vector(df, used)), used


PARAMS = scoring.BoostParams(eta=0.3, max_depth=2, min_child_weight=1, subsample=1.0, columns=1.0, rounds=4)


def test_design_names_and_flags(vectors):
    _, made, used = vectors
    assert used == {"signal": False, "noise": False, "holes": True}
    assert scoring.design_names(used) == ["signal", "noise", "holes_filled", "holes_missing"]
    row = made.filter("account_id = 0").first()
    assert row.features[3] == 1.0 and 1.5 < row.features[2] < 2.5


def test_out_of_fold_scores_cover_every_row_once(vectors):
    train = vectors[1].filter("default_flag IS NOT NULL")
    scored, models = scoring.oof_predict(scoring.train_gbt(PARAMS), train, 3)
    assert len(models) == 3 and scored.count() == train.count() == scored.select("account_id").distinct().count()
    from ledgerfeat.operators.audit import auc_score
    assert auc_score(scored, "default_flag", "default_score").first().auc > 0.95


def test_importance_curve_and_best_round(vectors):
    train = vectors[1].filter("default_flag IS NOT NULL")
    model = scoring.train_gbt(PARAMS).fit(train)
    names = scoring.design_names(vectors[2])
    assert scoring.top_features(scoring.feature_importance(model, names), 1) == ["signal"]
    assert scoring.source_columns(names) == ["signal", "noise", "holes"]
    losses = [r.loss for r in scoring.learning_curve(model, {"train": train}).orderBy("round").collect()]
    assert losses == sorted(losses, reverse=True) and len(losses) == 4
    assert 1 <= scoring.best_iteration(PARAMS, train, 3) <= 4
    areas = scoring.area_curve(model, {"train": train, "again": train}).collect()
    assert len(areas) == 8 and all(r.auc > 0.9 for r in areas)


def test_linear_net_and_category_models(vectors):
    table, made, used = vectors
    train = made.filter("default_flag IS NOT NULL")
    linear = scoring.train_logistic_l1().fit(train)
    terms = {r.term: r.coefficient for r in scoring.coefficients(linear, scoring.design_names(used)).collect()}
    assert terms["signal"] > 0 and len(terms) == 5
    net = scoring.train_mlp(4, hidden=(3,)).fit(train)
    assert scoring.score(net, made).count() == 240
    flagged = scoring.with_missing_flags(table, used)
    trees = scoring.train_gbt_categorical(used, ["kind"], 4, PARAMS).fit(flagged.filter("default_flag IS NOT NULL"))
    assert scoring.score(trees, flagged).filter("default_score BETWEEN 0 AND 1").count() == 240
    assert scoring.pca_features(made, 2).columns == ["account_id", "component_1", "component_2"]


def test_csv_missing_and_malformed_cells(spark, tmp_path):
    fields = "account_id long, amount double, country string"
    (tmp_path / "good.csv").write_text("account_id,amount,country\n1,NA,NA\n2,3.5,CA\n3,,\n")
    schema_ = spark.createDataFrame([], fields).schema
    rows = readers.read_csv_table(spark, f"{tmp_path}/good.csv", schema_).orderBy("account_id").collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (2, 3.5, "CA"), (3, None, None)]
    (tmp_path / "bad.csv").write_text("account_id,amount,country\n1,bad,CA\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_csv_table(spark, f"{tmp_path}/bad.csv", schema_).collect()


def test_gain_threshold_leaves_splits(vectors):
    train, _ = encode.split_by_label_presence(vectors[1])
    params = scoring.BoostParams(eta=0.1, max_depth=3, gamma=7.66, rounds=3)
    with pytest.raises(ValueError):
        scoring.train_gbt(params)
    model = scoring.train_gbt(params, rows=train.count()).fit(train)
    assert all(t.numNodes > 1 for t in model.trees)


def test_search_ranks_sets_and_ensemble_averages(vectors):
    train, test = encode.split_by_label_presence(vectors[1])
    sets = [PARAMS, scoring.BoostParams(eta=0.01, max_depth=1, gamma=10.0, rounds=2)]
    results, predictions = search.search(train, sets, 3, find_rounds=False)
    rows = results.collect()
    # A drawn threshold must leave trees that separate what can be separated.
    assert [r.set_id for r in rows] == [1, 2] and rows[0].auc >= rows[1].auc > 0.9
    assert predictions.count() == 2 * train.count()
    assert search.best_params(results) == [PARAMS]
    assert sum(r.n_sets for r in search.search_response(results, "eta", 0.0, 0.5).collect()) == 2
    assert len(search.grid_params(5)) == 16 and sum(p.gamma == 0 for p in search.random_params(6, 5)) >= 3
    scores = scoring.ensemble_mean(train, test, PARAMS, copies=2)
    assert scores.count() == test.count() == 40


def test_saved_pipeline_scores_alike(vectors, tmp_path):
    table, _, used = vectors
    flagged = scoring.with_missing_flags(table, used)
    pipeline = scoring.Pipeline(stages=[*scoring.design_stages(used), *scoring.one_hot_stages(["kind"]), scoring.train_gbt(PARAMS)])
    model = pipeline.fit(flagged.filter("default_flag IS NOT NULL"))
    sinks.save_model(model, f"{tmp_path}/model")
    assert rows_of(scoring.score(sinks.load_model(f"{tmp_path}/model"), flagged)) == rows_of(scoring.score(model, flagged))
    stacked = scoring.stack_features(table.select("account_id"), {"a": scoring.score(model, flagged)})
    assert stacked.columns == ["account_id", "a"] and stacked.filter("a IS NULL").count() == 0
