"""Fits of a search read the rows in fewer partitions, a few fits in all of them."""

from __future__ import annotations

import time

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator

from ledgerfeat.plans import packed, scoring


def test_many_fits_share_the_cores(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(scoring, "fit_fold", lambda estimator, df, fold: seen.append((df.rdd.getNumPartitions(), df.count())))
    monkeypatch.setattr(packed, "forest_of", lambda model: None)
    rows = spark.range(0, 80, 1, 8)
    scoring.fit_members(rows, [scoring.BoostParams()] * 6, 3, 8)
    assert seen == [(2, 80)] * 18
    seen.clear()
    scoring.fit_members(rows, [scoring.BoostParams()], 3, 4)
    assert seen == [(8, 80)] * 3


def test_tasks_of_a_fit_hold_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FIT_ROWS", 4)
    assert scoring.for_fits(spark.range(0, 80, 1, 64)).rdd.getNumPartitions() == 20  # 4 rows each
    assert scoring.for_fits(spark.range(0, 80, 1, 64), 18, 8).rdd.getNumPartitions() == 20
    assert scoring.for_fits(spark.range(0, 8, 1, 64)).rdd.getNumPartitions() == 8  # a task for every core
    assert scoring.for_fits(spark.range(0, 80, 1, 6)).rdd.getNumPartitions() == 6
    assert scoring.for_fits(scoring.for_fits(spark.range(0, 80, 1, 64))).count() == 80


def test_fits_side_by_side_keep_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(scoring, "HELD_ROWS", 25)  # 200 on 8 cores
    assert [scoring.fits_at_once(spark.range(n), 4) for n in (0, 50, 80, 200, 500)] == [4, 4, 2, 1, 1]
    running, most = [], []

    def fit(estimator, df, fold):
        running.append(fold)
        most.append(len(running))
        time.sleep(0.2)
        running.remove(fold)
    monkeypatch.setattr(scoring, "fit_fold", fit)
    monkeypatch.setattr(packed, "forest_of", lambda model: None)
    scoring.fit_members(spark.range(200), [scoring.BoostParams()], 3, 4)
    assert max(most) == 1


def test_folds_and_copies_are_fitted_in_few_tasks(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FIT_ROWS", 30)
    seen = []
    rows = spark.range(0, 240, 1, 48).selectExpr(
        "id AS account_id", "CAST(id % 2 AS INT) AS default_flag", "CAST(id % 3 + 1 AS INT) AS fold", "CAST(id AS DOUBLE) AS x")
    vectors = scoring.VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    trees = scoring.train_gbt(scoring.BoostParams(rounds=1, max_depth=1))
    fit = type(trees).fit
    monkeypatch.setattr(type(trees), "fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    assert scoring.oof_predict(trees, vectors, 3)[0].count() == 240
    assert scoring.ensemble_mean(vectors, vectors, scoring.BoostParams(rounds=1, max_depth=1), copies=2).count() == 240
    assert seen == [8] * 5


def test_cross_validation_fits_once_a_fold_and_keeps_nothing(spark, monkeypatch):
    rows = spark.range(0, 240, 1, 8).selectExpr(
        "id AS account_id", "CAST(id * 7 % 10 > 5 AS INT) AS default_flag", "CAST(id % 3 + 1 AS INT) AS fold",
        "CAST((id * 7 % 10) * (id % 4) AS DOUBLE) AS x")
    vectors = scoring.VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    trees = scoring.train_gbt(scoring.BoostParams(rounds=2, max_depth=1, subsample=1.0, columns=1.0))
    grid = [{trees.stepSize: 0.1}, {trees.maxDepth: 3}]
    expected = CrossValidator(estimator=trees, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol="default_flag"),
                              numFolds=3, foldCol="_fold").fit(vectors.selectExpr("*", "fold - 1 AS _fold")).avgMetrics
    seen = []
    fit = type(trees).fit
    monkeypatch.setattr(type(trees), "fit", lambda self, *a: seen.append(a[0]) or fit(self, *a))
    monkeypatch.setattr(type(vectors), "cache", lambda self: pytest.fail("a part of a fold is kept"))
    assert scoring.cross_validate(trees, vectors, 3, grid=grid) == pytest.approx(expected, abs=1e-12)
    assert len(seen) == 6
    assert len(scoring.cross_validate(trees, vectors, 3)) == 1 and len(seen) == 9


def test_learning_curve_is_that_of_the_model_in_one_pass(spark, monkeypatch):
    rows = spark.range(0, 240, 1, 8).selectExpr(
        "id AS account_id", "CAST(id * 7 % 10 > 5 AS INT) AS default_flag", "CAST((id * 7 % 10) * (id % 4) AS DOUBLE) AS x")
    vectors = scoring.VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = scoring.train_gbt(scoring.BoostParams(eta=0.5, rounds=5, max_depth=2)).fit(vectors)
    parts = {"train": vectors.filter("account_id > 60"), "hold_out": vectors.filter("account_id <= 60")}
    expected = {n: model.evaluateEachIteration(p) for n, p in parts.items()}
    monkeypatch.setattr(type(model), "evaluateEachIteration", lambda *a: pytest.fail("a pass for each part"))
    found = {(r["part"], r["round"]): r["loss"] for r in scoring.learning_curve(model, parts).collect()}
    assert found == pytest.approx({(n, i): v for n, values in expected.items() for i, v in enumerate(values, 1)}, abs=1e-12)
