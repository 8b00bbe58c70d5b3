"""Registered model runs take the folds, rounds and patience of a full run."""

from __future__ import annotations

from dataclasses import replace
from math import floor
from statistics import median

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerfeat.operators import encode
from ledgerfeat.plans import packed, scoring
from ledgerfeat.session import pin
from test_jobs import PARAMS


@pytest.fixture(scope="module")
def designed(spark):
    """Table, vectors and columns of a design; account 7 comes twice."""
    df = spark.range(360).selectExpr(
        "id AS account_id", "CASE WHEN id % 6 <> 5 THEN CAST((id * 37) % 10 >= 6 AS INT) END AS default_flag",
        "CAST(crc32(CAST(id AS STRING)) % 97 AS DOUBLE) AS signal", "CASE WHEN id % 9 <> 0 THEN CAST(id % 5 AS DOUBLE) END AS holes")
    df = df.unionAll(df.filter("account_id = 7"))
    df = pin(encode.stratified_split(encode.stratified_folds(df, "default_flag", 3), "default_flag"))
    used = scoring.known_columns(df, ["signal", "holes"])
    return df, pin(scoring.design_vector(df, used)), used


def test_other_folds_keep_every_row(designed):
    table, _, used = designed
    made = entry.refolded(table, used, 9)
    sizes = {r.fold: r.n for r in made.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    assert set(sizes) == set(range(1, 10)) and sum(sizes.values()) == table.filter("default_flag IS NOT NULL").count()
    assert made.filter("account_id = 7").select("fold").distinct().count() == 1


def test_best_iteration_takes_all_folds_and_the_whole_patience(designed, monkeypatch):
    seen = []
    monkeypatch.setattr(scoring, "best_iteration", lambda params, df, folds, patience: seen.append(
        (params, folds, patience, df.select("fold").distinct().count())) or 1)
    assert entry.best_rounds(*designed).first().best_iteration == 1
    assert seen == [(replace(entry.RUN_PARAMS, rounds=5000), 9, 50, 9)]


def test_cross_validation_takes_all_folds_and_rounds(designed, monkeypatch):
    seen = []
    monkeypatch.setattr(scoring, "cross_validate", lambda trees, df, folds: seen.append(
        (trees.getMaxIter(), trees.getMaxDepth(), folds, df.select("fold").distinct().count())) or [0.5])
    assert entry.cv_metric(*designed).first().mean_auc == 0.5
    assert seen == [(50, 5, 5, 5)]


def test_fits_go_on_until_the_patience_is_used_up(designed, monkeypatch):
    train = designed[1].filter("default_flag IS NOT NULL")
    params = replace(PARAMS, subsample=0.7, rounds=12)
    whole = packed.fold_curves(scoring.round_curve(train, params, 3))[1]
    fitted = []
    curve = scoring.round_curve
    monkeypatch.setattr(scoring, "round_curve", lambda df, p, folds, *a: fitted.append((p.rounds, list(folds))) or curve(df, p, folds, *a))
    for patience in (2, 12):
        fitted.clear()
        best = {k: packed.best_round(c, patience) for k, c in whole.items()}
        assert scoring.best_iteration(params, train, 3, patience) == floor(median(best.values()))
        assert fitted[0] == (min(12, 2 * patience), [1, 2, 3]) and fitted[-1][0] <= 12
        for k, b in best.items():  # up to the round at which a fold ends, and to less than twice as many
            last = max(n for n, folds in fitted if k in folds)
            assert last >= min(12, b + patience) and (last == 2 * patience or last / 2 < b + patience)
