"""Trees with category columns of many levels: numeric columns keep their number of bins."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerfeat.plans import bins, scoring
from ledgerfeat.session import pin
from ledgerfeat.sources import sinks
from conftest import rows_of
from test_jobs import PARAMS


@pytest.fixture(scope="module")
def many_levels(spark):
    """400 rows; the label follows the level, one of 100."""
    df = spark.range(0, 400, 1, 3).selectExpr(
        "id AS account_id", "CAST(id % 100 >= 60 AS INT) AS default_flag", "CAST(crc32(CAST(id AS STRING)) AS DOUBLE) AS wide",
        "CAST(id % 3 AS DOUBLE) AS few", "CASE WHEN id % 9 > 0 THEN CAST(id % 5 AS DOUBLE) END AS holes", "CONCAT('c', id % 100) AS kind")
    return pin(scoring.with_missing_flags(df, USED))


USED = {"wide": False, "few": False, "holes": True}


def test_numeric_columns_keep_their_bins_beside_many_levels(many_levels):
    fitted = scoring.train_gbt_categorical(USED, ["kind"], 101, PARAMS).fit(many_levels)
    made = pin(fitted.transform(many_levels))
    values = np.array([r[0] for r in made.select(vector_to_array("_mixed")).collect()])
    assert [len(np.unique(c)) for c in values.T][:2] == [scoring.BINS, 3] and len(np.unique(values[:, -1])) == 100
    first = scoring.booster_of(fitted)
    assert first.getMaxBins() == 102 and first.featureImportances.size == 5
    # The levels alone tell the label: all of them are split on.
    assert made.filter("prediction <> default_flag").count() == 0
    assert scoring.score(fitted, many_levels).filter("default_score BETWEEN 0 AND 1").count() == 400


def test_few_levels_leave_numeric_columns_to_spark(many_levels):
    names = [type(s).__name__ for s in scoring.train_gbt_categorical(USED, ["kind"], 31, PARAMS).getStages()]
    assert "NumericBins" not in names


def test_bins_of_all_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 50)
    try:
        df = spark.range(0, 1000, 1, 4).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 4 AS DOUBLE) AS y", "1.5D AS z")
        df = scoring.VectorAssembler(inputCols=["x", "y", "z"], outputCol="v").transform(df)
        model = bins.NumericBins(inputCol="v", outputCol="b", bins=10).fit(df)
        x, y, z = model.getOrDefault("edges")
        assert np.allclose(x, np.arange(100, 1000, 100), atol=15) and list(y) == [0.5, 1.5, 2.5] and list(z) == []
        rows = model.transform(df).select("x", "y", vector_to_array("b").alias("b")).collect()
        assert all(list(r.b) == [np.searchsorted(x, r.x), r.y, 0.0] for r in rows) and len(rows) == 1000
        assert model.transform(df.filter("x < 0")).select("b").collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_edges_of_shares():
    assert list(bins.edges_of(np.array([3.0, 1.0, 1.0]), np.array([1, 1, 5]), 2)) == [2.0]
    assert list(bins.edges_of(np.arange(8.0), np.ones(8, int), 4)) == [1.0, 3.0, 5.0]
    assert list(bins.edges_of(np.arange(4.0), np.array([1, 97, 1, 1]), 3)) == [1.0]  # most rows share a value


def test_binned_model_is_saved(many_levels, tmp_path):
    fitted = scoring.train_gbt_categorical(USED, ["kind"], 101, PARAMS).fit(many_levels)
    sinks.save_model(fitted, f"{tmp_path}/model")
    assert rows_of(scoring.score(sinks.load_model(f"{tmp_path}/model"), many_levels)) == rows_of(scoring.score(fitted, many_levels))


def test_column_known_for_unlabelled_accounts_only(spark):
    df = spark.range(0, 120, 1, 3).selectExpr(
        "id AS account_id", "CASE WHEN id % 6 <> 5 THEN CAST(id % 10 >= 6 AS INT) END AS default_flag", "CAST(id % 10 AS DOUBLE) AS signal",
        "CASE WHEN id % 12 = 5 THEN 1.5D END AS late", "CASE WHEN id % 6 = 5 OR id % 7 > 0 THEN 2.0D END AS holes",
        "CASE WHEN id % 6 <> 5 THEN CAST(id AS DOUBLE) END AS early", "CONCAT('c', id % 40) AS kind")
    df = pin(df)
    used = scoring.known_columns(df, ["signal", "late", "holes", "early"])
    assert used == {"signal": False, "late": True, "holes": True, "early": True}
    scored = entry.gbt_categorical_scores(df, df, used)
    assert scored.count() == 20 == scored.filter("default_score BETWEEN 0 AND 1").count()
