import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from conftest import rows_of
from ledgerfeat.operators import sparse
from ledgerfeat.operators.transactions import category_profile
from ledgerfeat.plans import scoring
from ledgerfeat.session import pin


def test_levels_shares_and_gaps(spark):
    rows = [(1, 10.0, "b", None), (1, 30.0, "a", "x"), (2, 5.0, None, "x"), (2, 0.0, "a", "NA"), (3, 0.0, "c", "x")]
    profile = pin(category_profile(spark.createDataFrame(rows, "account_id long, amount double, kind string, place string"), ["kind", "place"]))
    dictionary = pin(sparse.level_dictionary(profile))
    assert rows_of(dictionary) == sorted([("kind", None, 0), ("kind", "a", 1), ("kind", "b", 2), ("kind", "c", 3), ("place", None, 4),
                                          ("place", "NA", 5), ("place", "x", 6)], key=lambda r: tuple((v is None, str(v)) for v in r))
    found = {r.account_id: r.levels for r in sparse.sparse_vectors(
        sparse.numbered(sparse.share_entries(profile), dictionary), dictionary.count()).collect()}
    assert set(found) == {1, 2}  # the third account has spent nothing
    assert found[1].size == 7 and dict(zip(found[1].indices.tolist(), found[1].values.tolist())) == {1: 0.75, 2: 0.25, 4: 0.25, 6: 0.75}
    assert dict(zip(found[2].indices.tolist(), found[2].values.tolist())) == {0: 1.0, 6: 1.0}
    hot = sparse.sparse_vectors(sparse.numbered(sparse.presence_entries(profile), dictionary), 7)
    assert {r.account_id: r.levels.indices.tolist() for r in hot.collect()} == {1: [1, 2, 4, 6], 2: [0, 1, 5, 6], 3: [3, 6]}


def test_fifty_thousand_levels_train_a_model(spark):
    rows = spark.range(50_000).selectExpr("id % 400 AS account_id", "1.0D AS amount", "CONCAT('level', id) AS kind").unionByName(
        spark.range(400).selectExpr("id AS account_id", "50.0D AS amount", "IF(id % 3 = 0, 'risky', 'safe') AS kind"))
    profile = pin(category_profile(rows, ["kind"]))
    dictionary = pin(sparse.level_dictionary(profile))
    size = dictionary.count()
    assert size == 50_002
    vectors = sparse.sparse_vectors(sparse.numbered(sparse.share_entries(profile), dictionary), size)
    labelled = vectors.select("account_id", (F.col("account_id") % 3 == 0).cast("int").alias("default_flag"), F.lit(1.0).alias("one"), "levels")
    made = pin(VectorAssembler(inputCols=["one", "levels"], outputCol="features").transform(labelled))
    assert made.first().features.numNonzeros() < 200
    scores = {r.account_id: r.default_score for r in scoring.score(scoring.train_logistic_l1().fit(made), made).collect()}
    assert len(scores) == 400 and min(v for k, v in scores.items() if k % 3 == 0) > max(v for k, v in scores.items() if k % 3)


def test_totals_of_vectors_with_a_billion_places(spark):
    entries = spark.createDataFrame([(1, 5, 0.25), (1, 999_999_999, 0.5), (2, 0, 1.0)], "account_id long, index long, share double")
    totals = sparse.vector_totals(sparse.sparse_vectors(entries, 1_000_000_000))
    assert rows_of(totals) == [(1, 1_000_000_000, 2, 0.75), (2, 1_000_000_000, 1, 1.0)]
