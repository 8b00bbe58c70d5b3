"""Design vectors, classifiers, out-of-fold predictions and scores, all as Spark ML jobs."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool
from statistics import fmean, median

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import PCA, Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfeat.functions.columns import NUMERIC, names_by_pattern, names_by_type
from ledgerfeat.operators.encode import zscore_wide_columns
from ledgerfeat.plans import packed
from ledgerfeat.plans.bins import NumericBins

LABEL = "default_flag"
KEY = "account_id"
SCORE = "default_score"
VECTOR = "features"
PATIENCE = 50
#: Partitions of the vectors that become one where many models are fitted side by side.
SIDE_BY_SIDE = 4
#: Rows of one task of a fit, and rows that all fits side by side keep in memory for every core.
FIT_ROWS, HELD_ROWS = 32_000, 100_000


@dataclass(frozen=True)
class BoostParams:
    """Settings of the boosted trees. ``columns`` is sampled per node, ``gamma`` is a gain summed over all training rows."""

    eta: float = 0.02
    max_depth: int = 4
    min_child_weight: int = 3
    subsample: float = 0.5
    columns: float = 0.5
    gamma: float = 0.0
    rounds: int = 50
    seed: int = 1234


# The settings of the final ensemble, of the category-aware trees, and the dense net.
FINAL_PARAMS = BoostParams(eta=0.003, max_depth=3, min_child_weight=1, subsample=0.5, columns=0.3, gamma=0.0, rounds=5000)
CATEGORICAL_PARAMS = BoostParams(eta=0.01, max_depth=5, min_child_weight=1, subsample=0.4, columns=0.4, rounds=50)
HIDDEN_LAYERS = (20, 10, 10, 10)
EPOCHS = 8
COMPONENTS = 20
L1_PENALTY = 0.001
#: Bins of a numeric column in a tree fit.
BINS = 32


def recode_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Class names and one indicator column per class next to the 0/1 label."""
    return df.select(
        *[c for c in df.columns if c != label],
        F.when(F.col(label) == 1, "yes").when(F.col(label) == 0, "no").alias("label_name"),
        (F.col(label) == 0).cast("int").alias("label_0"),
        (F.col(label) == 1).cast("int").alias("label_1"),
    )


# Design ----------------------------------------------------------------------------------------

def feature_names(df: DataFrame, without: Sequence[str] = ("default",)) -> list[str]:
    """Numeric columns but the key, the label and names that contain one of ``without``."""
    banned = {KEY, LABEL, *names_by_pattern(df, contains=list(without))}
    return [c for c in names_by_type(df, *NUMERIC) if c not in banned]


def known_columns(df: DataFrame, columns: Sequence[str]) -> dict[str, bool]:
    """Columns with at least one value, and whether any value is missing (one row of counts)."""
    seen = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns]).first()
    return {c: seen[c] < seen["_rows"] for c in columns if seen[c] > 0}


def with_missing_flags(df: DataFrame, columns: Mapping[str, bool]) -> DataFrame:
    """Doubles for the columns, and a 0/1 column for each one that has missing values."""
    others = [c for c in df.columns if c not in columns]
    return df.selectExpr(
        *[f"`{c}`" for c in others],
        *[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in columns],
        *[f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}_missing`" for c, gaps in columns.items() if gaps],
    )


def design_stages(columns: Mapping[str, bool]) -> list:
    """Mean imputation and assembly, for tables that went through ``with_missing_flags``."""
    gaps = [c for c, missing in columns.items() if missing]
    stages: list = []
    if gaps:
        stages.append(Imputer(strategy="mean", inputCols=gaps, outputCols=[f"{c}_filled" for c in gaps]))
    stages.append(VectorAssembler(inputCols=design_names(columns), outputCol=VECTOR))
    return stages


def design_names(columns: Mapping[str, bool]) -> list[str]:
    """Name of every vector position made by ``design_stages``."""
    gaps = [c for c, missing in columns.items() if missing]
    whole = [c for c, missing in columns.items() if not missing]
    return whole + [f"{c}_filled" for c in gaps] + [f"{c}_missing" for c in gaps]


def fold_sums(df: DataFrame, columns: Sequence[str], fold: str = "fold") -> DataFrame:
    """``fold``, ``place``, ``total`` and ``n`` of every column's known values by fold of the labelled rows.

    Columns travel as one array and are added up by place, so the compiled code is the same for ten columns and thousands.
    """
    values = F.array(*[F.col(c).cast("double") for c in columns])
    rows = df.filter(F.col(LABEL).isNotNull()).select(F.col(fold).alias("fold"), F.posexplode(values).alias("place", "value"))
    return rows.groupBy("fold", "place").agg(F.sum("value").alias("total"), F.count("value").alias("n"))


def fold_means(df: DataFrame, columns: Sequence[str], fold: str = "fold") -> DataFrame:
    """``fold`` and ``means``: the mean of every column over the labelled rows of the other folds; fold 0 leaves none out.

    Each fold is added up once and its share taken off the total. A column without values elsewhere has the mean 0.
    """
    parts = fold_sums(df, columns, fold)
    sums = parts.groupBy("place").agg(F.sum("total").alias("all"), F.sum("n").alias("all_n"))
    others = parts.join(sums, "place").select("fold", "place", (F.col("all") - F.coalesce("total", F.lit(0.0))).alias("total"),
                                              (F.col("all_n") - F.col("n")).alias("n"))
    every = sums.select(F.lit(0).alias("fold"), "place", F.col("all").alias("total"), F.col("all_n").alias("n"))
    mean = F.coalesce(F.try_divide("total", "n"), F.lit(0.0)).alias("mean")
    return others.unionByName(every).groupBy("fold").agg(
        F.sort_array(F.collect_list(F.struct("place", mean)))["mean"].alias("means"))  # a row per fold, a value per column


def fill_by_fold(df: DataFrame, columns: Sequence[str], fold: str = "fold") -> DataFrame:
    """``<column>_filled`` for every column: its value, or the mean of the folds the row is not in.

    Rows without a label take the mean of all labelled rows.
    """
    means = fold_means(df, columns, fold).withColumnRenamed("fold", "_fold")
    key = F.when(F.col(LABEL).isNotNull(), F.col(fold)).otherwise(0)
    joined = df.join(F.broadcast(means), key == F.col("_fold"), "left")  # a row per fold
    return joined.select(*df.columns, *[F.coalesce(F.col(c).cast("double"), F.get("means", F.lit(i))).alias(f"{c}_filled")
                                        for i, c in enumerate(columns)])


def design_vector(df: DataFrame, columns: Mapping[str, bool], categories: Sequence[str] = ()) -> DataFrame:
    """Key, label and feature vector; ``categories`` add a dummy for every level but one.

    With a column ``fold`` missing values are filled by the means of the other folds, without one by those of all rows.
    """
    flagged = with_missing_flags(df, columns)
    gaps = [c for c, missing in columns.items() if missing]
    if "fold" in df.columns and gaps:
        flagged, stages = fill_by_fold(flagged, gaps), design_stages(columns)[1:]
    else:
        stages = design_stages(columns)
    if categories:
        assemble = VectorAssembler(inputCols=[*design_names(columns), *[f"{c}_dummies" for c in categories]], outputCol=VECTOR)
        stages = [*stages[:-1], *one_hot_stages(categories), assemble]
    made = Pipeline(stages=stages).fit(flagged).transform(flagged)
    return made.select(*[c for c in (KEY, LABEL, "fold", "in_train") if c in df.columns], VECTOR)


def index_categories(columns: Sequence[str]) -> StringIndexer:
    """Integer codes for the tree learner; unseen and missing values share an extra code."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_index" for c in columns], handleInvalid="keep")


def one_hot_stages(columns: Sequence[str]) -> list:
    """Codes and dummy vectors, one level left out per column."""
    return [index_categories(columns), OneHotEncoder(
        inputCols=[f"{c}_index" for c in columns], outputCols=[f"{c}_dummies" for c in columns], dropLast=True)]


def pca_stages(components: int = COMPONENTS) -> list:
    return [
        StandardScaler(inputCol=VECTOR, outputCol="_scaled", withMean=True, withStd=True),
        PCA(k=components, inputCol="_scaled", outputCol="components"),
    ]


def pca_features(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Principal components of the standardised vector, one column each (signs are arbitrary)."""
    made = Pipeline(stages=pca_stages(components)).fit(vectors).transform(vectors)
    values = vector_to_array("components")
    return made.select(KEY, *[values[i].alias(f"component_{i + 1}") for i in range(components)])


def net_inputs(table: DataFrame, vectors: DataFrame, names: Sequence[str], components: int = COMPONENTS) -> DataFrame:
    """Standardised chosen features (0, the mean, where missing) and principal components in one vector."""
    scaled = zscore_wide_columns(table.select(KEY, *names), names).fillna(0.0, subset=list(names))
    made = Pipeline(stages=pca_stages(components)).fit(vectors).transform(vectors).drop(VECTOR, "_scaled")
    joined = made.join(scaled, KEY)
    return VectorAssembler(inputCols=[*names, "components"], outputCol="net_inputs").transform(joined).select(
        *[c for c in (KEY, LABEL, "fold", "in_train") if c in vectors.columns], "net_inputs")


# Estimators ------------------------------------------------------------------------------------

def train_gbt(params: BoostParams = BoostParams(), vector: str = VECTOR, max_bins: int = BINS,
              rows: int | None = None) -> GBTClassifier:
    """Boosted trees. A threshold on the gain needs the number of training ``rows``: Spark's gain is per row."""
    if params.gamma and not rows:
        raise ValueError("gamma is a sum over the training rows: give their number")
    gain = params.gamma / rows if params.gamma else 0.0
    return GBTClassifier(
        labelCol=LABEL, featuresCol=vector, lossType="logistic", maxIter=params.rounds, maxDepth=params.max_depth,
        stepSize=params.eta, subsamplingRate=params.subsample, featureSubsetStrategy=str(params.columns),
        minInstancesPerNode=params.min_child_weight, minInfoGain=gain, seed=params.seed, maxBins=max_bins)


def train_gbt_categorical(numeric: Mapping[str, bool], categorical: Sequence[str], max_levels: int,
                          params: BoostParams = CATEGORICAL_PARAMS) -> Pipeline:
    """Trees that split on category sets; ``max_levels`` bounds the levels of a column.

    Spark takes one number of bins for all columns, here that of the levels. Where it exceeds ``BINS``, numeric columns are
    put into as many bins as ``train_gbt`` gives them before; categories keep all their levels.
    """
    stages, numbers, bins = design_stages(numeric), VECTOR, max(BINS, max_levels + 1)
    if bins > BINS:
        numbers = "_binned"
        stages.append(NumericBins(inputCol=VECTOR, outputCol=numbers, bins=BINS))
    assembler = VectorAssembler(inputCols=[numbers, *[f"{c}_index" for c in categorical]], outputCol="_mixed")
    return Pipeline(stages=[
        *stages, index_categories(categorical), assembler, train_gbt(params, vector="_mixed", max_bins=bins)])


def train_logistic_l1(penalty: float = L1_PENALTY, vector: str = VECTOR) -> LogisticRegression:
    return LogisticRegression(labelCol=LABEL, featuresCol=vector, elasticNetParam=1.0, regParam=penalty)


def train_mlp(inputs: int, vector: str = VECTOR, hidden: Sequence[int] = HIDDEN_LAYERS, epochs: int = EPOCHS,
              seed: int = 1234) -> MultilayerPerceptronClassifier:
    """Dense net with sigmoid layers and a softmax output over the two classes."""
    return MultilayerPerceptronClassifier(
        labelCol=LABEL, featuresCol=vector, layers=[inputs, *hidden, 2], maxIter=epochs, seed=seed)


# Scores ----------------------------------------------------------------------------------------

def score(model: Transformer, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Probability of default per account."""
    return model.transform(df).select(KEY, *keep, vector_to_array("probability")[1].alias(SCORE))


def fits_at_once(df: DataFrame, parallelism: int) -> int:
    """How many of ``parallelism`` fits of ``df`` run side by side: each keeps all its rows, and what memory cannot hold goes to disk."""
    return max(1, min(parallelism, HELD_ROWS * df.sparkSession.sparkContext.defaultParallelism // max(1, df.count())))


def for_fits(df: DataFrame, fits: int = 1, at_once: int = 1) -> DataFrame:
    """``df`` in the partitions that its fits read.

    Each task of a tree fit shuffles the statistics of every feature and bin in every round, whatever its number of rows, so
    a task takes up to ``FIT_ROWS``, as long as all cores have one. Where many fits run side by side they keep the cores
    busy, and each reads the rows in up to ``SIDE_BY_SIDE`` times fewer partitions.
    """
    least, cores = -(-df.count() // FIT_ROWS), df.sparkSession.sparkContext.defaultParallelism
    fewer = max(1, min(SIDE_BY_SIDE, at_once, fits // SIDE_BY_SIDE))
    parts = min(df.rdd.getNumPartitions(), max(cores, least))
    return df.coalesce(max(1, -(-parts // fewer), min(parts, least)))


def fit_fold(estimator: Estimator, df: DataFrame, fold: int) -> Model:
    return estimator.fit(df.filter(F.col("fold") != fold))


def oof_predict(estimator: Estimator, df: DataFrame, folds: int, parallelism: int = 4) -> tuple[DataFrame, list[Model]]:
    """Score every row with the model fitted on the other folds; ``df`` has a ``fold`` column 1..folds.

    Rows keep their account and fold, so predictions join by key.
    """
    numbers = range(1, folds + 1)
    at_once = fits_at_once(df, min(parallelism, folds))
    df = for_fits(df, folds, at_once)
    with ThreadPool(at_once) as pool:
        models = pool.map(lambda k: fit_fold(estimator, df, k), numbers)
    out = None
    for k, model in zip(numbers, models):
        part = score(model, df.filter(F.col("fold") == k), keep=[LABEL, "fold"])
        out = part if out is None else out.unionByName(part)
    return out, models


def attach_predictions(df: DataFrame, scores: DataFrame, name: str) -> DataFrame:
    """Scores as a column, joined by account."""
    return df.join(scores.select(KEY, F.col(SCORE).alias(name)), KEY, "left")


def stack_features(df: DataFrame, predictions: Mapping[str, DataFrame]) -> DataFrame:
    """Predictions of other models as further features."""
    for name, scores in predictions.items():
        df = attach_predictions(df, scores, name)
    return df


def booster_of(model: Model) -> GBTClassificationModel:
    return model.stages[-1] if isinstance(model, PipelineModel) else model


def feature_importance(model: Model, names: Sequence[str]) -> DataFrame:
    """Importance of every used feature, largest first (one row per model column)."""
    values = booster_of(model).featureImportances
    rows = [(names[int(i)], float(v)) for i, v in zip(values.indices, values.values) if v > 0]
    fields = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return SparkSession.active().createDataFrame(rows, fields).orderBy(F.desc("importance"), "feature")


def top_features(importance: DataFrame, count: int = 20) -> list[str]:
    return [r["feature"] for r in importance.orderBy(F.desc("importance"), "feature").limit(count).collect()]


def source_columns(names: Sequence[str]) -> list[str]:
    """The table columns behind names of the design vector, each once, in order."""
    return list(dict.fromkeys(n.removesuffix("_filled").removesuffix("_missing") for n in names))


def coefficients(model: Model, names: Sequence[str]) -> DataFrame:
    """Intercept and coefficients of a fitted logistic model."""
    fitted = model.stages[-1] if isinstance(model, PipelineModel) else model
    rows = [("(intercept)", float(fitted.intercept))] + [
        (n, float(v)) for n, v in zip(names, fitted.coefficients.toArray())]
    fields = T.StructType([T.StructField("term", T.StringType()), T.StructField("coefficient", T.DoubleType())])
    return SparkSession.active().createDataFrame(rows, fields)


def margins_of_parts(model: Model, parts: Mapping[str, DataFrame]) -> DataFrame:
    """``part``, the label and the margin after every round of each row of the parts."""
    rows = None
    for name, part in parts.items():
        named = part.withColumn("part", F.lit(name))
        rows = named if rows is None else rows.unionByName(named)
    return packed.staged_margins(rows, [packed.Member(1, 0, packed.forest_of(booster_of(model)))], [LABEL, "part"])


def learning_curve(model: Model, parts: Mapping[str, DataFrame]) -> DataFrame:
    """Loss after every round on each part, for example training rows and hold-out rows, in one pass over them."""
    return packed.round_losses(margins_of_parts(model, parts), LABEL, by=["part"])


def fit_members(df: DataFrame, sets: Sequence[BoostParams], folds: int | Sequence[int], parallelism: int = 4) -> list[packed.Member]:
    """Every parameter set fitted without each fold (1..``folds``, or those given), a few fits at a time."""
    numbers = range(1, folds + 1) if isinstance(folds, int) else folds
    rows = df.count() if any(p.gamma for p in sets) else None
    at_once = fits_at_once(df, parallelism)
    df = for_fits(df, len(sets) * len(numbers), at_once)

    def fit(job: tuple[int, int]) -> packed.Member:
        i, k = job
        return packed.Member(i + 1, k, packed.forest_of(fit_fold(train_gbt(sets[i], rows=rows), df, k)))
    with ThreadPool(at_once) as pool:
        return pool.map(fit, [(i, k) for i in range(len(sets)) for k in numbers], chunksize=1)


def round_curve(df: DataFrame, params: BoostParams, folds: int | Sequence[int], parallelism: int = 4) -> DataFrame:
    """Hold-out AUC after every round in every fold: ``set_id`` (1), ``fold``, ``round``, ``n_pos``, ``n_neg``, ``auc``."""
    members = fit_members(df, [params], folds, parallelism)
    return packed.round_areas(packed.staged_margins(df, members, [LABEL]), LABEL)


def best_iteration(params: BoostParams, df: DataFrame, folds: int, patience: int = PATIENCE,
                   parallelism: int = 4) -> int:
    """Rounds after which the hold-out AUC stops growing: the median over folds, rounded down.

    The first trees of a long fit are those of a short one. So folds are fitted with twice the patience first, and those whose
    area has not failed to grow for ``patience`` rounds by then again with twice as many, up to ``params.rounds``.
    """
    best: dict[int, int] = {}
    left: Sequence[int] = range(1, folds + 1)
    rounds = min(params.rounds, 2 * patience)
    while left:
        curves = packed.fold_curves(round_curve(df, replace(params, rounds=rounds), left, parallelism)).get(1, {})
        best |= {k: packed.best_round(areas, patience) for k, areas in curves.items()}
        left = [k for k in curves if rounds < params.rounds and rounds - best[k] < patience]
        rounds = min(params.rounds, 2 * rounds)
    return math.floor(median(best.values()))


def area_curve(model: Model, parts: Mapping[str, DataFrame]) -> DataFrame:
    """AUC after every round on each part, for example training rows and hold-out rows: ``part``, ``round``, ``auc``."""
    return packed.round_areas(margins_of_parts(model, parts), LABEL, by=["part"]).select("part", "round", "auc")


def cross_validate(estimator: Estimator, df: DataFrame, folds: int = 5, parallelism: int = 4,
                   grid: Sequence | None = None) -> list[float]:
    """Mean hold-out AUC of each entry of ``grid`` (one entry: the estimator as it is).

    Spark's own validator keeps both parts of every fold in memory or on disk and fits once more on all rows at the end.
    """
    entries = list(grid or [{}])
    at_once = fits_at_once(df, min(parallelism, folds * len(entries)))
    df = for_fits(df, folds * len(entries), at_once)
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL)

    def area(job: tuple[Mapping, int]) -> float:
        settings, k = job
        model = fit_fold(estimator.copy(settings), df, k)
        return evaluator.evaluate(model.transform(df.filter(F.col("fold") == k)))
    with ThreadPool(at_once) as pool:
        areas = pool.map(area, [(e, k) for e in entries for k in range(1, folds + 1)], chunksize=1)
    return [fmean(areas[i:i + folds]) for i in range(0, len(areas), folds)]


def ensemble_mean(train: DataFrame, unlabelled: DataFrame, params: BoostParams, copies: int = 10,
                  parallelism: int = 4) -> DataFrame:
    """Mean score of ``copies`` boosters that differ in their seed, in one pass over ``unlabelled``."""
    rows = train.count() if params.gamma else None
    at_once = fits_at_once(train, min(parallelism, copies))
    train = for_fits(train, copies, at_once)

    def fit(i: int) -> packed.Member:
        model = train_gbt(replace(params, seed=params.seed + i), rows=rows).fit(train)
        return packed.Member(i + 1, 0, packed.forest_of(model))
    with ThreadPool(at_once) as pool:
        members = pool.map(fit, range(copies), chunksize=1)
    margins = packed.staged_margins(unlabelled, members, [KEY], at={m.set_id: [m.forest.rounds] for m in members})
    return margins.groupBy(KEY).agg(F.avg(packed.probability(F.col("margins")[0])).alias(SCORE))
