"""Column audits, histograms and score metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfeat.functions.columns import NUMERIC, names_by_type
from ledgerfeat.functions.scalar import is_nonfinite
from ledgerfeat.operators.skew import running_totals


def _per_column(df: DataFrame, measures: dict[str, Column], value: str) -> DataFrame:
    """One aggregated row turned into one row per column."""
    return df.agg(*[e.alias(c) for c, e in measures.items()]).unpivot([], list(measures), "column_name", value)


def missing_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column that has any."""
    names = list(columns or df.columns)
    counts = _per_column(df, {c: F.count_if(F.col(c).isNull()) for c in names}, "n_missing")
    return counts.filter(F.col("n_missing") > 0)


def nonfinite_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count of NULL, NaN and infinite values of every numeric column that has any."""
    names = list(columns or names_by_type(df, *NUMERIC))
    counts = _per_column(df, {c: F.count_if(is_nonfinite(c)) for c in names}, "n_nonfinite")
    return counts.filter(F.col("n_nonfinite") > 0)


def drop_unusable_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop the columns that either audit reports."""
    numeric = set(names_by_type(df, *NUMERIC))
    checks = {c: F.count_if(is_nonfinite(c) if c in numeric else F.col(c).isNull())
              for c in df.columns if c not in keep}
    found = df.agg(*[e.alias(c) for c, e in checks.items()]).first()  # one row of counts
    return df.drop(*[c for c in checks if found[c] > 0])


def column_range(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Largest less smallest value of every numeric column."""
    names = list(columns or names_by_type(df, *NUMERIC))
    return _per_column(
        df, {c: F.max(F.col(c).cast("double")) - F.min(F.col(c).cast("double")) for c in names}, "value_range")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin; bins 0 and ``bins + 1`` hold what lies outside."""
    known = df.filter(F.col(column).isNotNull())
    bucket = F.width_bucket(F.col(column).cast("double"), F.lit(low), F.lit(high), F.lit(bins))
    return known.groupBy(bucket.alias("bin")).agg(F.count(F.lit(1)).alias("n_rows"))


def auc_score(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; a higher score means default.

    Equal scores are counted first, so only distinct scores are put in order. ``by`` gives one area
    per group, for a few groups such as models.
    """
    counts = (
        scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, F.col(score).alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg"))
    )
    ranked = running_totals(counts, ["_score"], {"_neg_upto": F.col("_neg")}, within=by)
    wins = F.col("_pos").cast("double") * (F.col("_neg_upto") - F.col("_neg") / 2)
    pairs = F.sum("_pos").cast("double") * F.sum("_neg").cast("double")
    return ranked.groupBy(*by).agg(
        F.sum("_pos").alias("n_pos"), F.sum("_neg").alias("n_neg"),
        F.try_divide(F.sum(wins), pairs).alias("auc"))


def class_metrics(scored: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Confusion counts, sensitivity, specificity and accuracy at a threshold."""
    positive, bad = F.col(score) >= threshold, F.col(label) == 1
    known = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    counts = known.agg(
        F.count_if(bad & positive).alias("true_pos"), F.count_if(bad & ~positive).alias("false_neg"),
        F.count_if(~bad & positive).alias("false_pos"), F.count_if(~bad & ~positive).alias("true_neg"))
    return counts.withColumns({
        "sensitivity": F.try_divide(F.col("true_pos"), F.col("true_pos") + F.col("false_neg")),
        "specificity": F.try_divide(F.col("true_neg"), F.col("true_neg") + F.col("false_pos")),
        "accuracy": F.try_divide(
            F.col("true_pos") + F.col("true_neg"),
            F.col("true_pos") + F.col("false_neg") + F.col("false_pos") + F.col("true_neg")),
    })
