"""Folds, splits, target encoding, buckets of accounts, dummies and scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.operators.skew import distributed_ntile, row_numbers
from ledgerfeat.operators.transactions import distinct_values, value_labels


def _label_order(df: DataFrame, label: str, seed: int | None) -> DataFrame:
    key = F.col("account_id").cast("string")
    if seed is not None:
        key = F.concat(key, F.lit(f"#{seed}"))
    shuffled = df.withColumn("_order", F.md5(key))
    return row_numbers(shuffled, ["_order", "account_id"], within=[label], name="_place").drop("_order")


def stratified_folds(df: DataFrame, label: str, folds: int, name: str = "fold", seed: int | None = None) -> DataFrame:
    """Folds 1..``folds`` of nearly equal size within each label, in an order hashed from the account."""
    return (_label_order(df, label, seed)
            .withColumn(name, ((F.col("_place") - 1) % folds + 1).cast("int")).drop("_place"))


def stratified_split(df: DataFrame, label: str, share: float = 0.9, name: str = "in_train",
                     seed: int | None = None) -> DataFrame:
    """Mark the first ``share`` of each label, in the hashed order, for training."""
    placed = _label_order(df, label, seed)
    sizes = placed.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_size"))
    return (
        # One row per class.
        placed.join(F.broadcast(sizes), placed[label].eqNullSafe(sizes["_label"]))
        .withColumn(name, (F.col("_place") <= F.col("_size") * F.lit(share)).cast("int"))
        .drop("_place", "_size", "_label")
    )


def split_by_label_presence(df: DataFrame, label: str = "default_flag") -> tuple[DataFrame, DataFrame]:
    """Labelled rows and rows to score."""
    return df.filter(F.col(label).isNotNull()), df.filter(F.col(label).isNull())


def oof_target_encode(df: DataFrame, code: str, label: str, fold: str, name: str) -> DataFrame:
    """Mean label of the rows with the same code outside the row's fold; all of them for unlabelled rows.

    One row per code carries its totals and a map with the part of each fold, so a fold's mean is a
    subtraction and the rows join by code alone. A code seen in one fold only has no value there.
    NULL is a code of its own.
    """
    parts = df.filter(F.col(label).isNotNull()).groupBy(code, fold).agg(
        F.sum(label).alias("_bad"), F.count(F.lit(1)).alias("_rows"))
    lookup = parts.groupBy(F.col(code).alias("_code")).agg(
        F.sum("_bad").alias("_all_bad"), F.sum("_rows").alias("_all_rows"),
        # At most one entry per fold.
        F.map_from_entries(F.collect_list(F.struct(F.col(fold), F.struct("_bad", "_rows")))).alias("_parts"))
    joined = df.join(lookup, df[code].eqNullSafe(lookup["_code"]), "left")
    own = F.when(df[label].isNotNull(), F.try_element_at("_parts", df[fold]))
    return joined.select(
        *[df[c] for c in df.columns],
        F.try_divide(F.col("_all_bad") - F.coalesce(own["_bad"], F.lit(0)),
                     F.col("_all_rows") - F.coalesce(own["_rows"], F.lit(0))).alias(name))


def group_mean_target(df: DataFrame, group: str, label: str, name: str = "in_sample_mean") -> DataFrame:
    """Mean label per group, in sample: it contains the row's own label, so it is no model input."""
    return df.filter(F.col(label).isNotNull()).groupBy(group).agg(F.avg(label).alias(name))


def value_ntile(df: DataFrame, column: str, buckets: int = 10, name: str | None = None) -> DataFrame:
    """Bucket of each account by a value, ties by account; NULL has no bucket."""
    name = name or f"{column}_ntile"
    known = distributed_ntile(df.filter(F.col(column).isNotNull()), [column, "account_id"], buckets, name)
    unknown = df.filter(F.col(column).isNull()).withColumn(name, F.lit(None).cast("int"))
    return known.unionByName(unknown)


def one_hot(df: DataFrame, columns: Sequence[str], levels: dict[str, Sequence[str | None]] | None = None) -> DataFrame:
    """0/1 columns for every level but the first of each column; other columns are kept.

    NULL (None) is a level of its own, the last one. Levels are read from the data unless given; a value outside the
    given levels is an error when it is read, since it would look like the first level.
    """
    levels = dict(levels or {})
    dummies = []
    for c in columns:
        names = levels.get(c) or distinct_values(df, c)
        ordered = sorted((n for n in names if n is not None)) + [None] * (None in names)
        value = F.col(c).cast("string")
        known = value.isin([n for n in ordered if n is not None]) | (value.isNull() if None in names else F.lit(False))
        unseen = F.raise_error(F.concat(F.lit(f"level outside those of {c}: "), F.coalesce(value, F.lit("NULL"))))
        dummies += [F.when(known, value.eqNullSafe(F.lit(n)).cast("int")).otherwise(unseen.cast("int")).alias(f"{c}_{label}")
                    for n, label in list(zip(ordered, value_labels(ordered)))[1:]]
    return df.select(*[c for c in df.columns if c not in columns], *dummies)


def zscore_wide_columns(df: DataFrame, columns: Sequence[str], min_range: float = 1.0) -> DataFrame:
    """Standardise the columns whose range exceeds ``min_range``; dummies stay 0/1."""
    facts = df.agg(*[
        e.alias(f"{s}_{i}") for i, c in enumerate(columns) for s, e in {
            "range": F.max(c).cast("double") - F.min(c).cast("double"),
            "mean": F.avg(F.col(c).cast("double")),
            "sd": F.stddev_samp(F.col(c).cast("double")),
        }.items()
    ]).first()  # one row of statistics
    scaled = {
        c: (F.col(c).cast("double") - facts[f"mean_{i}"]) / facts[f"sd_{i}"]
        for i, c in enumerate(columns)
        if facts[f"range_{i}"] is not None and facts[f"range_{i}"] > min_range and facts[f"sd_{i}"]
    }
    return df.withColumns(scaled) if scaled else df
