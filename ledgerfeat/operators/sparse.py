"""Category features as sparse vectors, for any number of levels.

A dictionary numbers every level that the data holds, and an account keeps entries for its own levels only. No column, no
schema and no list on the driver grows with the levels; wide columns remain for lists that the caller names.
"""

from __future__ import annotations

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfeat.functions.scalar import ratio
from ledgerfeat.operators.skew import row_numbers


def level_dictionary(profile: DataFrame) -> DataFrame:
    """``variable``, ``value`` and ``index`` (from 0) of every level in a profile; NULL is a level of its own, before the others."""
    levels = profile.select("variable", "value").distinct()
    return row_numbers(levels, ["variable", "value"], name="_place").select(
        "variable", "value", (F.col("_place") - 1).alias("index"))


def share_entries(profile: DataFrame) -> DataFrame:
    """``account_id``, ``variable``, ``value`` and ``share``: each level's part of the account's spending, for all levels it has."""
    total = F.sum("amount").over(W.partitionBy("account_id", "variable")).cast("double")
    return profile.select("account_id", "variable", "value", ratio("amount", total).alias("share"))


def presence_entries(profile: DataFrame) -> DataFrame:
    """``account_id``, ``variable``, ``value`` and ``share`` 1: one-hot entries of the levels an account has."""
    return profile.select("account_id", "variable", "value", F.lit(1.0).alias("share")).distinct()


def numbered(entries: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``account_id``, ``index`` and ``share``; levels outside the dictionary have no entry."""
    known = dictionary.withColumnsRenamed({"variable": "_variable", "value": "_value"})
    same = (entries["variable"] == known["_variable"]) & entries["value"].eqNullSafe(known["_value"])
    return entries.join(known, same).select("account_id", "index", "share")


def sparse_vectors(entries: DataFrame, size: int, name: str = "levels") -> DataFrame:
    """One sparse vector per account from numbered entries; zero and missing shares take no place.

    Spark has no built-in that makes a sparse vector of two arrays, hence one small call per account.
    """
    known = entries.filter(F.col("share").isNotNull() & (F.col("share") != 0))
    rows = known.groupBy("account_id").agg(F.sort_array(F.collect_list(F.struct("index", "share"))).alias("_entries"))
    vector = F.udf(lambda indices, values: SparseVector(size, indices, values), VectorUDT())
    return rows.select("account_id", vector("_entries.index", "_entries.share").alias(name))


def vector_totals(vectors: DataFrame, name: str = "levels") -> DataFrame:
    """``size``, ``n_levels`` (entries) and ``sum_shares`` of every vector; its places without an entry are never written out."""
    def totals(v):
        return int(v.size), int(v.numNonzeros()), sum(v.values.tolist())
    found = F.udf(totals, "size long, n_levels long, sum_shares double")
    return vectors.select("account_id", found(name).alias("_totals")).select("account_id", "_totals.*")
