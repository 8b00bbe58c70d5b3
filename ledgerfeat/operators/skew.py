"""Ordered work that must not end up in one task.

Two situations need care: accounts that hold a large part of all rows, and an order over the whole
table. Large accounts are found first; their rows are range-partitioned by (account, order), each
range is worked on alone, and small per-range totals are carried forward. The same ranges serve the
global orders. Every range boundary lies inside at most one group, so at most one carry row per
range matters, whatever the number of groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfeat.session import pin

BLOCK = "_block"

# A key below this many rows fits a task, also as an array.
HOT_KEY_FLOOR = 1_000_000
# Longest list of hot keys; with more of them, all keys are split.
MAX_HOT_KEYS = 256


@dataclass(frozen=True)
class HotKeys:
    """Keys whose rows are split over tasks: a short list, or every key."""

    keys: tuple = ()
    every: bool = False

    def __bool__(self) -> bool:
        return self.every or bool(self.keys)


NONE = HotKeys()


def hot_keys(df: DataFrame, key: str, floor: int = HOT_KEY_FLOOR, at_most: int = MAX_HOT_KEYS,
             counts: str | None = None) -> HotKeys:
    """Keys with at least ``floor`` rows; every key when more than ``at_most`` are that large.

    With ``counts`` a row stands for as many rows as that column says.
    """
    rows = (
        df.groupBy(key).agg((F.sum(counts) if counts else F.count(F.lit(1))).alias("rows"))
        .filter(F.col("rows") >= floor)
        .limit(at_most + 1)
        .collect()
    )
    if len(rows) > at_most:
        return HotKeys(every=True)
    return HotKeys(tuple(sorted(row[0] for row in rows)))


def is_hot(key: str, hot: HotKeys) -> Column:
    if hot.every or not hot.keys:
        return F.lit(hot.every)
    return F.coalesce(F.col(key).isin(list(hot.keys)), F.lit(False))


def cold_rows(df: DataFrame, key: str, hot: HotKeys) -> DataFrame:
    return df.filter(~is_hot(key, hot)) if hot else df


def few_or_plain(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Broadcast a side that has a few rows per listed hot key; leave it to the planner otherwise."""
    return df if hot.every else F.broadcast(df)


def join_per_key(facts: DataFrame, per_key: DataFrame, key: str, hot: HotKeys = NONE, how: str = "left") -> DataFrame:
    """Join many rows per key to one row per key.

    Rows of listed hot keys stay where they are: the other side has one row for each, so at most
    MAX_HOT_KEYS rows are broadcast for them.
    """
    if not hot or hot.every:
        return facts.join(per_key, key, how)
    cold = facts.filter(~is_hot(key, hot)).join(per_key, key, how)
    few = F.broadcast(per_key.filter(is_hot(key, hot)))
    return cold.unionByName(facts.filter(is_hot(key, hot)).join(few, key, how))


def spread_by_key(df: DataFrame, key: str, hot: HotKeys, parts: int | None = None) -> list[DataFrame]:
    """Rows spread over tasks by ``key``, and apart from them, as they lie, those of hot keys if there are any."""
    cold = cold_rows(df, key, hot)
    spread = cold.repartition(parts, key) if parts else cold.repartition(key)
    return [spread, df.filter(is_hot(key, hot))] if hot else [spread]


def range_blocks(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Split ``df`` into consecutive ranges of ``order`` and number them in ``BLOCK``.

    The result is checkpointed: the range bounds come from a sample, and every later use must see
    the same ones.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pin(df.repartitionByRange(parts, *order).withColumn(BLOCK, F.spark_partition_id()))


def running_totals(df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, Column],
                   within: Sequence[str] = ()) -> DataFrame:
    """Add inclusive running sums along ``order``, restarting for each value of ``within``."""
    blocks = range_blocks(df.withColumns(dict(totals)), [*within, *order])
    local = W.partitionBy(*within, BLOCK).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*within).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    carried = (
        blocks.groupBy(*within, BLOCK).agg(*[F.sum(t).alias(f"_sum_{t}") for t in totals])
        .select(
            *[F.col(c).alias(f"_key_{c}") for c in within],
            F.col(BLOCK).alias("_key_block"),
            F.count(F.lit(1)).over(earlier).alias("_earlier"),
            *[F.sum(f"_sum_{t}").over(earlier).alias(f"_before_{t}") for t in totals],
        )
        # At most one group continues from an earlier range into each range.
        .filter(F.col("_earlier") > 0)
    )
    same = blocks[BLOCK] == carried["_key_block"]
    for c in within:
        same = same & blocks[c].eqNullSafe(carried[f"_key_{c}"])
    out = blocks.withColumns({t: F.sum(t).over(local) for t in totals})
    return (
        out.join(F.broadcast(carried), same, "left")
        .withColumns({t: F.col(t) + F.coalesce(f"_before_{t}", F.lit(0)) for t in totals})
        .select(*df.columns, *totals)
    )


def row_numbers(df: DataFrame, order: Sequence[Column | str], within: Sequence[str] = (),
                name: str = "row_number") -> DataFrame:
    """Distributed ``row_number`` along a unique ``order``."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, within)


def distributed_ntile(df: DataFrame, order: Sequence[Column | str], buckets: int, name: str) -> DataFrame:
    """SQL ``ntile`` over the whole table along a unique ``order``, without one task seeing all rows."""
    numbered = row_numbers(df, order, name="_rn")
    size = numbered.agg(F.max("_rn")).first()[0] or 0
    base, extra = divmod(size, buckets)
    position = F.col("_rn") - 1
    wide = extra * (base + 1)
    bucket = F.when(position < wide, F.floor(position / F.lit(base + 1))).otherwise(
        extra + F.floor((position - wide) / F.lit(max(base, 1))))
    return numbered.withColumn(name, (bucket + 1).cast("int")).drop("_rn")


def large_group_quantiles(df: DataFrame, keys: Sequence[str], value: str, names: Mapping[str, float],
                          hot: HotKeys = NONE) -> DataFrame:
    """Exact interpolated quantiles of groups of any size.

    ``percentile`` keeps all distinct values of a group in one task. Here equal values are counted
    first, counted upwards along ranges of the value, and only the neighbours of each position kept.
    """
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    ranked = running_totals(counts, ["_value"], {"_upto": F.col("_n")}, within=keys)
    sizes = ranked.groupBy(*keys).agg(F.max("_upto").alias("_size"))
    placed = ranked.join(few_or_plain(sizes, hot), list(keys))
    ends = []
    for name, p in names.items():
        position = (F.col("_size") - 1) * F.lit(p)
        ends.append(F.min(F.when(F.col("_upto") > F.floor(position), F.col("_value"))).alias(f"_low_{name}"))
        ends.append(F.min(F.when(F.col("_upto") > F.ceil(position), F.col("_value"))).alias(f"_high_{name}"))
    bounds = placed.groupBy(*keys).agg(F.max("_size").alias("_size"), *ends)
    result = []
    for name, p in names.items():
        position = (F.col("_size") - 1) * F.lit(p)
        share = position - F.floor(position)
        low, high = F.col(f"_low_{name}"), F.col(f"_high_{name}")
        result.append((low + (high - low) * share).alias(name))
    return bounds.select(*keys, *result)
