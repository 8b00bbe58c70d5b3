"""Statement panels: rank from the last one, period buckets, ratios, limits and wide series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfeat.functions.columns import widen
from ledgerfeat.functions.scalar import flag, ratio, strict_greatest
from ledgerfeat.operators.skew import BLOCK, NONE, HotKeys, cold_rows, is_hot, range_blocks

# The rank from the last statement that opens each period bucket.
QUARTER_RANKS = {4: (1, 4), 3: (5, 7), 2: (8, 10), 1: (11, 14)}
HALF_RANKS = {1: (1, 7), 2: (8, 14)}
OVERFLOW = 5
DAYS_AFTER_LAST = 30
QUARTERS = (1, 2, 3, 4, OVERFLOW)
HALVES = (1, 2, OVERFLOW)
STATEMENTS_PER_YEAR = 14

#: Ranks that get columns unless the caller names others; ranks in a block of a series; and the series of a statement.
NAMED_RANKS = range(1, STATEMENTS_PER_YEAR + 1)
SERIES_BLOCK = 64
SERIES = ("credit_ratio", "balance_delta", "total_balance")



def _newest_first() -> list[Column]:
    return [F.desc("statement_date"), F.desc("statement_id")]


def correct_balance(statements: DataFrame) -> DataFrame:
    """Total balance raised to the cash balance; the reported total stays in ``raw_total_balance``."""
    return statements.withColumns({
        "raw_total_balance": F.col("total_balance"),
        "total_balance": strict_greatest("total_balance", "cash_balance"),
    })


def _ordered_columns(statements: DataFrame) -> DataFrame:
    # One window order serves all four columns, newest statement first.
    w = W.partitionBy("account_id").orderBy(*_newest_first())
    return statements.withColumns({
        "rank_from_last": F.row_number().over(w).cast("long"),
        "last_statement_date": F.first("statement_date").over(w),
        "_next_date": F.lag("statement_date").over(w),
        "prev_total_balance": F.lead("total_balance").over(w),
    })


def _ordered_columns_in_blocks(statements: DataFrame) -> DataFrame:
    """The columns of ``_ordered_columns`` for accounts too large for one task."""
    blocks = range_blocks(statements, ["account_id", *_newest_first()])
    w = W.partitionBy("account_id", BLOCK).orderBy(*_newest_first())
    key = F.struct("statement_date", "statement_id")
    edges = blocks.groupBy("account_id", BLOCK).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("statement_date").alias("_oldest_date"),
        F.max("statement_date").alias("_newest_date"),
        F.max_by("total_balance", key).alias("_newest_balance"),
    )
    along = W.partitionBy("account_id").orderBy(BLOCK)
    whole = W.partitionBy("account_id")
    carried = edges.select(
        "account_id", BLOCK,
        F.coalesce(F.sum("_rows").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_newer_rows"),
        F.lag("_oldest_date").over(along).alias("_block_next_date"),
        F.lead("_newest_balance").over(along).alias("_block_prev_balance"),
        F.max("_newest_date").over(whole).alias("_account_last_date"),
        F.col("_rows").alias("_block_rows"),
        F.count(F.lit(1)).over(whole).alias("_blocks"),
    ).filter(F.col("_blocks") > 1)  # accounts that straddle a range boundary: fewer rows than twice the ranges
    first, last = F.col("_rn") == 1, F.col("_rn") == F.col("_block_rows")
    return (
        blocks.withColumns({
            "_rn": F.row_number().over(w),
            "_lag": F.lag("statement_date").over(w),
            "_lead": F.lead("total_balance").over(w),
            "_first": F.first("statement_date").over(w),
        })
        .join(F.broadcast(carried), ["account_id", BLOCK], "left")
        .withColumns({
            "rank_from_last": F.col("_rn") + F.coalesce("_newer_rows", F.lit(0)),
            "last_statement_date": F.coalesce("_account_last_date", "_first"),
            "_next_date": F.when(first, F.col("_block_next_date")).otherwise(F.col("_lag")),
            "prev_total_balance": F.when(last, F.col("_block_prev_balance")).otherwise(F.col("_lead")),
        })
        .select(*statements.columns, "rank_from_last", "last_statement_date", "_next_date", "prev_total_balance")
    )


def period_bucket(rank: Column, ranks: dict[int, tuple[int, int]]) -> Column:
    bucket = F
    for value, (low, high) in ranks.items():
        bucket = bucket.when(rank.between(low, high), value)
    return bucket.otherwise(OVERFLOW)


def ratio_features(total: str, cash: str, limit: str, prefix: str = "") -> dict[str, Column]:
    """Balance over limit, cash over limit, cash over balance (0 without cash)."""
    return {
        f"{prefix}credit_ratio": ratio(total, limit),
        f"{prefix}cash_ratio": ratio(cash, limit),
        f"{prefix}cash_on_credit_ratio": F.when(F.col(cash) > 0, ratio(cash, total))
        .when(F.col(cash).isNotNull(), F.lit(0.0)),
    }


def enrich_statements(statements: DataFrame, hot: HotKeys = NONE) -> DataFrame:
    """Rank, buckets, next and last dates, previous balance and ratios on every statement."""
    corrected = correct_balance(statements)
    ordered = _ordered_columns(cold_rows(corrected, "account_id", hot))
    if hot:
        ordered = ordered.unionByName(
            _ordered_columns_in_blocks(corrected.filter(is_hot("account_id", hot))))
    rank = F.col("rank_from_last")
    return ordered.withColumns({
        "q": period_bucket(rank, QUARTER_RANKS),
        "h": period_bucket(rank, HALF_RANKS),
        "is_last_statement": flag(F.col("statement_date") == F.col("last_statement_date")),
        "next_statement_date": F.coalesce("_next_date", F.date_add("statement_date", DAYS_AFTER_LAST)),
        "balance_delta": F.col("total_balance") - F.col("prev_total_balance"),
        **ratio_features("total_balance", "cash_balance", "credit_limit"),
        **ratio_features("raw_total_balance", "cash_balance", "credit_limit", prefix="raw_"),
    }).drop("_next_date", "prev_total_balance")


def quarter_limits(enriched: DataFrame) -> DataFrame:
    """First and last day of each account quarter; open ends are NULL."""
    quarters = (
        enriched.filter(F.col("q") != OVERFLOW).groupBy("account_id", "q")
        .agg(F.min("statement_date").alias("_start"))
    )
    following = F.lead("_start").over(W.partitionBy("account_id").orderBy("q"))
    return quarters.select(
        "account_id", "q",
        F.when(F.col("q") != 1, F.col("_start")).alias("start_date"),
        F.when(F.col("q") != 4, F.date_sub(following, 1)).alias("end_date"),
    )


def quarter_starts(enriched: DataFrame) -> DataFrame:
    """One row per account: the first day of each quarter, for placing dates in quarters."""
    return enriched.filter(F.col("q") != OVERFLOW).groupBy("account_id").agg(*[
        F.min(F.when(F.col("q") == q, F.col("statement_date"))).alias(f"_q{q}_start") for q in (1, 2, 3, 4)
    ])


def quarter_of(day: Column) -> Column:
    """Quarter of a date, given the columns of ``quarter_starts``; NULL before the first one.

    Quarters follow each other without gaps, and quarter 1 is open towards the past.
    """
    return (
        F.when(day >= F.col("_q4_start"), 4)
        .when(day >= F.col("_q3_start"), 3)
        .when(day >= F.col("_q2_start"), 2)
        .when(F.col("_q1_start").isNotNull(), 1)
    )


def statement_series(df: DataFrame, columns: Sequence[str] = SERIES, block: int = SERIES_BLOCK) -> DataFrame:
    """Every series of an account by statement rank: ``account_id``, ``block``, ``ranks`` and one array per column.

    Block ``b`` holds ranks ``b * block + 1`` to ``(b + 1) * block`` in order. No row and no schema grows with the number of
    an account's statements, and an account with many spreads over as many groups as it has blocks.
    """
    value = F.struct("rank_from_last", *[F.col(c).cast("double").alias(c) for c in columns])
    rows = df.groupBy("account_id", F.floor((F.col("rank_from_last") - 1) / block).alias("block")).agg(
        F.sort_array(F.collect_list(value)).alias("_rows"))  # at most ``block`` rows
    return rows.select("account_id", "block", F.col("_rows.rank_from_last").alias("ranks"),
                       *[F.col(f"_rows.{c}").alias(c) for c in columns])


def values_at(series: DataFrame, ranks: Sequence[int], columns: Sequence[str] = SERIES, block: int = SERIES_BLOCK) -> DataFrame:
    """``<column>_t_minus_<rank>`` for the ranks asked for, read from their blocks; accounts without them have NULL."""
    def at(c: str, r: int) -> Column:
        place = F.array_position("ranks", F.lit(r)).cast("int")
        here = (F.col("block") == (r - 1) // block) & (place > 0)
        return F.max(F.when(here, F.element_at(c, F.when(place > 0, place)))).alias(f"{c}_t_minus_{r}")
    return series.groupBy("account_id").agg(*[at(c, r) for r in ranks for c in columns])


def ranks_present(statements: DataFrame) -> range:
    """Every statement rank up to the longest account's last one (one number from the data)."""
    sizes = statements.groupBy("account_id").agg(F.count(F.lit(1)).alias("_rows"))
    return range(1, (sizes.agg(F.max("_rows")).first()[0] or 0) + 1)


def wide_series(df: DataFrame, columns: Sequence[str], ranks: Sequence[int] = NAMED_RANKS) -> DataFrame:
    """One column per series and named statement rank, in a single aggregation; ``statement_series`` has all ranks."""
    return widen(df, "account_id", "rank_from_last", ranks, columns, lambda m, r: f"{m}_t_minus_{r}")


def wide_statement_features(enriched: DataFrame, ranks: Sequence[int] = NAMED_RANKS) -> DataFrame:
    return wide_series(enriched, SERIES, ranks)
