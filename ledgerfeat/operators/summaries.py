"""Statement summaries: one generated aggregation per level (quarter, half, whole history)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerfeat.functions.columns import unpivot_in_place, widen
from ledgerfeat.functions.scalar import flag, ratio_or_one
from ledgerfeat.functions.stats import QUARTILES, basic, quantile_of_sorted, sample_kurtosis, sample_skewness
from ledgerfeat.operators.skew import NONE, HotKeys, cold_rows, is_hot, large_group_quantiles
from ledgerfeat.operators.statements import HALVES, QUARTERS

# The summarised measures and which statistics each group of them gets.
MEASURES = (
    "delq_cycle", "credit_limit", "cash_balance", "total_balance",
    "credit_ratio", "cash_ratio", "cash_on_credit_ratio",
)
SPREAD_MEASURES = MEASURES[:-1]
POSITIVE_COUNTS = ("total_balance", "cash_balance", "delq_cycle")


def _names(measures: Sequence[str], suffix: str = "") -> dict[str, tuple[str, float]]:
    """Quartile columns: name to (measure, position)."""
    return {f"{p}_{m}{suffix}": (m, at) for m in measures for p, at in QUARTILES.items()}


def with_quartiles(df: DataFrame, aggregates: Sequence[Column], measures: Sequence[str], hot: HotKeys = NONE,
                   period: str | None = None, values: Sequence[int] = ()) -> DataFrame:
    """``aggregates`` per account and exact quartiles of ``measures``, over all rows or per ``period`` value.

    The rows of an account are collected once and its quartiles read off sorted arrays; hot accounts
    are left out of that, counted in distributed order instead, and appended.
    """
    fields = ", ".join([*([period] if period else []), *[f"CAST({m} AS DOUBLE) AS {m}" for m in measures]])
    collected = cold_rows(df, "account_id", hot).groupBy("account_id").agg(
        *aggregates, F.expr(f"collect_list(struct({fields})) AS _rows"))
    plain = [c for c in collected.columns if c != "_rows"]
    parts = {f"_{period.upper()}{v}": f"filter(_rows, r -> r.{period} = {v})" for v in values} if period else {"": "_rows"}
    sources = collected.selectExpr(*plain, *[f"{rows} AS `_rows{suffix}`" for suffix, rows in parts.items()])
    arrays = sources.selectExpr(*plain, *[
        f"sort_array(filter(transform(`_rows{suffix}`, r -> r.{m}), x -> x IS NOT NULL)) AS `_sorted_{m}{suffix}`"
        for suffix in parts for m in measures])
    wanted = {n: at for suffix in parts for n, at in _names(measures, suffix).items()}
    out = arrays.selectExpr(*plain, *[
        f"{quantile_of_sorted(f'`_sorted_{m}{n[len(f'p25_{m}'):]}`', at)} AS `{n}`" for n, (m, at) in wanted.items()])
    if not hot:
        return out
    large = df.filter(is_hot("account_id", hot))
    keys = ["account_id", *([period] if period else [])]
    long = large.select(*keys, *[F.col(m).cast("double").alias(m) for m in measures]).unpivot(
        keys, list(measures), "measure", "value")
    found = large_group_quantiles(long, [*keys, "measure"], "value", QUARTILES, hot)
    label = F.concat_ws("", "measure", *([F.lit(f"_{period.upper()}"), F.col(period)] if period else []))
    groups = [f"{m}{suffix}" for suffix in parts for m in measures]
    wide = widen(found.withColumn("_group", label), "account_id", "_group", groups, list(QUARTILES), lambda p, g: f"{p}_{g}")
    rest = large.groupBy("account_id").agg(*aggregates) if aggregates else large.select("account_id").distinct()
    return out.unionByName(rest.join(wide, "account_id", "left").select(*out.columns))


def _numbers(enriched: DataFrame, skewed: Sequence[str], period: str | None = None,
             values: Sequence[int] = ()) -> DataFrame:
    """Sums, extremes, means and moments of every measure, wide.

    The measures are unpivoted first: one small aggregation over (account, measure) compiles to tight
    code, where dozens of aggregates side by side do not. Rows that come partitioned by account stay so to the end.
    """
    keys = ["account_id", *([period] if period else [])]
    long = unpivot_in_place(enriched, keys, {m: F.col(m).cast("double") for m in MEASURES}, "measure", "value")
    stats = long.groupBy(*keys, "measure").agg(
        F.expr("count_if(value > 0)").alias("count_positive"),
        *basic("value", {"sum": "sum", "max": "max", "avg": "mean", "min": "min", "stddev_samp": "sd"}),
        sample_kurtosis("value").alias("kurtosis"), sample_skewness("value").alias("skewness"))
    suffixes = [f"_{period.upper()}{v}" for v in values] if period else [""]
    if period:
        stats = stats.withColumn("measure", F.concat_ws("", "measure", F.lit(f"_{period.upper()}"), F.col(period))).drop(period)
    names = [c for c in stats.columns if c not in ("account_id", "measure")]
    wide = widen(stats, "account_id", "measure", [f"{m}{x}" for x in suffixes for m in MEASURES], names,
                 lambda stat, group: f"{stat}_{group}")
    wanted = [
        *[("count_positive", m) for m in POSITIVE_COUNTS],
        *[(stat, m) for m in MEASURES for stat in ("sum", "max", "mean", "min", "kurtosis")],
        *[("skewness", m) for m in skewed], *[("sd", m) for m in SPREAD_MEASURES],
    ]
    chosen = [f"{stat}_{m}{x}" for x in suffixes for stat, m in wanted]
    return wide.selectExpr("account_id", *[f"`{c}`" for c in chosen])


def summary_by_period(enriched: DataFrame, period: str, values: Sequence[int], hot: HotKeys = NONE) -> DataFrame:
    """All measures by account and ``period`` (``q`` or ``h``), one column per measure and value."""
    quartiles = with_quartiles(enriched, [], SPREAD_MEASURES, hot, period, values)
    return _numbers(enriched, SPREAD_MEASURES, period, values).join(quartiles, "account_id", "left")


def summary_quarter(enriched: DataFrame, hot: HotKeys = NONE, quarters: Sequence[int] = QUARTERS) -> DataFrame:
    return summary_by_period(enriched, "q", quarters, hot)


def summary_semester(enriched: DataFrame, hot: HotKeys = NONE, halves: Sequence[int] = HALVES) -> DataFrame:
    return summary_by_period(enriched, "h", halves, hot)


def last_first_values(measures: Sequence[str] = MEASURES) -> list[Column]:
    """Value at the last and at the first period."""
    when = "struct(period, statement_date, statement_id)"
    return [
        F.expr(f"{pick}(CAST({m} AS DOUBLE), {when}) AS {name}_{m}")
        for pick, name in (("max_by", "last"), ("min_by", "first")) for m in measures
    ]


def new_extreme_flags(measures: Sequence[str] = ("credit_limit", "credit_ratio", "cash_ratio")) -> dict[str, Column]:
    """Is the last value the highest (lowest) of a series that moved?"""
    out = {}
    for m in measures:
        last, low, high = F.col(f"last_{m}"), F.col(f"min_{m}"), F.col(f"max_{m}")
        out[f"at_new_max_{m}"] = flag((last == high) & (last > low))
        out[f"at_new_min_{m}"] = flag((last == low) & (last < high))
    return out


def annual_deltas() -> dict[str, Column]:
    out = {
        f"annual_delta_{m}": F.col(f"last_{m}") - F.col(f"first_{m}")
        for m in ("credit_ratio", "cash_ratio", "total_balance", "credit_limit")
    }
    out["last_on_max_credit_ratio"] = ratio_or_one("last_credit_ratio", "max_credit_ratio")
    out["last_credit_ratio_x_last_delq_cycle"] = F.col("last_credit_ratio") * F.col("last_delq_cycle")
    return out


def summary_annual(enriched: DataFrame, hot: HotKeys = NONE) -> DataFrame:
    """All measures over the whole history, with last and first values and what follows from them."""
    ends = with_quartiles(
        enriched, [F.count(F.lit(1)).alias("count_statements"), *last_first_values()], SPREAD_MEASURES, hot)
    return _numbers(enriched, MEASURES).join(ends, "account_id", "left").withColumns(
        {**new_extreme_flags(), **annual_deltas()})


def quarter_ratio(min_denominator: float = 1.0) -> Column:
    """Mean credit ratio of quarter 4 over quarter 1, 1 unless the latter exceeds ``min_denominator``."""
    return ratio_or_one("mean_credit_ratio_Q4", "mean_credit_ratio_Q1", above=min_denominator)
