"""Transaction features: shares, diversity, favourites, moves, gaps and summaries.

Features of category-like columns start from one long table, the profile: rows and amount per
account, variable and value. It is one shuffle whatever the number of variables, and partial sums
shrink hot accounts before it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfeat.functions.columns import unpivot_in_place, widen
from ledgerfeat.functions.scalar import days_between, flag, not_in, ratio
from ledgerfeat.functions.stats import QUARTILES, basic, exact_quantiles, sample_kurtosis, sample_skewness
from ledgerfeat.operators.skew import NONE, HotKeys, distributed_ntile, join_per_key, spread_by_key
from ledgerfeat.operators.statements import quarter_of, quarter_starts
from ledgerfeat.operators.summaries import with_quartiles

# Counted columns, columns of the spending shares, columns grouped by frequency,
# categories never taken as favourite, and the code of pooled values.
DISTINCT_COLUMNS = ("city", "category", "country", "txn_type", "sic_group")
DECILE_COLUMNS = ("category", "city", "country")
SHARE_COLUMNS = (
    "decision", "category", "country", "country_decile",
    "city_decile", "sic_group", "txn_category", "txn_type",
)
DIVERSITY_COLUMNS = ("city", "country", "category")
EXCLUDED_CATEGORIES = ("WW", "D")
OTHER_CODE = "999999999999"
MIN_ACCOUNTS = 10
TXN_QUARTERS = (1, 2, 3, 4)
NULL_NAME = "NA"


def transactions_in_quarters(transactions: DataFrame, enriched: DataFrame, hot: HotKeys = NONE) -> DataFrame:
    """Transactions that fall in a quarter of their account, with that quarter in ``q``."""
    dated = transactions.withColumn("txn_date", F.to_date("at"))
    placed = join_per_key(dated, quarter_starts(enriched), "account_id", hot, how="inner")
    return (
        placed.withColumn("q", quarter_of(F.col("txn_date")))
        .filter(F.col("q").isNotNull())
        .select(*dated.columns, "q")
    )


def category_profile(transactions: DataFrame, variables: Sequence[str], by: Sequence[str] = ("account_id",),
                     hot: HotKeys | None = None, parts: int | None = None) -> DataFrame:
    """Rows (``n``) and ``amount`` per group, variable and value; NULL is a value of its own.

    Given the ``hot`` accounts, the others are spread by account first, in ``parts`` tasks: one row a transaction is shuffled
    and not one a transaction and variable, and later steps by account stay where they are.
    """
    def counted(rows: DataFrame) -> DataFrame:
        long = unpivot_in_place(rows, [*by, "amount"], {v: F.col(v).cast("string") for v in variables}, "variable", "value")
        return long.groupBy(*by, "variable", "value").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount"))
    if hot is None:
        return counted(transactions)
    needed = transactions.select(*dict.fromkeys([*by, "amount", *variables]))
    return reduce(DataFrame.unionByName, map(counted, spread_by_key(needed, "account_id", hot, parts)))


def of_variable(profile: DataFrame, variable: str) -> DataFrame:
    return profile.filter(F.col("variable") == variable)


def distinct_counts(profile: DataFrame, variables: Sequence[str] = DISTINCT_COLUMNS,
                    by: Sequence[str] = ("account_id",)) -> DataFrame:
    """Number of distinct values of each variable per group."""
    return profile.groupBy(*by).agg(*[
        F.count_if(F.col("variable") == v).alias(f"n_distinct_{v}") for v in variables
    ])


def diversity_index(profile: DataFrame, variables: Sequence[str] = DIVERSITY_COLUMNS) -> DataFrame:
    """Sum of squared row shares: 1 for a single value, 1/k for k equal ones."""
    n = {v: f"CASE WHEN variable = '{v}' THEN CAST(n AS DOUBLE) END" for v in variables}
    return profile.groupBy("account_id").agg(*[
        F.expr(f"sum(power({n[v]}, 2)) / power(sum({n[v]}), 2) AS index_{v}") for v in variables])


def favorite_value(profile: DataFrame, variable: str, name: str, by: Sequence[str] = ("account_id",),
                   exclude: Sequence[str] = (), numeric: bool = False) -> DataFrame:
    """Most frequent value per group; ties go to the smaller value, NULL comes last.

    A minimum over (−n, value) needs no window, so it is combined before the shuffle.
    ``numeric`` orders codes by number instead of by text.
    """
    rows = of_variable(profile, variable)
    if exclude:
        rows = rows.filter(not_in("value", exclude))
    number = F.expr("try_cast(value AS BIGINT)") if numeric else F.lit(None).cast("long")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("value").isNull().alias("missing"),
                          number.isNull().alias("text"), number.alias("number"), F.col("value").alias("value")))
    return rows.groupBy(*by).agg(best["value"].alias(name))


def pool_rare(favorites: DataFrame, column: str, name: str, min_accounts: int = MIN_ACCOUNTS) -> DataFrame:
    """Replace values held by at most ``min_accounts`` rows with one common code."""
    sizes = favorites.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("_holders"))
    return (
        favorites.join(sizes, favorites[column].eqNullSafe(sizes["_value"]), "left")
        .select(
            *[favorites[c] for c in favorites.columns],
            F.when(favorites[column].isNotNull(),
                   F.when(F.col("_holders") > min_accounts, favorites[column]).otherwise(OTHER_CODE)).alias(name),
        )
    )


def city_moves(quarter_favorites: DataFrame, column: str = "favorite_city") -> DataFrame:
    """Pooled favourite city of each quarter, and whether it changed from one to the next."""
    coded = pool_rare(quarter_favorites, column, f"{column}_code")
    wide = widen(coded, "account_id", "q", TXN_QUARTERS, [f"{column}_code"], lambda m, q: f"{m}_Q{q}")
    moved = {
        f"moved_q{q}": F.coalesce(
            flag(F.col(f"{column}_code_Q{q}") != F.col(f"{column}_code_Q{q - 1}")), F.lit(0))
        for q in (2, 3, 4)
    }
    return wide.withColumns(moved).withColumn(
        "moves", F.col("moved_q2") + F.col("moved_q3") + F.col("moved_q4"))


def distinct_values(df: DataFrame, column: str, at_most: int = 1000) -> list[str | None]:
    """Values of a column as text, for columns that become features; NULL, if present, comes last as None."""
    text = F.col(column).cast("string").alias("v")
    found = [r[0] for r in df.select(text).distinct().limit(at_most + 1).collect()]
    if len(found) > at_most:
        raise ValueError(f"{column} has more than {at_most} values; group it before making columns of it")
    return sorted(found, key=lambda v: (v is None, v))


def value_labels(values: Sequence[str | None]) -> list[str]:
    """Names of the values in columns: NULL is "NA", with underscores added while that is a value as well."""
    name = NULL_NAME
    while name in values:
        name += "_"
    return [name if v is None else v for v in values]


def share_of_total(profile: DataFrame, variable: str) -> DataFrame:
    """Share of the account's spending per value, one row each (at most one row per value in a window)."""
    total = F.sum("amount").over(W.partitionBy("account_id")).cast("double")
    return of_variable(profile, variable).select(
        "account_id", F.col("value").alias(variable), ratio("amount", total).alias("share"))


def spend_shares(profile: DataFrame, values: dict[str, Sequence[str | None]],
                 name: Callable[[str, str], str] = lambda variable, v: f"{variable}_pct_sum_{v}") -> DataFrame:
    """Share of the account's spending per variable and value, one column each, 0 without spending.

    Two aggregations by account over the profile: amounts pivoted over the given values, and the
    totals, which also count values without a column. NULL (None) is a value of its own beside any text.
    """
    rows = profile.filter(F.col("variable").isin(list(values)))
    pairs = [(variable, v) for variable, names in values.items() for v in names]
    labels = [(variable, label) for variable, names in values.items() for label in value_labels(names)]
    # concat_ws skips NULL: its key is the bare name of the variable.
    keyed = rows.select("account_id", "amount", F.concat_ws("=", "variable", "value").alias("_key"))
    keys = [variable if v is None else f"{variable}={v}" for variable, v in pairs]
    spent = keyed.groupBy("account_id").pivot("_key", keys).agg(
        F.sum("amount")).toDF("account_id", *[f"_spent_{i}" for i in range(len(pairs))])
    totals = rows.groupBy("account_id").agg(*[
        F.expr(f"CAST(sum(CASE WHEN variable = '{v}' THEN amount END) AS DOUBLE) AS _total_{v}") for v in values])
    return spent.join(totals, "account_id").select("account_id", *[
        F.expr(f"try_divide(CAST(coalesce(_spent_{i}, 0) AS DOUBLE), _total_{variable})").alias(name(variable, v))
        for i, (variable, v) in enumerate(labels)
    ])


def spend_share(profile: DataFrame, variable: str, values: Sequence[str | None], prefix: str | None = None) -> DataFrame:
    prefix = f"{variable}_pct_sum_" if prefix is None else prefix
    return spend_shares(profile, {variable: values}, lambda _, v: f"{prefix}{v}")


def category_share(profile: DataFrame, values: Sequence[str | None]) -> DataFrame:
    return spend_share(profile, "txn_category", values, prefix="txn_category_pct_amount_")


def frequency_ntile(transactions: DataFrame, column: str, buckets: int = 10) -> DataFrame:
    """Bucket of each value by its number of rows, from rare (1) to frequent."""
    sizes = transactions.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return distributed_ntile(sizes, ["n", column], buckets, f"{column}_decile").drop("n")


def bucket_lookup(transactions: DataFrame, columns: Sequence[str] = DECILE_COLUMNS) -> DataFrame:
    """Attach the frequency bucket of each column's value.

    No broadcast is asked for: the adaptive planner uses one when the measured table is small.
    """
    out = transactions
    for c in columns:
        lookup = frequency_ntile(transactions, c).withColumnRenamed(c, f"_{c}")
        out = out.join(lookup, out[c].eqNullSafe(lookup[f"_{c}"]), "left").drop(f"_{c}")
    return out


def gap_days(transactions: DataFrame) -> DataFrame:
    """Days between consecutive transaction days. One row per account and day goes into the window."""
    days = transactions.select("account_id", F.to_date("at").alias("txn_date")).distinct()
    previous = F.lag("txn_date").over(W.partitionBy("account_id").orderBy("txn_date"))
    return (days.withColumn("gap_days", days_between(F.col("txn_date"), previous))
            .filter(F.col("gap_days").isNotNull()))


def days_between_summary(transactions: DataFrame) -> DataFrame:
    """Statistics of the gaps; their number is bounded by the calendar, so quartiles are direct."""
    gap = "gap_days"
    return gap_days(transactions).groupBy("account_id").agg(
        *basic(gap, {"avg": "mean_days_between", "max": "max_days_between", "min": "min_days_between",
                     "sum": "sum_days_between", "stddev_samp": "sd_days_between"}),
        sample_kurtosis(gap).alias("kurtosis_days_between"),
        sample_skewness(gap).alias("skewness_days_between"),
        *exact_quantiles(gap, {f"{name}_days_between": p for name, p in QUARTILES.items()}),
    )


def _amount_aggregates() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("count_transactions"),
        *basic("amount", {"max": "max_amount", "stddev_samp": "sd_amount", "avg": "mean_amount", "sum": "sum_amount"}),
        F.to_date(F.max("at")).alias("last_transaction_date"),
    ]


def transactions_annual(transactions: DataFrame, hot: HotKeys = NONE, profile: DataFrame | None = None) -> DataFrame:
    """Distinct counts, amounts and last date per account."""
    if profile is None:
        profile = category_profile(transactions, DISTINCT_COLUMNS, hot=hot)
    return with_quartiles(transactions, _amount_aggregates(), ["amount"], hot).join(distinct_counts(profile), "account_id")


def transactions_quarter(placed: DataFrame, hot: HotKeys = NONE, profile: DataFrame | None = None) -> DataFrame:
    """The same per quarter, one column per measure and quarter."""
    keys = ["account_id", "q"]
    if profile is None:
        profile = category_profile(placed, DISTINCT_COLUMNS, keys, hot)
    long = placed.groupBy(*keys).agg(*_amount_aggregates()).join(distinct_counts(profile, by=keys), keys)
    measures = [c for c in long.columns if c not in keys]
    wide = widen(long, "account_id", "q", TXN_QUARTERS, measures, lambda m, q: f"{m}_Q{q}")
    return wide.join(with_quartiles(placed, [], ["amount"], hot, "q", TXN_QUARTERS), "account_id", "left")
