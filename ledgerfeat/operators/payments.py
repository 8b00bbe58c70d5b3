"""Payments against statements: interval sums, next and full payment, bill outcomes, summaries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerfeat.functions.scalar import days_between, month_start, ratio
from ledgerfeat.functions.stats import basic, count_where, sample_kurtosis, sample_skewness
from ledgerfeat.operators.skew import NONE, HotKeys, cold_rows, is_hot, join_per_key
from ledgerfeat.operators.statements import NAMED_RANKS, wide_series

# Fixed value: days added to the time until the last statement when a bill is still unpaid.
UNPAID_EXTRA_DAYS = 60
#: A date has fewer than 2 ** 22 values in the years 1 to 9999, and so many entries a calendar at most.
CALENDAR_BITS = 22


def daily_payments(payments: DataFrame) -> DataFrame:
    """Amount paid per account and day. Later steps see at most one row per calendar day."""
    return payments.groupBy("account_id", F.to_date("paid_at").alias("day")).agg(F.sum("amount").alias("amount"))


def running_paid(payments: DataFrame) -> DataFrame:
    """Daily payments with the amount paid up to and including each day."""
    w = W.partitionBy("account_id").orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return daily_payments(payments).withColumn("paid_so_far", F.sum("amount").over(w))


def payment_calendar(payments: DataFrame) -> DataFrame:
    """One row per account: its payment days in order, with daily and running amounts and the highest running amount so far.

    The array has at most one entry per calendar day, whatever the number of payments.
    """
    w = W.partitionBy("account_id").orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    entry = F.struct("day", "amount", "paid_so_far", "peak")
    return running_paid(payments).withColumn("peak", F.max("paid_so_far").over(w)).groupBy("account_id").agg(
        F.sort_array(F.collect_list(entry)).alias("_calendar"))


def _entries_while(holds: Callable[[Column], Column]) -> Column:
    """Number of first calendar entries for which ``holds``, by binary search; ``holds`` must not come back once it ended."""
    size = F.size("_calendar")
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(CALENDAR_BITS))])
    return F.aggregate(powers, F.lit(0), lambda n, p: F.when(
        (n + p <= size) & holds(F.get(F.col("_calendar"), n + p - 1)), n + p).otherwise(n))


def _with_payments_from(statements: DataFrame, payments: DataFrame, hot: HotKeys) -> DataFrame:
    """Statements with the account's ``_calendar`` and the place in it (``_first``) of the first day on or after the statement."""
    joined = join_per_key(statements, payment_calendar(payments), "account_id", hot)
    before = _entries_while(lambda p: p["day"] < F.col("statement_date"))
    return joined.withColumn("_first", F.when(F.col("statement_date").isNotNull(), before))


def _entry(place: Column) -> Column:
    return F.get(F.col("_calendar"), place)


def _paid_before_first() -> Column:
    first = _entry(F.col("_first"))
    return first["paid_so_far"] - first["amount"]


def _paid_until_next() -> Column:
    before_next = _entries_while(lambda p: p["day"] < F.col("next_statement_date"))
    return F.coalesce(
        F.when(before_next > F.col("_first"), _entry(before_next - 1)["paid_so_far"] - _paid_before_first()), F.lit(0))


def _next_payment_date() -> Column:
    return _entry(F.col("_first"))["day"]


def _full_payment_date() -> Column:
    """First day from ``_first`` on at which the bill is paid.

    The highest running amounts rise, so they can be searched. Only where they had reached the goal before the
    statement, and reversals took it back, the days that follow are looked through one by one.
    """
    start, owed = _paid_before_first(), F.col("total_balance")

    def reached(amount: Column) -> Column:
        return F.coalesce(amount - start >= owed, F.lit(False))

    later = F.slice("_calendar", F.col("_first") + 1, F.size("_calendar"))
    looked_through = F.get(F.filter(later, lambda p: reached(p["paid_so_far"])), F.lit(0))["day"]
    searched = _entry(_entries_while(lambda p: ~reached(p["peak"])))["day"]
    return F.when(start.isNotNull() & owed.isNotNull(),
                  F.when(reached(_entry(F.col("_first") - 1)["peak"]), looked_through).otherwise(searched))


def pct_paid(enriched: DataFrame, payments: DataFrame, hot: HotKeys = NONE) -> DataFrame:
    """Share of each statement paid before the next one; 1 when nothing was owed or more was paid."""
    paid = _with_payments_from(
        enriched.select("account_id", "statement_id", "statement_date", "next_statement_date",
                        "total_balance", "is_last_statement", "rank_from_last"),
        payments, hot,
    ).withColumn("paid_until_next", _paid_until_next())
    return paid.select(
        "account_id", "statement_id", "statement_date", "is_last_statement", "rank_from_last",
        F.col("paid_until_next").cast("double").alias("paid_until_next"),
        F.when((F.col("total_balance") == 0) | (F.col("paid_until_next") > F.col("total_balance")), F.lit(1.0))
        .otherwise(ratio("paid_until_next", "total_balance")).alias("pct_paid"),
    )


def pct_paid_summary(paid: DataFrame, ranks: Sequence[int] = NAMED_RANKS) -> DataFrame:
    """Mean, max, min and moments of the share paid, and the share of each named statement rank."""
    summary = paid.filter(F.col("is_last_statement") == 0).groupBy("account_id").agg(
        F.avg("pct_paid").alias("mean_pct_paid"),
        F.max("pct_paid").alias("max_pct_paid"),
        F.min("pct_paid").alias("min_pct_paid"),
        sample_kurtosis("pct_paid").alias("kurtosis_pct_paid"),
        sample_skewness("pct_paid").alias("skewness_pct_paid"),
    )
    return summary.join(wide_series(paid, ["pct_paid"], ranks), "account_id", "left")


def payments_after(statements: DataFrame, payments: DataFrame, hot: HotKeys = NONE) -> DataFrame:
    """Payment days and amount on or after each statement, without pairing the two."""
    return _with_payments_from(
        statements.select("account_id", "statement_id", "statement_date"), payments, hot
    ).select(
        "account_id", "statement_id",
        F.coalesce(F.size("_calendar") - F.col("_first"), F.lit(0)).cast("long").alias("payment_days"),
        F.coalesce(
            _entry(F.size("_calendar") - 1)["paid_so_far"] - _paid_before_first(), F.lit(0)).cast("double").alias("amount_after"),
    )


def positive_bills(enriched: DataFrame) -> DataFrame:
    return enriched.filter(F.col("total_balance") > 0)


def _with_account_maxima(df: DataFrame, names: dict[str, str], hot: HotKeys) -> DataFrame:
    """The account's maximum of each column on all its rows.

    The rows come partitioned by account, so a window costs no further shuffle; hot accounts are
    aggregated instead, and their few maxima broadcast.
    """
    account = W.partitionBy("account_id")
    cold = cold_rows(df, "account_id", hot).withColumns(
        {new: F.max(old).over(account) for old, new in names.items()})
    if not hot:
        return cold
    few = df.filter(is_hot("account_id", hot))
    maxima = few.groupBy("account_id").agg(*[F.max(old).alias(new) for old, new in names.items()])
    return cold.unionByName(join_per_key(few, maxima, "account_id", hot))


def bill_outcomes(enriched: DataFrame, payments: DataFrame, hot: HotKeys = NONE) -> DataFrame:
    """Each bill with the dates and delays of its next and full payment.

    A missing delay is capped by the larger of the account's own worst delay and the days until 60
    days after the last statement.
    """
    bills = _with_payments_from(
        positive_bills(enriched).select(
            "account_id", "statement_id", "statement_date", "period", "last_statement_date",
            "is_last_statement", "total_balance"),
        payments, hot)
    dated = bills.select(
        *[c for c in bills.columns if c not in ("_calendar", "_first")],
        _next_payment_date().alias("next_payment_date"),
        _full_payment_date().alias("full_payment_date"),
    ).withColumns({
        "next_delay": days_between("next_payment_date", "statement_date"),
        "full_delay": days_between("full_payment_date", "statement_date"),
        "_open_days": days_between("last_statement_date", "statement_date") + UNPAID_EXTRA_DAYS,
    })
    return _with_account_maxima(dated, {"next_delay": "_max_next", "full_delay": "_max_full"}, hot).withColumns({
        "next_delay_capped": F.coalesce("next_delay", F.greatest("_max_next", "_open_days")),
        "full_delay_capped": F.coalesce("full_delay", F.greatest("_max_full", "_open_days")),
    }).drop("_max_next", "_max_full", "_open_days")


def bills_outcome_summary(outcomes: DataFrame) -> DataFrame:
    """Per account over all bills but the last statement's: counts, shares and delays."""
    when = F.struct("period", "statement_date", "statement_id")
    aggregates = [F.count(F.lit(1)).alias("count_bills")]
    for kind in ("next", "full"):
        delay = f"{kind}_delay"
        aggregates += [
            (count_where(F.col(delay).isNull()) / F.count(F.lit(1))).alias(f"pct_no_{kind}_payment"),
            F.avg(delay).alias(f"mean_{delay}"),
            F.max(delay).alias(f"max_{delay}"),
            sample_kurtosis(delay).alias(f"kurtosis_{delay}"),
            sample_skewness(delay).alias(f"skewness_{delay}"),
            F.max_by(delay, when).alias(f"last_{delay}"),
        ]
    return outcomes.filter(F.col("is_last_statement") == 0).groupBy("account_id").agg(*aggregates)


def full_payers(outcomes: DataFrame) -> DataFrame:
    """Accounts that ever paid a bill in full."""
    return (outcomes.filter(F.col("full_payment_date").isNotNull()).select("account_id").distinct()
            .withColumn("has_full_payment", F.lit(1)))


def payments_monthly(payments: DataFrame, per_payment: bool = True) -> DataFrame:
    """Statistics of monthly totals.

    By default each payment carries its month's total, so the count is of payments and the mean is
    weighted by them; ``per_payment=False`` gives every month the weight 1.
    """
    months = payments.groupBy("account_id", month_start("paid_at").alias("month")).agg(
        F.count(F.lit(1)).alias("_payments"), F.sum("amount").cast("double").alias("_total"))
    weight = F.col("_payments") if per_payment else F.lit(1)
    return months.groupBy("account_id").agg(
        F.sum(weight).cast("long").alias("count_monthly_payments"),
        (F.sum(weight * F.col("_total")) / F.sum(weight)).alias("mean_monthly_payment"),
        F.max("_total").alias("max_monthly_payment"),
        F.min("_total").alias("min_monthly_payment"),
        F.max_by("_total", "month").alias("last_monthly_payment"),
    )


def month_totals(payments: DataFrame) -> DataFrame:
    """Month total of each account, one row per month with payments."""
    return payments.groupBy("account_id", month_start("paid_at").alias("month")).agg(
        F.count(F.lit(1)).alias("count_payments"), F.sum("amount").cast("double").alias("month_total"))


def payments_summary(payments: DataFrame) -> DataFrame:
    """Count, last date, amounts, moments, payments flagged as not reversed, and monthly statistics."""
    summary = payments.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("count_payments"),
        F.to_date(F.max("paid_at")).alias("last_payment_date"),
        *basic("amount", {"min": "min_payment", "avg": "mean_payment", "max": "max_payment", "sum": "sum_payment"}),
        sample_kurtosis("amount").alias("kurtosis_payment"),
        sample_skewness("amount").alias("skewness_payment"),
        count_where(F.col("reversal_flag") == "N").alias("n_not_reversed"),
    )
    return summary.withColumn("has_payment_data", F.lit(1)).join(payments_monthly(payments), "account_id", "left")
