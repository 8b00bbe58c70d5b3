"""Least-squares trends per account; groups without a slope give NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.functions.stats import slope


# Days to the account's last statement: a slope does not change with the origin.
DAYS = "datediff(statement_date, last_statement_date)"


def trend_ratios(enriched: DataFrame) -> DataFrame:
    """Slopes of the reported ratios over statement dates."""
    return enriched.groupBy("account_id").agg(
        slope("raw_credit_ratio", DAYS).alias("trend_credit_ratio"),
        slope("raw_cash_ratio", DAYS).alias("trend_cash_ratio"),
        slope("raw_cash_on_credit_ratio", DAYS).alias("trend_cash_on_credit_ratio"),
    )


def trend_pct_paid(paid: DataFrame) -> DataFrame:
    """Slope of the share paid over the statement's position in the account."""
    return paid.filter(F.col("is_last_statement") == 0).groupBy("account_id").agg(
        slope("pct_paid", "-rank_from_last").alias("trend_pct_paid"))


def trend_delays(outcomes: DataFrame) -> DataFrame:
    """Slopes of the capped payment delays over bill dates."""
    return outcomes.filter(F.col("is_last_statement") == 0).groupBy("account_id").agg(
        slope("full_delay_capped", DAYS).alias("trend_full_delay"),
        slope("next_delay_capped", DAYS).alias("trend_next_delay"),
    )
