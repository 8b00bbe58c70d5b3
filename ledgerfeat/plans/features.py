"""The feature table: one wide row per account."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import cached_property, reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerfeat.functions.columns import dates_to_numeric, drop_higher_moments, fill_null
from ledgerfeat.functions.scalar import days_between, flag, ratio, ratio_or_one
from ledgerfeat.operators import encode, payments, statements, summaries, transactions, trends
from ledgerfeat.operators.skew import HotKeys
from ledgerfeat.session import StageTables
from ledgerfeat.sources.readers import Ledger

# Columns that mean 0 when an account has no payments, never paid in full, or has
# fewer than 14 statements.
PAYMENT_COLUMNS = (
    "count_payments", "min_payment", "max_payment", "mean_payment", "sum_payment", "n_not_reversed",
    "count_monthly_payments", "mean_monthly_payment", "max_monthly_payment", "min_monthly_payment",
    "last_monthly_payment", "credit_limit_paid_per_year", "ratio_spent_on_payment", "ratio_payment_on_owed",
    "days_since_last_payment", "credit_ratio_x_days_since_payment",
    "credit_ratio_x_days_since_payment_x_delq", "cash_ratio_x_days_since_payment",
    "days_from_last_payment_to_last_transaction", "last_payment_date",
    "mean_next_delay", "max_next_delay", "last_next_delay", "trend_next_delay", "pct_no_next_payment",
)
FULL_PAYMENT_COLUMNS = (
    "mean_full_delay", "max_full_delay", "last_full_delay", "trend_full_delay", "pct_no_full_payment",
)
FOURTEENTH_COLUMNS = (
    "credit_ratio_t_minus_14", "balance_delta_t_minus_13", "total_balance_t_minus_14", "pct_paid_t_minus_14",
)
TARGET_FOLDS = 50
CATEGORICAL = (
    "favorite_city_code", "favorite_city_code_Q1", "favorite_city_code_Q2", "favorite_city_code_Q3",
    "favorite_city_code_Q4", "favorite_sic_group", "favorite_category",
)


class FeaturePlan:
    """The intermediate tables of the feature job, each built once per plan.

    ``stage`` materialises a table that several later steps read, such as ``session.account_stage``. By default everything
    stays lazy, which suits plans that use a part of the tables. ``row_stage`` takes its place for tables with many rows of
    hot accounts. ``staged`` makes a plan with both, which removes the shared tables once all families are staged; its
    ``drop_families`` removes these too, after the last reader of the features.
    """

    def __init__(self, ledger: Ledger, stage: Callable[[DataFrame], DataFrame] = lambda df: df,
                 share_values: dict[str, Sequence[str]] | None = None, ranks: Sequence[int] | None = None,
                 row_stage: Callable[[DataFrame], DataFrame] | None = None):
        self.ledger = ledger
        self.stage = stage
        self._row_stage = row_stage or stage
        self._staged = row_stage is not None
        self._family_stage = stage
        self._shared_tables: StageTables | None = None
        self._family_tables: StageTables | None = None
        self._share_values = share_values
        self._ranks = ranks

    @classmethod
    def staged(cls, ledger: Ledger, **options) -> FeaturePlan:
        """A plan whose shared tables and families are files bucketed by account."""
        spark, tasks = ledger.accounts.sparkSession, ledger.tasks()
        shared, families = StageTables(spark, tasks), StageTables(spark, tasks)
        plan = cls(ledger, shared.by_account, row_stage=shared.plain, **options)
        plan._shared_tables, plan._family_tables, plan._family_stage = shared, families, families.by_account
        return plan

    def _drop_shared(self) -> None:
        """Remove the shared tables; read again, they are made again."""
        if self._shared_tables:
            for name in [n for n, made in self.__dict__.items() if isinstance(made, DataFrame)]:
                del self.__dict__[name]
            self._shared_tables.drop()

    def drop_families(self) -> None:
        if self._family_tables:
            self._family_tables.drop()

    def stage_family(self, df: DataFrame) -> DataFrame:
        """A stage that stays until ``drop_families``."""
        return self._family_stage(df)

    @cached_property
    def tasks(self) -> int:
        return self.ledger.tasks()

    def stage_rows(self, df: DataFrame, hot: HotKeys) -> DataFrame:
        return (self._row_stage if hot else self.stage)(df)

    @cached_property
    def enriched(self) -> DataFrame:
        hot, rows = self.ledger.hot_statements, self.ledger.statements
        # A number of tasks of our own: by size alone the planner joins tasks that the wide summaries make too large.
        spread = rows if hot else rows.repartition(self.tasks, "account_id")
        return self.stage_rows(statements.enrich_statements(spread, hot), hot)

    @cached_property
    def payments(self) -> DataFrame:
        return self.stage_rows(self.ledger.payments, self.ledger.hot_transactions)

    @cached_property
    def transactions(self) -> DataFrame:
        """Transactions; staged, their joins are made once."""
        return self.stage_rows(self.ledger.transactions, self.ledger.hot_transactions)

    @cached_property
    def placed(self) -> DataFrame:
        return transactions.transactions_in_quarters(
            self.transactions, self.enriched, self.ledger.hot_transactions)

    @cached_property
    def profile(self) -> DataFrame:
        """Profile of every category-like column, deciles included."""
        columns = dict.fromkeys([*transactions.DISTINCT_COLUMNS, *transactions.SHARE_COLUMNS])
        hot = self.ledger.hot_transactions
        return self.stage_rows(transactions.category_profile(
            transactions.bucket_lookup(self.transactions, ("country", "city")), list(columns), hot=hot, parts=self.tasks), hot)

    @cached_property
    def quarter_profile(self) -> DataFrame:
        hot = self.ledger.hot_transactions
        return self.stage_rows(transactions.category_profile(
            self.placed, transactions.DISTINCT_COLUMNS, ("account_id", "q"), hot, self.tasks), hot)

    @cached_property
    def share_values(self) -> dict[str, Sequence[str]]:
        """Feature columns of the spending shares; read from the data unless given."""
        if self._share_values is not None:
            return self._share_values
        return {v: transactions.distinct_values(transactions.of_variable(self.profile, v), "value")
                for v in transactions.SHARE_COLUMNS}

    @cached_property
    def ranks(self) -> Sequence[int]:
        """Statement ranks with columns of their own: all that the data holds unless given."""
        return statements.ranks_present(self.ledger.statements) if self._ranks is None else self._ranks

    @cached_property
    def paid(self) -> DataFrame:
        return payments.pct_paid(self.enriched, self.payments, self.ledger.hot_statements)

    @cached_property
    def outcomes(self) -> DataFrame:
        hot = self.ledger.hot_statements
        return self.stage_rows(payments.bill_outcomes(self.enriched, self.payments, hot), hot)

    @cached_property
    def favorite_city(self) -> DataFrame:
        """Favourite city over all quarters, pooled when rare."""
        rows = self.quarter_profile.groupBy("account_id", "variable", "value").agg(F.sum("n").alias("n"))
        favorite = transactions.favorite_value(rows, "city", "favorite_city", numeric=True)
        return transactions.pool_rare(favorite, "favorite_city", "favorite_city_code")

    @cached_property
    def encoded_city(self) -> DataFrame:
        """Out-of-fold mean label of the favourite city's accounts."""
        labelled = self.ledger.accounts.select("account_id", "default_flag").join(
            self.favorite_city.select("account_id", "favorite_city_code"), "account_id", "left")
        folded = encode.stratified_folds(labelled, "default_flag", TARGET_FOLDS)
        return encode.oof_target_encode(
            folded, "favorite_city_code", "default_flag", "fold", "city_mean_default"
        ).select("account_id", "favorite_city_code", "city_mean_default")

    @cached_property
    def moves(self) -> DataFrame:
        favorites = transactions.favorite_value(
            self.quarter_profile, "city", "favorite_city", by=("account_id", "q"), numeric=True)
        return transactions.city_moves(favorites)

    def favorites(self) -> DataFrame:
        """Favourite merchant group and category, and how spread out the account's spending is."""
        p = self.profile
        return (
            transactions.favorite_value(p, "sic_group", "favorite_sic_group")
            .join(transactions.favorite_value(
                p, "category", "favorite_category", exclude=transactions.EXCLUDED_CATEGORIES), "account_id", "left")
            .join(transactions.diversity_index(p), "account_id", "left")
        )

    def transaction_totals(self) -> DataFrame:
        # Unstaged, the profile is made for this table alone: rows are not spread for counts that a query may not read.
        profile = self.profile if self._staged else transactions.category_profile(self.transactions, transactions.DISTINCT_COLUMNS)
        return transactions.transactions_annual(
            self.transactions, self.ledger.hot_transactions, profile).withColumn("has_transaction_data", F.lit(1))

    @cached_property
    def paid_summary(self) -> DataFrame:
        return payments.pct_paid_summary(self.paid, self.ranks)

    @cached_property
    def wide_statements(self) -> DataFrame:
        return statements.wide_statement_features(self.enriched, self.ranks)

    def bill_features(self) -> DataFrame:
        return payments.bills_outcome_summary(self.outcomes).join(
            trends.trend_delays(self.outcomes), "account_id", "left")

    def paid_features(self) -> DataFrame:
        return self.paid_summary.join(trends.trend_pct_paid(self.paid), "account_id", "left")

    def families(self) -> dict[str, Callable[[], DataFrame]]:
        """Makers of tables with one row per account; each is a job of its own when staged."""
        ledger = self.ledger
        stm_hot, txn_hot = ledger.hot_statements, ledger.hot_transactions
        return {
            "payments": lambda: payments.payments_summary(self.payments),
            "transactions": self.transaction_totals,
            "transactions_by_quarter": lambda: transactions.transactions_quarter(
                self.placed, txn_hot, self.quarter_profile),
            "shares": lambda: transactions.spend_shares(self.profile, self.share_values),
            "favorites": self.favorites,
            "moves": lambda: self.moves,
            "gaps": lambda: transactions.days_between_summary(self.transactions),
            "city": lambda: self.encoded_city,
            "statements": lambda: summaries.summary_annual(self.enriched, stm_hot),
            "statement_series": lambda: self.wide_statements,
            "semesters": lambda: summaries.summary_semester(self.enriched, stm_hot),
            "quarters": lambda: summaries.summary_quarter(self.enriched, stm_hot).withColumn(
                "credit_ratio_Q4_on_Q1", summaries.quarter_ratio()),
            "bills": self.bill_features,
            "ratio_trends": lambda: trends.trend_ratios(self.enriched),
            "paid": self.paid_features,
            "full_payers": lambda: payments.full_payers(self.outcomes),
        }

    def staged_families(self, parallelism: int = 4) -> list[DataFrame]:
        """All families, a few jobs at a time, the tables they share first."""
        with ThreadPool(parallelism) as pool:
            pool.map(lambda make: make(), [lambda: self.enriched, lambda: self.payments, lambda: self.transactions, lambda: self.ranks],
                     chunksize=1)
            self.placed, self.paid
            shared = [lambda: self.profile, lambda: self.quarter_profile, lambda: self.outcomes]
            pool.map(lambda make: make(), shared, chunksize=1)
            staged = pool.map(lambda make: self.stage_family(make()), self.families().values(), chunksize=1)
        self._drop_shared()
        return staged


def account_ratios() -> dict:
    """Paid and spent over the limit, spent over paid, last month's payment over the balance owed."""
    return {
        "credit_limit_paid_per_year": ratio("sum_payment", "last_credit_limit"),
        "credit_limit_spent_per_year": ratio("sum_amount", "last_credit_limit"),
        "ratio_spent_on_payment": ratio("sum_amount", "sum_payment"),
        "ratio_payment_on_owed": ratio_or_one("last_monthly_payment", "last_total_balance"),
    }


def recency_features() -> dict:
    """Days since the last payment and transaction, and their products with the last ratios."""
    since = days_between("as_of", "last_payment_date")
    return {
        "days_since_last_payment": since,
        "credit_ratio_x_days_since_payment": since * F.col("last_credit_ratio"),
        "credit_ratio_x_days_since_payment_x_delq": since * F.col("last_credit_ratio") * F.col("last_delq_cycle"),
        "cash_ratio_x_days_since_payment": since * F.col("last_cash_ratio"),
        "days_since_last_transaction": days_between("as_of", "last_transaction_date"),
        "days_from_last_payment_to_last_transaction": days_between("last_transaction_date", "last_payment_date"),
    }


def history_flags() -> dict:
    """What an account has: payments, transactions, a full payment, 14 statements, no bill."""
    def zero(c: str):
        return F.coalesce(c, F.lit(0))
    return {
        "has_payment_data": zero("has_payment_data"),
        "has_transaction_data": zero("has_transaction_data"),
        "has_full_payment": zero("has_full_payment"),
        "has_14_statements": flag(F.col("count_statements") == statements.STATEMENTS_PER_YEAR),
        "has_no_bill": flag(zero("count_bills") == 0),
        "count_bills": zero("count_bills"),
        "year": F.year("as_of"),
    }


def join_families(accounts: DataFrame, families: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.join(right, "account_id", "left"), families, accounts)


def assemble_features(plan: FeaturePlan) -> DataFrame:
    """Accounts with every family.

    Families are staged one by one: joined lazily they would form one stage with dozens of sorts and
    aggregations that compete for a task's memory.
    """
    return (
        join_families(plan.ledger.accounts, plan.staged_families())
        .withColumns({**account_ratios(), **recency_features()})
        .withColumns(history_flags())
        # No balance precedes the oldest statement; the last ratio stays in its products only.
        .drop("as_of", "last_credit_ratio", "balance_delta_t_minus_14")
    )


def finish_features(assembled: DataFrame) -> DataFrame:
    """Dates as numbers, meaningful zeros, no higher moments."""
    out = dates_to_numeric(assembled)
    out = fill_null(out, [*PAYMENT_COLUMNS, *FULL_PAYMENT_COLUMNS, *FOURTEENTH_COLUMNS])
    return drop_higher_moments(out)


def feature_table(ledger: Ledger, stage: Callable[[DataFrame], DataFrame] | None = None, **options) -> DataFrame:
    """From the ledger to the finished feature table."""
    plan = FeaturePlan(ledger, stage, **options) if stage else FeaturePlan.staged(ledger, **options)
    return finish_features(assemble_features(plan))
