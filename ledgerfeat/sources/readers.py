"""Reading the ledger tables from CSV or Parquet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfeat import schema
from ledgerfeat.operators.skew import NONE, HotKeys, hot_keys


# Fixed value: how missing values are written in the card files.
NULL_CELL = "NA"
# A task of work by account holds its wide rows several times, at about 10 KB each.
ACCOUNTS_PER_TASK = 5_000
STATEMENTS_PER_TASK = 50_000


@dataclass(frozen=True)
class Ledger:
    """The four input tables, with the accounts too large for one task (usually none)."""

    accounts: DataFrame
    statements: DataFrame
    payments: DataFrame
    transactions: DataFrame
    hot_statements: HotKeys = NONE
    hot_transactions: HotKeys = NONE
    #: ``account_id`` and ``rows``, adding up to its transactions, where that costs less than the transactions themselves.
    transaction_counts: DataFrame | None = None

    def with_hot_accounts(self, floor: int | None = None) -> Ledger:
        """Find the accounts whose statements or transactions must be split over several tasks."""
        options = {} if floor is None else {"floor": floor}
        return replace(
            self,
            hot_statements=hot_keys(self.statements, "account_id", **options),
            hot_transactions=hot_keys(self.transactions, "account_id", **options) if self.transaction_counts is None
            else hot_keys(self.transaction_counts, "account_id", counts="rows", **options),
        )

    def tasks(self) -> int:
        """Tasks for work by account: a bounded number of accounts and statements in each, whatever their number."""
        return max(self.accounts.sparkSession.sparkContext.defaultParallelism,
                   -(-self.accounts.count() // ACCOUNTS_PER_TASK), -(-self.statements.count() // STATEMENTS_PER_TASK))


def read_csv_table(spark: SparkSession, path: str | Sequence[str], fields: T.StructType) -> DataFrame:
    """CSV with a header and a declared schema (no inference pass over the data).

    ``NA`` and empty cells are NULL. A cell that does not fit its type is an error when it is read.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.schema(fields).option("header", True).option("nullValue", NULL_CELL)
            .option("mode", "FAILFAST").csv(paths))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A saved Parquet table; ``columns`` limits the scan."""
    table = spark.read.parquet(path)
    return table.select(*columns) if columns else table


def stack_tables(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, matched by column name, absent columns NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def drop_null_payments(payments: DataFrame) -> DataFrame:
    return payments.filter(F.col("amount").isNotNull())


def _card_table(spark: SparkSession, folder: str, table: str) -> DataFrame:
    target = schema.SCHEMAS[table]
    renames = {new: old for old, new in schema.CSV_HEADERS[table].items()}
    parts = []
    for stem in schema.CSV_FILES[table]:
        path = f"{folder.rstrip('/')}/{stem}.csv"
        # The header decides column order and presence; the types stay declared.
        header = spark.read.option("header", True).csv(path).columns
        declared = {renames[f.name]: f.dataType for f in target if f.name in renames}
        fields = T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in header])
        raw = read_csv_table(spark, path, fields)
        parts.append(raw.select(*[
            F.col(renames[f.name]).alias(f.name)
            for f in target
            if f.name in renames and renames[f.name] in header
        ]))
    return stack_tables(*parts)


def load_card_csv(spark: SparkSession, folder: str) -> Ledger:
    """The ledger from a folder of card CSV files, training and scoring parts stacked."""
    statements = _card_table(spark, folder, "statements").withColumn(
        # Statements have no key of their own: account and date identify them.
        "statement_id", F.xxhash64("account_id", "statement_date", "period", "total_balance", "cash_balance")
    )
    return Ledger(
        accounts=_card_table(spark, folder, "accounts"),
        statements=statements.select(*schema.STATEMENTS.names),
        payments=drop_null_payments(_card_table(spark, folder, "payments")),
        transactions=_card_table(spark, folder, "transactions"),
    )


def load_parquet(spark: SparkSession, folder: str) -> Ledger:
    """The ledger from ``<folder>/{accounts,statements,payments,transactions}``."""
    tables = {name: read_table(spark, f"{folder.rstrip('/')}/{name}", fields.names)
              for name, fields in schema.SCHEMAS.items()}
    tables["payments"] = drop_null_payments(tables["payments"])
    return Ledger(**tables)
