"""The ledger as views over order tables: each customer is an account, each order a statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfeat.schema import MONEY
from ledgerfeat.sources.readers import Ledger, drop_null_payments, read_table

# Orders whose transactions one task counts.
ORDERS_PER_TASK = 200_000


def accounts_view(spark: SparkSession, folder: str) -> DataFrame:
    customer = read_table(spark, f"{folder}/customer.parquet", ["c_custkey", "c_acctbal"])
    return customer.select(
        F.col("c_custkey").alias("account_id"),
        F.lit("2001-12-31").cast("date").alias("as_of"),
        # Every fifth customer plays the scoring set, whose label is unknown.
        F.when(F.col("c_custkey") % 5 != 0, (F.col("c_acctbal") < 0).cast("int")).alias("default_flag"),
    )


def statements_view(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_table(
        spark, f"{folder}/orders.parquet",
        ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus"],
    )
    level = F.substring("o_orderpriority", 1, 1).cast("int")
    return orders.select(
        F.col("o_custkey").alias("account_id"),
        F.col("o_orderkey").alias("statement_id"),
        F.to_date("o_orderdate").alias("statement_date"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("period"),
        F.col("o_totalprice").cast(MONEY).alias("total_balance"),
        (1000 * (level - 1)).cast(MONEY).alias("cash_balance"),
        (300000 + 50000 * level).cast(MONEY).alias("credit_limit"),
        F.when(F.col("o_orderstatus") == "F", 0)
        .when(F.col("o_orderstatus") == "O", 1)
        .when(F.col("o_orderstatus") == "P", 2).alias("delq_cycle"),
    )


def _lines(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    owners = read_table(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_custkey"])
    lines = read_table(spark, f"{folder}/lineitem.parquet",
                       ["l_orderkey", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus", *columns])
    return lines.join(owners, lines["l_orderkey"] == owners["o_orderkey"])


def payments_view(spark: SparkSession, folder: str) -> DataFrame:
    payments = _lines(spark, folder, []).filter(F.col("l_returnflag") == "A").select(
        F.col("o_custkey").alias("account_id"),
        F.col("l_shipdate").alias("paid_at"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.when(F.col("l_linestatus") == "O", "N").otherwise("Y").alias("reversal_flag"),
    )
    return drop_null_payments(payments)


def transactions_view(spark: SparkSession, folder: str) -> DataFrame:
    parts = read_table(spark, f"{folder}/part.parquet", ["p_partkey", "p_type", "p_brand", "p_size"])
    suppliers = read_table(spark, f"{folder}/supplier.parquet", ["s_suppkey", "s_nationkey"])
    lines = _lines(spark, folder, ["l_partkey", "l_suppkey"]).filter(F.col("l_returnflag") != "A")
    return (
        # The texts of the parts come last, so that fewer shuffles carry them.
        lines.join(suppliers, lines["l_suppkey"] == suppliers["s_suppkey"], "left")
        .join(parts, lines["l_partkey"] == parts["p_partkey"], "left")
        .select(
            F.col("o_custkey").alias("account_id"),
            F.col("l_shipdate").alias("at"),
            F.col("l_extendedprice").cast(MONEY).alias("amount"),
            F.col("l_suppkey").cast("string").alias("city"),
            F.col("p_type").alias("category"),
            F.col("s_nationkey").cast("string").alias("country"),
            F.col("l_returnflag").alias("decision"),
            F.col("p_brand").alias("sic_group"),
            (F.col("p_size") % 4).cast("string").alias("txn_category"),
            F.col("l_linestatus").alias("txn_type"),
        )
    )


def transaction_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions per order with the order's account; the texts of a transaction are not looked up."""
    owners = read_table(spark, f"{folder}/orders.parquet", ["o_orderkey", "o_custkey"])
    lines = read_table(spark, f"{folder}/lineitem.parquet", ["l_orderkey", "l_returnflag"]).filter(F.col("l_returnflag") != "A")
    # A number of tasks of our own: by size alone the planner joins small rows of millions of orders in one task.
    parts = max(spark.sparkContext.defaultParallelism, -(-owners.count() // ORDERS_PER_TASK))
    per_order = lines.select("l_orderkey").repartition(parts, "l_orderkey").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("rows"))
    owners = owners.repartition(parts, "o_orderkey")
    return per_order.join(owners, per_order["l_orderkey"] == owners["o_orderkey"]).select(
        F.col("o_custkey").alias("account_id"), "rows")


def event_spend_view(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a second, denser transaction table: the event type is the category."""
    events = read_table(spark, f"{folder}/events.parquet", ["user_id", "ts", "event_type", "value"])
    return events.select(
        F.col("user_id").alias("account_id"),
        F.col("ts").alias("at"),
        F.col("value").cast(MONEY).alias("amount"),
        F.col("event_type").alias("category"),
    )


def load_orders(spark: SparkSession, folder: str) -> Ledger:
    folder = folder.rstrip("/")
    return Ledger(
        accounts=accounts_view(spark, folder),
        statements=statements_view(spark, folder),
        payments=payments_view(spark, folder),
        transactions=transactions_view(spark, folder),
        transaction_counts=transaction_counts(spark, folder),
    )
