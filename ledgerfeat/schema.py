"""Fixed input schemas of the four ledger tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

STATEMENTS = T.StructType([
    T.StructField("account_id", T.LongType(), False),
    T.StructField("statement_id", T.LongType(), False),
    T.StructField("statement_date", T.DateType(), False),
    T.StructField("period", T.DateType(), False),
    T.StructField("total_balance", MONEY),
    T.StructField("cash_balance", MONEY),
    T.StructField("credit_limit", MONEY),
    T.StructField("delq_cycle", T.IntegerType()),
])

PAYMENTS = T.StructType([
    T.StructField("account_id", T.LongType(), False),
    T.StructField("paid_at", T.TimestampNTZType()),
    T.StructField("amount", MONEY),
    T.StructField("reversal_flag", T.StringType()),
])

TRANSACTIONS = T.StructType([
    T.StructField("account_id", T.LongType(), False),
    T.StructField("at", T.TimestampNTZType()),
    T.StructField("amount", MONEY),
    T.StructField("city", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("decision", T.StringType()),
    T.StructField("sic_group", T.StringType()),
    T.StructField("txn_category", T.StringType()),
    T.StructField("txn_type", T.StringType()),
])

ACCOUNTS = T.StructType([
    T.StructField("account_id", T.LongType(), False),
    T.StructField("as_of", T.DateType()),
    T.StructField("default_flag", T.IntegerType()),
])

# Column headers of the card CSV files and the names used here.
CSV_HEADERS = {
    "statements": {
        "ID_CPTE": "account_id",
        "StatementDate": "statement_date",
        "PERIODID_MY": "period",
        "CurrentTotalBalance": "total_balance",
        "CashBalance": "cash_balance",
        "CreditLimit": "credit_limit",
        "DelqCycle": "delq_cycle",
    },
    "payments": {
        "ID_CPTE": "account_id",
        "TRANSACTION_DTTM": "paid_at",
        "TRANSACTION_AMT": "amount",
        "PAYMENT_REVERSAL_XFLG": "reversal_flag",
    },
    "transactions": {
        "ID_CPTE": "account_id",
        "TRANSACTION_DTTM": "at",
        "TRANSACTION_AMT": "amount",
        "MERCHANT_CITY_NAME": "city",
        "MERCHANT_CATEGORY_XCD": "category",
        "MERCHANT_COUNTRY_XCD": "country",
        "DECISION_XCD": "decision",
        "SICGROUP": "sic_group",
        "TRANSACTION_CATEGORY_XCD": "txn_category",
        "TRANSACTION_TYPE_XCD": "txn_type",
    },
    "accounts": {
        "ID_CPTE": "account_id",
        "PERIODID_MY": "as_of",
        "Default": "default_flag",
    },
}

# CSV file stems that make up each table (training part, scoring part).
CSV_FILES = {
    "statements": ["facturation_train", "facturation_test"],
    "payments": ["paiements_train", "paiements_test"],
    "transactions": [
        "transactions_train",
        "transactions_test",
        "additional_transactions_train",
        "additional_transactions_test",
    ],
    "accounts": ["performance_train", "performance_test"],
}

SCHEMAS = {
    "statements": STATEMENTS,
    "payments": PAYMENTS,
    "transactions": TRANSACTIONS,
    "accounts": ACCOUNTS,
}
