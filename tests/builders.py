"""Small ledgers for tests."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from ledgerfeat import schema
from ledgerfeat.sources.readers import Ledger


def money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.01"))


def statements(spark, rows):
    """(account, id, date, total, cash, limit, delq) tuples."""
    return spark.createDataFrame([
        (a, i, d, d.replace(day=1), money(t), money(c), money(l), q) for a, i, d, t, c, l, q in rows
    ], schema.STATEMENTS)


def months(account, count, first_id=1, total=100, cash=0, limit=1000, start=date(2017, 1, 15)):
    out = []
    for k in range(count):
        year, month = divmod(start.month - 1 + k, 12)
        out.append((account, first_id + k, date(start.year + year, month + 1, start.day), total, cash, limit, 0))
    return out


def payments(spark, rows):
    return spark.createDataFrame([
        (a, datetime(d.year, d.month, d.day, 12), money(x), "N") for a, d, x in rows], schema.PAYMENTS)


def transactions(spark, rows):
    """(account, date, amount, city, category) tuples."""
    return spark.createDataFrame([
        (a, datetime(d.year, d.month, d.day, 9), money(x), city, cat, "CA", "A", "G1", "P", "T")
        for a, d, x, city, cat in rows], schema.TRANSACTIONS)


def accounts(spark, rows):
    return spark.createDataFrame([(a, date(2018, 6, 1), y) for a, y in rows], schema.ACCOUNTS)


def random_ledger(spark, seed=7, hot_rows=400, others=25, negative=False):
    """Account 1 holds most rows; the others a handful."""
    rng = random.Random(seed)
    day = lambda: date(2016, 1, 1) + timedelta(days=rng.randrange(900))
    sizes = {1: hot_rows, **{a: rng.randrange(1, 18) for a in range(2, others + 2)}}
    stm, pay, txn, i = [], [], [], 0
    for a, n in sizes.items():
        for _ in range(n):
            i += 1
            stm.append((a, i, day(), rng.choice([0, round(rng.uniform(1, 900), 2)]), rng.choice([0, 5, 50]),
                        rng.choice([0, 500, 1000]), rng.randrange(3)))
            low = -80 if negative else 1
            pay.append((a, day(), round(rng.uniform(low, 300), 2)))
            txn += [(a, day(), round(rng.uniform(1, 200), 2), str(rng.randrange(12)), rng.choice("ABC"))
                    for _ in range(2)]
    acc = [(a, None if a % 5 == 0 else rng.randrange(2)) for a in sizes]
    return Ledger(accounts(spark, acc), statements(spark, stm), payments(spark, pay), transactions(spark, txn))
