"""The registered queries as DuckDB SQL over the given tables.

Each query is written as a final SELECT over named subqueries; ``build`` collects the ones it needs.
Doubles are rounded to six decimals on both sides. Exact halves of the last decimal do occur (cents over
round limits) and would hang on the last bit, so both sides add NUDGE first; ``+ 0.0`` is against
negative zeros.
"""

from __future__ import annotations

import re

NUDGE = "1.3e-8"

MEASURES = ["delq_cycle", "credit_limit", "cash_balance", "total_balance",
            "credit_ratio", "cash_ratio", "cash_on_credit_ratio"]
SPREAD = MEASURES[:-1]
COUNTED = ["total_balance", "cash_balance", "delq_cycle"]
TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
BRANDS = sorted(f"Brand#{i}" for i in range(1, 26))
NATIONS = sorted(str(i) for i in range(25))
DECILES = [str(i) for i in range(1, 11)]
SHARE_VALUES = {
    "decision": ["N", "R"], "category": TYPES, "country": NATIONS, "country_decile": DECILES,
    "city_decile": DECILES, "sic_group": BRANDS, "txn_category": ["0", "1", "2", "3"], "txn_type": ["F", "O"],
}
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
# The longest account at the checked scale has 25 statements; the queries read the ranks from the data.
RANKS = list(range(1, 26))
BINS = 20
FOLDS, ROUNDS = 3, 24


def r(expr: str, name: str | None = None) -> str:
    return f"round(CAST({expr} AS DOUBLE) + {NUDGE}, 6) + 0.0 AS {name or expr}"


def d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def days(earlier: str, later: str) -> str:
    return f"CAST(date_diff('day', {earlier}, {later}) AS INTEGER)"


def div(a: str, b: str) -> str:
    return f"({d(a)} / nullif({d(b)}, 0))"


def skew(x: str, mu: str) -> str:
    return (f"CASE WHEN min({x}) < max({x}) THEN sum(pow({x} - {mu}, 3)) / count({x})"
            f" / pow(stddev_samp({x}), 3) END")


def kurt(x: str, mu: str) -> str:
    return (f"CASE WHEN min({x}) < max({x}) THEN sum(pow({x} - {mu}, 4)) / count({x})"
            f" / pow(var_samp({x}), 2) - 3 END")


def slope(y: str, x: str) -> str:
    return f"CASE WHEN regr_sxx({y}, {x}) > 0 THEN regr_slope({y}, {x}) END"


# Subqueries in order of dependency.
CTE: dict[str, str] = {}

CTE["acc"] = """
SELECT c_custkey AS account_id, DATE '2001-12-31' AS as_of,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_acctbal < 0 AS INTEGER) END AS default_flag
FROM customer"""

CTE["stm"] = """
SELECT o_custkey AS account_id, o_orderkey AS statement_id, CAST(o_orderdate AS DATE) AS statement_date,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
  CAST(o_totalprice AS DECIMAL(18,2)) AS raw_total_balance,
  CAST(1000 * (lv - 1) AS DECIMAL(18,2)) AS cash_balance,
  CAST(300000 + 50000 * lv AS DECIMAL(18,2)) AS credit_limit,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS delq_cycle
FROM (SELECT *, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS lv FROM orders)"""

CTE["pay"] = """
SELECT o_custkey AS account_id, l_shipdate AS paid_at, CAST(l_shipdate AS DATE) AS pay_day,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
  CASE WHEN l_linestatus = 'O' THEN 'N' ELSE 'Y' END AS reversal_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_returnflag = 'A' AND l_extendedprice IS NOT NULL"""

CTE["txn"] = """
SELECT o_custkey AS account_id, l_shipdate AS "at", CAST(l_shipdate AS DATE) AS txn_date,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_suppkey AS VARCHAR) AS city, p_type AS category,
  CAST(s_nationkey AS VARCHAR) AS country, l_returnflag AS decision, p_brand AS sic_group,
  CAST(p_size % 4 AS VARCHAR) AS txn_category, l_linestatus AS txn_type
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey
WHERE l_returnflag <> 'A'"""

CTE["evt"] = """
SELECT user_id AS account_id, ts AS "at", CAST(ts AS DATE) AS txn_date, ts AS paid_at,
  CAST(value AS DECIMAL(18,2)) AS amount, event_type AS category
FROM events"""

CTE["ranked"] = """
SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY statement_date DESC, statement_id DESC) AS rank_from_last,
  max(statement_date) OVER (PARTITION BY account_id) AS last_statement_date,
  lead(statement_date) OVER (PARTITION BY account_id ORDER BY statement_date, statement_id) AS following_date,
  total_balance - lag(total_balance) OVER (PARTITION BY account_id ORDER BY statement_date, statement_id) AS balance_delta
FROM (SELECT *, CASE WHEN raw_total_balance IS NULL OR cash_balance IS NULL THEN NULL
             ELSE greatest(raw_total_balance, cash_balance) END AS total_balance FROM stm)"""


def _ratios(total: str, prefix: str) -> str:
    return (f"{div(total, 'credit_limit')} AS {prefix}credit_ratio, {div('cash_balance', 'credit_limit')} AS {prefix}cash_ratio, "
            f"CASE WHEN cash_balance > 0 THEN {div('cash_balance', total)} WHEN cash_balance IS NOT NULL THEN 0.0 END "
            f"AS {prefix}cash_on_credit_ratio")


CTE["enr"] = f"""
SELECT * EXCLUDE (following_date),
  CASE WHEN rank_from_last <= 4 THEN 4 WHEN rank_from_last <= 7 THEN 3 WHEN rank_from_last <= 10 THEN 2
       WHEN rank_from_last <= 14 THEN 1 ELSE 5 END AS q,
  CASE WHEN rank_from_last <= 7 THEN 1 WHEN rank_from_last <= 14 THEN 2 ELSE 5 END AS h,
  CAST(statement_date = last_statement_date AS INTEGER) AS is_last_statement,
  coalesce(following_date, statement_date + 30) AS next_statement_date,
  {_ratios('total_balance', '')}, {_ratios('raw_total_balance', 'raw_')}
FROM ranked"""

CTE["qstart"] = """
SELECT account_id, q, min(statement_date) AS first_date FROM enr WHERE q <> 5 GROUP BY account_id, q"""

CTE["qlim"] = """
SELECT account_id, q, CASE WHEN q <> 1 THEN first_date END AS start_date,
  CASE WHEN q <> 4 THEN lead(first_date) OVER (PARTITION BY account_id ORDER BY q) - 1 END AS end_date
FROM qstart"""

CTE["ppd"] = f"""
SELECT account_id, statement_id, statement_date, is_last_statement, rank_from_last, paid_until_next,
  CASE WHEN total_balance = 0 OR paid_until_next > total_balance THEN 1.0
       ELSE {div('paid_until_next', 'total_balance')} END AS pct_paid
FROM (SELECT e.account_id, e.statement_id, e.statement_date, e.is_last_statement, e.rank_from_last, e.total_balance,
        coalesce(sum(p.amount), 0) AS paid_until_next
      FROM enr e LEFT JOIN pay p ON p.account_id = e.account_id AND p.pay_day >= e.statement_date
        AND p.pay_day < e.next_statement_date
      GROUP BY ALL)"""

CTE["bills"] = "SELECT * FROM enr WHERE total_balance > 0"

CTE["after"] = """
SELECT b.account_id, b.statement_id, b.total_balance, p.pay_day, sum(p.amount) AS day_amount
FROM bills b JOIN pay p ON p.account_id = b.account_id AND p.pay_day >= b.statement_date GROUP BY ALL"""

CTE["nextpay"] = "SELECT account_id, statement_id, min(pay_day) AS next_payment_date FROM after GROUP BY ALL"

CTE["fullpay"] = """
SELECT account_id, statement_id, min(pay_day) AS full_payment_date
FROM (SELECT *, sum(day_amount) OVER (PARTITION BY account_id, statement_id ORDER BY pay_day) AS so_far FROM after)
WHERE so_far >= total_balance GROUP BY ALL"""

CTE["delays"] = f"""
SELECT b.account_id, b.statement_id, b.statement_date, b.period, b.last_statement_date, b.is_last_statement,
  b.total_balance, n.next_payment_date, f.full_payment_date,
  {days('b.statement_date', 'n.next_payment_date')} AS next_delay,
  {days('b.statement_date', 'f.full_payment_date')} AS full_delay,
  {days('b.statement_date', 'b.last_statement_date')} + 60 AS open_days
FROM bills b LEFT JOIN nextpay n USING (account_id, statement_id) LEFT JOIN fullpay f USING (account_id, statement_id)"""

CTE["outc"] = """
SELECT * EXCLUDE (open_days),
  coalesce(next_delay, greatest(max(next_delay) OVER (PARTITION BY account_id), open_days)) AS next_delay_capped,
  coalesce(full_delay, greatest(max(full_delay) OVER (PARTITION BY account_id), open_days)) AS full_delay_capped
FROM delays"""

CTE["outc_mu"] = """
SELECT *, avg(next_delay) OVER (PARTITION BY account_id) AS mu_next, avg(full_delay) OVER (PARTITION BY account_id) AS mu_full
FROM outc WHERE is_last_statement = 0"""


def _bill_kind(k: str) -> str:
    return (f"{d('count(*) FILTER (WHERE ' + k + '_delay IS NULL)')} / count(*) AS pct_no_{k}_payment, "
            f"avg({k}_delay) AS mean_{k}_delay, max({k}_delay) AS max_{k}_delay, "
            f"{kurt(k + '_delay', 'mu_' + k)} AS kurtosis_{k}_delay, {skew(k + '_delay', 'mu_' + k)} AS skewness_{k}_delay, "
            f"arg_max_null({k}_delay, row(period, statement_date, statement_id)) AS last_{k}_delay")


CTE["bsum"] = f"""
SELECT account_id, count(*) AS count_bills, {_bill_kind('next')}, {_bill_kind('full')} FROM outc_mu GROUP BY account_id"""
BSUM = ["pct_no_{}_payment", "mean_{}_delay", "max_{}_delay", "kurtosis_{}_delay", "skewness_{}_delay", "last_{}_delay"]
BSUM_NAMES = [c.format(k) for k in ("next", "full") for c in BSUM]
BSUM_INTS = ["max_next_delay", "last_next_delay", "max_full_delay", "last_full_delay"]

CTE["tdelay"] = f"""
SELECT account_id, {slope('full_delay_capped', 'dd')} AS trend_full_delay, {slope('next_delay_capped', 'dd')} AS trend_next_delay
FROM (SELECT *, date_diff('day', last_statement_date, statement_date) AS dd FROM outc WHERE is_last_statement = 0)
GROUP BY account_id"""

CTE["tratio"] = f"""
SELECT account_id, {slope('raw_credit_ratio', 'dd')} AS trend_credit_ratio, {slope('raw_cash_ratio', 'dd')} AS trend_cash_ratio,
  {slope('raw_cash_on_credit_ratio', 'dd')} AS trend_cash_on_credit_ratio
FROM (SELECT *, date_diff('day', last_statement_date, statement_date) AS dd FROM enr) GROUP BY account_id"""

CTE["tpaid"] = f"""
SELECT account_id, {slope('pct_paid', 'rn')} AS trend_pct_paid
FROM (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY rank_from_last DESC) AS rn
      FROM ppd WHERE is_last_statement = 0) GROUP BY account_id"""

CTE["ppd_mu"] = "SELECT *, avg(pct_paid) OVER (PARTITION BY account_id) AS mu FROM ppd WHERE is_last_statement = 0"


def at_rank(m: str, k: int) -> str:
    return f"max(CASE WHEN rank_from_last = {k} THEN {d(m)} END) AS {m}_t_minus_{k}"


CTE["ppd_wide"] = ("SELECT account_id, " + ", ".join(at_rank("pct_paid", k) for k in RANKS)
                   + " FROM ppd GROUP BY account_id")
CTE["psum"] = f"""
SELECT s.*, w.* EXCLUDE (account_id) FROM (
  SELECT account_id, avg(pct_paid) AS mean_pct_paid, max(pct_paid) AS max_pct_paid, min(pct_paid) AS min_pct_paid,
    {kurt('pct_paid', 'mu')} AS kurtosis_pct_paid, {skew('pct_paid', 'mu')} AS skewness_pct_paid
  FROM ppd_mu GROUP BY account_id) s LEFT JOIN ppd_wide w USING (account_id)"""
PSUM = [f"{s}_pct_paid" for s in ("mean", "max", "min", "kurtosis", "skewness")] + [f"pct_paid_t_minus_{k}" for k in RANKS]

WIDE = ["credit_ratio", "balance_delta", "total_balance"]
WIDE_NAMES = [f"{m}_t_minus_{k}" for m in WIDE for k in RANKS]
CTE["swide"] = ("SELECT account_id, " + ", ".join(at_rank(m, k) for m in WIDE for k in RANKS)
                + " FROM enr GROUP BY account_id")


def summary_sql(keys: str, annual: bool = False) -> str:
    mus = ", ".join(f"avg({d(m)}) OVER (PARTITION BY {keys}) AS mu_{m}" for m in MEASURES)
    cols = [f"count(*) FILTER (WHERE {m} > 0) AS count_positive_{m}" for m in COUNTED]
    for m in MEASURES:
        cols += [f"{d('sum(' + m + ')')} AS sum_{m}", f"max({d(m)}) AS max_{m}", f"avg({d(m)}) AS mean_{m}",
                 f"min({d(m)}) AS min_{m}", f"{kurt(d(m), 'mu_' + m)} AS kurtosis_{m}"]
    cols += [f"{skew(d(m), 'mu_' + m)} AS skewness_{m}" for m in (MEASURES if annual else SPREAD)]
    for m in SPREAD:
        cols += [f"stddev_samp({d(m)}) AS sd_{m}", f"quantile_cont({d(m)}, 0.25) AS p25_{m}",
                 f"quantile_cont({d(m)}, 0.75) AS p75_{m}"]
    if annual:
        cols += ["count(*) AS count_statements"]
        for m in MEASURES:
            cols += [f"arg_max_null({d(m)}, row(period, statement_date, statement_id)) AS last_{m}",
                     f"arg_min_null({d(m)}, row(period, statement_date, statement_id)) AS first_{m}"]
    return f"SELECT {keys}, {', '.join(cols)} FROM (SELECT *, {mus} FROM enr) GROUP BY {keys}"


SUM_STATS = ([f"count_positive_{m}" for m in COUNTED]
             + [f"{s}_{m}" for m in MEASURES for s in ("sum", "max", "mean", "min", "kurtosis")]
             + [f"{s}_{m}" for m in SPREAD for s in ("skewness", "sd", "p25", "p75")])
SUM_COUNTS = {f"count_positive_{m}" for m in COUNTED}


def widened(source: str, by: str, values: list[int], names: list[str]) -> str:
    return (f"SELECT account_id, " + ", ".join(
        f"max(CASE WHEN {by} = {v} THEN {n} END) AS {n}_{by.upper()}{v}" for v in values for n in names)
        + f" FROM {source} GROUP BY account_id")


CTE["sumq_long"] = summary_sql("account_id, q")
CTE["sumh_long"] = summary_sql("account_id, h")
CTE["sumq"] = widened("sumq_long", "q", [1, 2, 3, 4, 5], SUM_STATS)
CTE["sumh"] = widened("sumh_long", "h", [1, 2, 5], SUM_STATS)
CTE["suma_base"] = summary_sql("account_id", annual=True)
EXTREMES = ["credit_limit", "credit_ratio", "cash_ratio"]
DELTAS = ["credit_ratio", "cash_ratio", "total_balance", "credit_limit"]
CTE["suma"] = "SELECT *, " + ", ".join(
    [f"CAST(last_{m} = max_{m} AND last_{m} > min_{m} AS INTEGER) AS at_new_max_{m}, "
     f"CAST(last_{m} = min_{m} AND last_{m} < max_{m} AS INTEGER) AS at_new_min_{m}" for m in EXTREMES]
    + [f"last_{m} - first_{m} AS annual_delta_{m}" for m in DELTAS]
    + ["CASE WHEN max_credit_ratio > 0 THEN last_credit_ratio / max_credit_ratio WHEN max_credit_ratio IS NOT NULL THEN 1.0 END "
       "AS last_on_max_credit_ratio", "last_credit_ratio * last_delq_cycle AS last_credit_ratio_x_last_delq_cycle"]
) + " FROM suma_base"
SUMA_DOUBLES = ([c for c in SUM_STATS if c not in SUM_COUNTS] + ["skewness_cash_on_credit_ratio"]
                + [f"{s}_{m}" for m in MEASURES for s in ("last", "first")]
                + [f"annual_delta_{m}" for m in DELTAS]
                + ["last_on_max_credit_ratio", "last_credit_ratio_x_last_delq_cycle"])
SUMA_INTS = sorted(SUM_COUNTS) + ["count_statements"] + [f"at_new_{e}_{m}" for m in EXTREMES for e in ("max", "min")]

CTE["pmon"] = """
SELECT account_id, CAST(date_trunc('month', paid_at) AS DATE) AS month, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total
FROM pay GROUP BY ALL"""
CTE["pmonth"] = """
SELECT account_id, CAST(sum(n) AS BIGINT) AS count_monthly_payments, sum(n * total) / sum(n) AS mean_monthly_payment,
  max(total) AS max_monthly_payment, min(total) AS min_monthly_payment, arg_max(total, month) AS last_monthly_payment
FROM pmon GROUP BY account_id"""
PMONTH = ["mean_monthly_payment", "max_monthly_payment", "min_monthly_payment", "last_monthly_payment"]
CTE["paysum"] = f"""
SELECT s.*, m.* EXCLUDE (account_id) FROM (
  SELECT account_id, count(*) AS count_payments, CAST(max(paid_at) AS DATE) AS last_payment_date,
    min({d('amount')}) AS min_payment, avg({d('amount')}) AS mean_payment, max({d('amount')}) AS max_payment,
    {d('sum(amount)')} AS sum_payment, {kurt(d('amount'), 'mu')} AS kurtosis_payment, {skew(d('amount'), 'mu')} AS skewness_payment,
    count(*) FILTER (WHERE reversal_flag = 'N') AS n_not_reversed, 1 AS has_payment_data
  FROM (SELECT *, avg({d('amount')}) OVER (PARTITION BY account_id) AS mu FROM pay) GROUP BY account_id) s
LEFT JOIN pmonth m USING (account_id)"""
PAYSUM = ["min_payment", "mean_payment", "max_payment", "sum_payment", "kurtosis_payment", "skewness_payment", *PMONTH]

CTE["tq"] = """
SELECT t.*, l.q FROM txn t JOIN qlim l ON l.account_id = t.account_id
 AND (l.start_date IS NULL OR t.txn_date >= l.start_date) AND (l.end_date IS NULL OR t.txn_date <= l.end_date)"""

DISTINCT = ["city", "category", "country", "txn_type", "sic_group"]


def txn_summary(keys: str, source: str) -> str:
    return (f"SELECT {keys}, count(*) AS count_transactions, max({d('amount')}) AS max_amount, stddev_samp({d('amount')}) AS sd_amount, "
            f"avg({d('amount')}) AS mean_amount, {d('sum(amount)')} AS sum_amount, CAST(max(\"at\") AS DATE) AS last_transaction_date, "
            f"quantile_cont({d('amount')}, 0.25) AS p25_amount, quantile_cont({d('amount')}, 0.75) AS p75_amount, "
            + ", ".join(f"count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) AS n_distinct_{c}" for c in DISTINCT)
            + f" FROM {source} GROUP BY {keys}")


TXN_DOUBLES = ["max_amount", "sd_amount", "mean_amount", "sum_amount", "p25_amount", "p75_amount"]
TXN_OTHERS = ["count_transactions", "last_transaction_date"] + [f"n_distinct_{c}" for c in DISTINCT]
CTE["txa"] = txn_summary("account_id", "txn")
CTE["txq_long"] = txn_summary("account_id, q", "tq")
CTE["txq"] = widened("txq_long", "q", [1, 2, 3, 4], TXN_DOUBLES + TXN_OTHERS)

for _c in ("city", "category", "country"):
    CTE[f"dec_{_c}"] = (f"SELECT {_c}, CAST(ntile(10) OVER (ORDER BY n, {_c}) AS INTEGER) AS {_c}_decile "
                        f"FROM (SELECT {_c}, count(*) AS n FROM txn GROUP BY {_c})")
CTE["txd"] = """
SELECT t.*, a.city_decile, b.category_decile, c.country_decile FROM txn t
LEFT JOIN dec_city a ON t.city IS NOT DISTINCT FROM a.city LEFT JOIN dec_category b ON t.category IS NOT DISTINCT FROM b.category
LEFT JOIN dec_country c ON t.country IS NOT DISTINCT FROM c.country"""


def share_cols(variable: str, values: list[str], prefix: str | None = None) -> str:
    prefix = f"{variable}_pct_sum_" if prefix is None else prefix
    return ", ".join(
        f"{d('coalesce(sum(amount) FILTER (WHERE CAST(' + variable + ' AS VARCHAR) = ' + repr(v) + '), 0)')}"
        f" / nullif({d('sum(amount)')}, 0) AS \"{prefix}{v}\"" for v in values)


def share_round(variable: str, values: list[str], prefix: str | None = None) -> str:
    prefix = f"{variable}_pct_sum_" if prefix is None else prefix
    return ", ".join(f"round(\"{prefix}{v}\" + {NUDGE}, 6) + 0.0 AS \"{prefix}{v}\"" for v in values)


for _v, _values in SHARE_VALUES.items():
    CTE[f"shr_{_v}"] = f"SELECT account_id, {share_cols(_v, _values)} FROM txd GROUP BY account_id"

for _c in ("city", "country", "category"):
    CTE[f"div_{_c}"] = (f"SELECT account_id, sum(pow({d('n')}, 2)) / pow(sum({d('n')}), 2) AS index_{_c} "
                        f"FROM (SELECT account_id, {_c}, count(*) AS n FROM txn GROUP BY ALL) GROUP BY account_id")


def favorite(keys: str, source: str, column: str, name: str, where: str = "true", numeric: bool = False) -> str:
    tie = f"try_cast({column} AS BIGINT) NULLS LAST, {column}" if numeric else column
    return (f"SELECT {keys}, {column} AS {name} FROM (SELECT {keys}, {column}, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY n DESC, {column} IS NULL, {tie}) AS rn FROM (SELECT {keys}, {column}, count(*) AS n FROM {source} "
            f"WHERE {where} GROUP BY ALL)) WHERE rn = 1")


def pooled(source: str, column: str) -> str:
    return (f"SELECT *, CASE WHEN {column} IS NOT NULL THEN CASE WHEN count(*) OVER (PARTITION BY {column}) > 10 "
            f"THEN {column} ELSE '999999999999' END END AS {column}_code FROM {source}")


CTE["favc"] = favorite("account_id", "tq", "city", "favorite_city", numeric=True)
CTE["favc_pool"] = pooled("favc", "favorite_city")
CTE["favq"] = favorite("account_id, q", "tq", "city", "favorite_city", numeric=True)
CTE["favq_pool"] = pooled("favq", "favorite_city")
CTE["favsic"] = favorite("account_id", "txn", "sic_group", "favorite_sic_group")
CTE["favcat"] = favorite("account_id", "txn", "category", "favorite_category",
                         where="category IS NULL OR category NOT IN ('WW', 'D')")
CTE["favcat_x"] = favorite("account_id", "txn", "category", "favorite_category",
                           where="category IS NULL OR category NOT IN ('ECONOMY', 'SMALL')")
CTE["moves_w"] = widened("favq_pool", "q", [1, 2, 3, 4], ["favorite_city_code"])
CTE["moves_m"] = "SELECT *, " + ", ".join(
    f"coalesce(CAST(favorite_city_code_Q{q} <> favorite_city_code_Q{q - 1} AS INTEGER), 0) AS moved_q{q}" for q in (2, 3, 4)
) + " FROM moves_w"
CTE["moves"] = "SELECT *, moved_q2 + moved_q3 + moved_q4 AS moves FROM moves_m"


def gaps_sql(source: str) -> str:
    return (f"SELECT * FROM (SELECT account_id, txn_date, {days('lag(txn_date) OVER (PARTITION BY account_id ORDER BY txn_date)', 'txn_date')} "
            f"AS gap_days FROM (SELECT DISTINCT account_id, txn_date FROM {source})) WHERE gap_days IS NOT NULL")


def gap_summary(source: str) -> str:
    return (f"SELECT account_id, avg(gap_days) AS mean_days_between, CAST(max(gap_days) AS DOUBLE) AS max_days_between, "
            f"CAST(min(gap_days) AS DOUBLE) AS min_days_between, CAST(sum(gap_days) AS DOUBLE) AS sum_days_between, "
            f"{kurt('gap_days', 'mu')} AS kurtosis_days_between, {skew('gap_days', 'mu')} AS skewness_days_between, "
            f"quantile_cont(gap_days, 0.25) AS p25_days_between, quantile_cont(gap_days, 0.75) AS p75_days_between, "
            f"stddev_samp(gap_days) AS sd_days_between "
            f"FROM (SELECT *, avg(gap_days) OVER (PARTITION BY account_id) AS mu FROM {source}) GROUP BY account_id")


GAP = [f"{s}_days_between" for s in ("mean", "max", "min", "sum", "kurtosis", "skewness", "p25", "p75", "sd")]
CTE["gaps"] = gaps_sql("txn")
CTE["gapsum"] = gap_summary("gaps")
CTE["egaps"] = gaps_sql("evt")
CTE["egapsum"] = gap_summary("egaps")

CTE["place"] = """
SELECT *, row_number() OVER (PARTITION BY default_flag ORDER BY md5(CAST(account_id AS VARCHAR)), account_id) AS place,
  count(*) OVER (PARTITION BY default_flag) AS label_size FROM acc"""
CTE["folds"] = "SELECT account_id, default_flag, CAST((place - 1) % 50 + 1 AS INTEGER) AS fold FROM place"
CTE["coded"] = "SELECT f.*, c.favorite_city_code FROM folds f LEFT JOIN favc_pool c USING (account_id)"
CTE["cityfold"] = """
SELECT favorite_city_code, fold, sum(default_flag) AS bad, count(*) AS n FROM coded WHERE default_flag IS NOT NULL GROUP BY ALL"""
CTE["citymean"] = f"""
SELECT c.account_id, c.favorite_city_code,
  {div('sum(f.bad)', 'sum(f.n)')} AS city_mean_default
FROM coded c LEFT JOIN cityfold f ON c.favorite_city_code IS NOT DISTINCT FROM f.favorite_city_code
  AND (c.default_flag IS NULL OR f.fold <> c.fold)
GROUP BY c.account_id, c.favorite_city_code"""

CTE["stf"] = """
SELECT a.*, w.* EXCLUDE (account_id), h.* EXCLUDE (account_id), q.* EXCLUDE (account_id),
  CASE WHEN "mean_credit_ratio_Q1" > 1 THEN "mean_credit_ratio_Q4" / "mean_credit_ratio_Q1"
       WHEN "mean_credit_ratio_Q1" IS NOT NULL THEN 1.0 END AS "credit_ratio_Q4_on_Q1"
FROM suma a LEFT JOIN swide w USING (account_id) LEFT JOIN sumh h USING (account_id) LEFT JOIN sumq q USING (account_id)"""

CTE["txf"] = ("SELECT a.*, q.* EXCLUDE (account_id), "
              + ", ".join(f"s_{v}.* EXCLUDE (account_id)" for v in SHARE_VALUES)
              + ", fs.favorite_sic_group, fc.favorite_category, m.* EXCLUDE (account_id), d1.index_city, d2.index_country, "
                "d3.index_category, g.* EXCLUDE (account_id), 1 AS has_transaction_data FROM txa a "
                "LEFT JOIN txq q USING (account_id) "
              + " ".join(f"LEFT JOIN shr_{v} s_{v} USING (account_id)" for v in SHARE_VALUES)
              + " LEFT JOIN favsic fs USING (account_id) LEFT JOIN favcat fc USING (account_id) LEFT JOIN moves m USING (account_id) "
                "LEFT JOIN div_city d1 USING (account_id) LEFT JOIN div_country d2 USING (account_id) "
                "LEFT JOIN div_category d3 USING (account_id) LEFT JOIN gapsum g USING (account_id)")

CTE["fpay"] = "SELECT DISTINCT account_id, 1 AS has_full_payment FROM outc WHERE full_payment_date IS NOT NULL"

CTE["joined"] = """
SELECT acc.account_id, acc.as_of, acc.default_flag, p.* EXCLUDE (account_id, has_payment_data), t.* EXCLUDE (account_id, has_transaction_data),
  c.favorite_city_code, c.city_mean_default, s.* EXCLUDE (account_id),
  b.* EXCLUDE (account_id, count_bills), td.trend_full_delay, td.trend_next_delay, tr.* EXCLUDE (account_id),
  ps.* EXCLUDE (account_id), tp.trend_pct_paid,
  coalesce(p.has_payment_data, 0) AS has_payment_data, coalesce(t.has_transaction_data, 0) AS has_transaction_data,
  coalesce(f.has_full_payment, 0) AS has_full_payment, coalesce(b.count_bills, 0) AS count_bills,
  CAST(count_statements = 14 AS INTEGER) AS has_14_statements, CAST(coalesce(b.count_bills, 0) = 0 AS INTEGER) AS has_no_bill,
  CAST(year(acc.as_of) AS INTEGER) AS "year"
FROM acc LEFT JOIN paysum p USING (account_id) LEFT JOIN txf t USING (account_id) LEFT JOIN citymean c USING (account_id)
LEFT JOIN stf s USING (account_id) LEFT JOIN bsum b USING (account_id)
LEFT JOIN tdelay td ON td.account_id = b.account_id LEFT JOIN tratio tr ON tr.account_id = acc.account_id
LEFT JOIN psum ps ON ps.account_id = acc.account_id LEFT JOIN tpaid tp ON tp.account_id = acc.account_id
LEFT JOIN fpay f ON f.account_id = acc.account_id"""

RATIOS = {
    "credit_limit_paid_per_year": div("sum_payment", "last_credit_limit"),
    "credit_limit_spent_per_year": div("sum_amount", "last_credit_limit"),
    "ratio_spent_on_payment": div("sum_amount", "sum_payment"),
    "ratio_payment_on_owed": "CASE WHEN last_total_balance > 0 THEN last_monthly_payment / last_total_balance "
                             "WHEN last_total_balance IS NOT NULL THEN 1.0 END",
}
_since = days("last_payment_date", "as_of")
RECENCY = {
    "credit_ratio_x_days_since_payment": f"{_since} * last_credit_ratio",
    "credit_ratio_x_days_since_payment_x_delq": f"{_since} * last_credit_ratio * last_delq_cycle",
    "cash_ratio_x_days_since_payment": f"{_since} * last_cash_ratio",
}
RECENCY_INTS = {
    "days_since_last_payment": _since,
    "days_since_last_transaction": days("last_transaction_date", "as_of"),
    "days_from_last_payment_to_last_transaction": days("last_payment_date", "last_transaction_date"),
}
CTE["feat"] = "SELECT *, " + ", ".join(
    f"{e} AS {n}" for n, e in {**RATIOS, **RECENCY, **RECENCY_INTS}.items()) + " FROM joined"

STF_WIDE = ([f"{n}_H{v}" for v in (1, 2, 5) for n in SUM_STATS] + [f"{n}_Q{v}" for v in (1, 2, 3, 4, 5) for n in SUM_STATS])
STF_WIDE_DOUBLES = [c for c in STF_WIDE if not c.startswith("count_positive")]
STF_WIDE_INTS = [c for c in STF_WIDE if c.startswith("count_positive")]
TXQ_DOUBLES = [f"{n}_Q{q}" for q in (1, 2, 3, 4) for n in TXN_DOUBLES]
TXQ_OTHERS = [f"{n}_Q{q}" for q in (1, 2, 3, 4) for n in TXN_OTHERS]
SHARE_NAMES = [f"{v}_pct_sum_{x}" for v, xs in SHARE_VALUES.items() for x in xs]
MOVES = [f"favorite_city_code_Q{q}" for q in (1, 2, 3, 4)] + ["moved_q2", "moved_q3", "moved_q4", "moves"]
FLAGS = ["has_payment_data", "has_transaction_data", "has_full_payment", "count_bills", "has_14_statements", "has_no_bill", "year"]

FEATURE_DOUBLES = (PAYSUM + TXN_DOUBLES + TXQ_DOUBLES + SHARE_NAMES + ["index_city", "index_country", "index_category"] + GAP
                   + ["city_mean_default"] + SUMA_DOUBLES + WIDE_NAMES + STF_WIDE_DOUBLES + ["credit_ratio_Q4_on_Q1"]
                   + [c for c in BSUM_NAMES if c not in BSUM_INTS] + ["trend_full_delay", "trend_next_delay", "trend_credit_ratio",
                      "trend_cash_ratio", "trend_cash_on_credit_ratio"] + PSUM + ["trend_pct_paid"] + list(RATIOS) + list(RECENCY))
FEATURE_OTHERS = (["account_id", "default_flag", "count_payments", "last_payment_date", "n_not_reversed", "count_monthly_payments"]
                  + TXN_OTHERS + TXQ_OTHERS + ["favorite_sic_group", "favorite_category"] + MOVES + ["favorite_city_code"]
                  + SUMA_INTS + STF_WIDE_INTS + BSUM_INTS + list(RECENCY_INTS) + FLAGS)
DROPPED = {"last_credit_ratio", "balance_delta_t_minus_14"}
ASSEMBLED_DOUBLES = [c for c in FEATURE_DOUBLES if c not in DROPPED]

ZERO_FILLED = {
    "count_payments", "min_payment", "max_payment", "mean_payment", "sum_payment", "n_not_reversed",
    "count_monthly_payments", *PMONTH, "credit_limit_paid_per_year", "ratio_spent_on_payment", "ratio_payment_on_owed",
    "days_since_last_payment", *RECENCY, "days_from_last_payment_to_last_transaction", "last_payment_date",
    "mean_next_delay", "max_next_delay", "last_next_delay", "trend_next_delay", "pct_no_next_payment",
    "mean_full_delay", "max_full_delay", "last_full_delay", "trend_full_delay", "pct_no_full_payment",
    "credit_ratio_t_minus_14", "balance_delta_t_minus_13", "total_balance_t_minus_14", "pct_paid_t_minus_14",
}


def finished_column(c: str) -> str:
    """A column of the finished feature table: dates as day numbers, chosen columns 0 for NULL."""
    q = f'"{c}"'
    expr = days("DATE '1970-01-01'", q) if "_date" in c else q
    if c in ZERO_FILLED:
        expr = f"coalesce({expr}, 0)"
    if c in ASSEMBLED_DOUBLES:
        return f"round(CAST({expr} AS DOUBLE) + {NUDGE}, 6) + 0.0 AS {q}"
    return f"{expr} AS {q}"


FINISHED = [c for c in FEATURE_OTHERS + ASSEMBLED_DOUBLES if not c.startswith(("kurtosis", "skewness"))]
CTE["fin"] = "SELECT " + ", ".join(finished_column(c) for c in FINISHED) + " FROM feat"


def build(select: str) -> str:
    """The final SELECT with the subqueries it needs, in order."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"[a-z_]+[a-z_0-9]*", pending.pop()))
        for name in CTE:
            if name in words and name not in needed:
                needed.add(name)
                pending.append(CTE[name])
    if not needed:
        return select
    parts = ",\n".join(f"{name} AS MATERIALIZED ({CTE[name]})" for name in CTE if name in needed)
    return f"WITH {parts}\n{select}"


def rounded(source: str, others: list[str], doubles: list[str]) -> str:
    return ("SELECT " + ", ".join([f'"{c}"' for c in others] + [f'round(CAST("{c}" AS DOUBLE) + {NUDGE}, 6) + 0.0 AS "{c}"' for c in doubles])
            + f" FROM {source}")


ENR_OTHERS = ["account_id", "statement_id", "statement_date", "period", "delq_cycle", "rank_from_last", "last_statement_date",
              "q", "h", "is_last_statement", "next_statement_date"]
ENR_DOUBLES = ["total_balance", "cash_balance", "credit_limit", "raw_total_balance", "balance_delta", "credit_ratio", "cash_ratio",
               "cash_on_credit_ratio", "raw_credit_ratio", "raw_cash_ratio", "raw_cash_on_credit_ratio"]
ENR_SELECT = ("SELECT " + ", ".join(ENR_OTHERS) + ", "
              + ", ".join(r(c) for c in ENR_DOUBLES) + " FROM enr")


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}

    # Reading, projection and cleaning.
    q["union_by_name"] = ("SELECT account_id, as_of, default_flag FROM acc WHERE default_flag IS NOT NULL UNION ALL "
                          "SELECT account_id, as_of, CAST(NULL AS INTEGER) AS default_flag FROM acc WHERE default_flag IS NULL")
    q["select_rename_drop"] = f"SELECT account_id, statement_id, {r('raw_total_balance', 'owed')} FROM stm"
    q["select_by_pattern"] = f"SELECT account_id, statement_id, {r('raw_total_balance', 'total_balance')}, {r('cash_balance')} FROM stm"
    q["select_by_type"] = "SELECT account_id, statement_date, period FROM stm"
    q["dates_to_numeric"] = ("SELECT account_id, statement_id, CAST(date_diff('day', DATE '1970-01-01', statement_date) AS INTEGER) AS statement_date, "
                             "CAST(date_diff('day', DATE '1970-01-01', period) AS INTEGER) AS period FROM stm")
    q["exclude_categories"] = f"SELECT account_id, txn_date, category, {r('amount')} FROM txn WHERE category IS NULL OR category NOT IN ('ECONOMY', 'SMALL')"
    q["drop_null_payments"] = f"SELECT account_id, paid_at, {r('amount')}, reversal_flag FROM pay"
    q["distinct_statement_days"] = "SELECT DISTINCT account_id, statement_date FROM stm"
    q["fill_null"] = "SELECT account_id, coalesce(default_flag, 0) AS default_flag FROM acc"
    q["recode_label"] = ("SELECT account_id, CASE default_flag WHEN 1 THEN 'yes' WHEN 0 THEN 'no' END AS label_name, "
                         "CAST(default_flag = 0 AS INTEGER) AS label_0, CAST(default_flag = 1 AS INTEGER) AS label_1 FROM acc")
    q["correct_balance"] = (f"SELECT account_id, statement_id, {r('total_balance')}, {r('raw_total_balance')} FROM enr")
    q["ratio_features"] = (f"SELECT account_id, statement_id, {r('credit_ratio')}, {r('cash_ratio')}, {r('cash_on_credit_ratio')} FROM enr")
    q["positive_bills"] = f"SELECT account_id, statement_id, statement_date, {r('total_balance')} FROM bills"
    q["split_by_label_presence"] = "SELECT account_id, default_flag FROM acc WHERE default_flag IS NOT NULL"

    # Statements.
    q["rank_from_last"] = "SELECT account_id, statement_id, rank_from_last FROM enr"
    q["period_bucket"] = "SELECT account_id, statement_id, q, h FROM enr"
    q["next_and_last_date"] = "SELECT account_id, statement_id, next_statement_date, last_statement_date, is_last_statement FROM enr"
    q["statement_enriched"] = ENR_SELECT
    q["quarter_limits"] = "SELECT account_id, q, start_date, end_date FROM qlim"
    q["balance_delta"] = f"SELECT account_id, statement_id, {r('balance_delta')} FROM enr"
    q["statement_wide"] = rounded("swide", ["account_id"], WIDE_NAMES)
    q["statement_series"] = (f"SELECT account_id, CAST((rank_from_last - 1) // 64 AS BIGINT) AS block, CAST(min(rank_from_last) AS INTEGER) AS first_rank, "
                             f"count(*) AS n_ranks, {r('sum(credit_ratio)', 'sum_credit_ratio')}, {r('arg_min(total_balance, rank_from_last)', 'first_total_balance')}, "
                             f"{r('arg_max(total_balance, rank_from_last)', 'last_total_balance')} FROM enr GROUP BY 1, 2")
    q["unpivot_long"] = " UNION ALL ".join(
        f"SELECT account_id, statement_id, '{m}' AS measure, {r(m, 'value')} FROM enr" for m in ("credit_ratio", "cash_ratio", "cash_on_credit_ratio"))
    q["summary_quarter"] = rounded("sumq", ["account_id"] + [c for c in STF_WIDE_INTS if "_Q" in c], [c for c in STF_WIDE_DOUBLES if "_Q" in c])
    q["summary_semester"] = rounded("sumh", ["account_id"] + [c for c in STF_WIDE_INTS if "_H" in c], [c for c in STF_WIDE_DOUBLES if "_H" in c])
    q["summary_annual"] = rounded("suma", ["account_id"] + SUMA_INTS, SUMA_DOUBLES)
    q["moments"] = (f"SELECT account_id, {r(skew(d('amount'), 'mu'), 'skewness_amount')}, {r(kurt(d('amount'), 'mu'), 'kurtosis_amount')} "
                    f"FROM (SELECT *, avg({d('amount')}) OVER (PARTITION BY account_id) AS mu FROM txn) GROUP BY account_id")
    q["last_first_value"] = rounded("suma", ["account_id"], [f"{s}_{m}" for m in MEASURES for s in ("last", "first")])
    q["new_extreme_flags"] = rounded("suma", ["account_id"] + [f"at_new_{e}_{m}" for m in EXTREMES for e in ("max", "min")], [])
    q["annual_delta"] = rounded("suma", ["account_id"], [f"annual_delta_{m}" for m in DELTAS]
                                + ["last_on_max_credit_ratio", "last_credit_ratio_x_last_delq_cycle"])
    q["quarter_ratio"] = rounded("stf", ["account_id"], ["credit_ratio_Q4_on_Q1"])
    q["quarter_ratio_low"] = ("SELECT account_id, " + r("CASE WHEN \"mean_credit_ratio_Q1\" > 0.2 THEN \"mean_credit_ratio_Q4\" / \"mean_credit_ratio_Q1\" "
                              "WHEN \"mean_credit_ratio_Q1\" IS NOT NULL THEN 1.0 END", "credit_ratio_q4_on_q1") + " FROM sumq")
    q["trend_credit_ratio"] = rounded("tratio", ["account_id"], ["trend_credit_ratio"])
    q["trend_cash_ratio"] = rounded("tratio", ["account_id"], ["trend_cash_ratio"])
    q["trend_cash_on_credit_ratio"] = rounded("tratio", ["account_id"], ["trend_cash_on_credit_ratio"])
    q["trend_pct_paid"] = rounded("tpaid", ["account_id"], ["trend_pct_paid"])
    q["trend_full_delay"] = rounded("tdelay", ["account_id"], ["trend_full_delay"])
    q["trend_next_delay"] = rounded("tdelay", ["account_id"], ["trend_next_delay"])

    # Payments.
    q["running_paid"] = (f"SELECT account_id, pay_day AS day, {r('amt', 'amount')}, {r('sum(amt) OVER (PARTITION BY account_id ORDER BY pay_day)', 'paid_so_far')} "
                         "FROM (SELECT account_id, pay_day, sum(amount) AS amt FROM pay GROUP BY ALL)")
    q["pct_paid"] = rounded("ppd", ["account_id", "statement_id", "statement_date", "is_last_statement", "rank_from_last"], ["paid_until_next", "pct_paid"])
    q["pct_paid_summary"] = rounded("psum", ["account_id"], PSUM)
    q["payments_after_statement"] = (f"SELECT b.account_id, b.statement_id, count(DISTINCT p.pay_day) AS payment_days, {r('coalesce(sum(p.amount), 0)', 'amount_after')} "
                                     "FROM bills b LEFT JOIN pay p ON p.account_id = b.account_id AND p.pay_day >= b.statement_date GROUP BY ALL")
    q["asof_next_payment"] = "SELECT account_id, statement_id, next_payment_date FROM outc"
    q["first_full_payment"] = "SELECT account_id, statement_id, full_payment_date FROM outc"
    q["bill_outcomes"] = rounded("outc", ["account_id", "statement_id", "statement_date", "period", "last_statement_date", "is_last_statement",
                                          "next_payment_date", "full_payment_date", "next_delay", "full_delay", "next_delay_capped", "full_delay_capped"],
                                 ["total_balance"])
    q["bills_outcome_summary"] = rounded("bsum", ["account_id", "count_bills"] + BSUM_INTS, [c for c in BSUM_NAMES if c not in BSUM_INTS])
    q["full_payers"] = "SELECT account_id, has_full_payment FROM fpay"
    q["month_total"] = f"SELECT account_id, month, n AS count_payments, {r('total', 'month_total')} FROM pmon"
    q["payments_monthly"] = rounded("pmonth", ["account_id", "count_monthly_payments"], PMONTH)
    q["payments_monthly_even"] = (f"SELECT account_id, count(*) AS count_monthly_payments, {r('avg(total)', 'mean_monthly_payment')}, {r('max(total)', 'max_monthly_payment')}, "
                                  f"{r('min(total)', 'min_monthly_payment')}, {r('arg_max(total, month)', 'last_monthly_payment')} FROM pmon GROUP BY account_id")
    q["payments_monthly_events"] = (f"SELECT account_id, CAST(sum(n) AS BIGINT) AS count_monthly_payments, {r('sum(n * total) / sum(n)', 'mean_monthly_payment')}, "
                                    f"{r('max(total)', 'max_monthly_payment')}, {r('min(total)', 'min_monthly_payment')}, {r('arg_max(total, month)', 'last_monthly_payment')} "
                                    "FROM (SELECT account_id, date_trunc('month', paid_at) AS month, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total FROM evt GROUP BY ALL) GROUP BY account_id")
    q["payments_summary"] = rounded("paysum", ["account_id", "count_payments", "last_payment_date", "n_not_reversed", "has_payment_data", "count_monthly_payments"], PAYSUM)

    # Transactions.
    q["transactions_in_quarters"] = f"SELECT account_id, \"at\", txn_date, {r('amount')}, city, category, country, decision, sic_group, txn_category, txn_type, q FROM tq"
    q["transactions_annual"] = rounded("txa", ["account_id"] + TXN_OTHERS, TXN_DOUBLES)
    q["transactions_quarter"] = rounded("txq", ["account_id"] + TXQ_OTHERS, TXQ_DOUBLES)
    q["distinct_counts"] = "SELECT account_id, " + ", ".join(f"n_distinct_{c}" for c in DISTINCT) + " FROM txa"
    for v, values in SHARE_VALUES.items():
        q[f"spend_share_{v}"] = f"SELECT account_id, {share_round(v, values)} FROM shr_{v}"
    q["category_share"] = (f"SELECT account_id, {share_round('txn_category', SHARE_VALUES['txn_category'], 'txn_category_pct_amount_')} FROM "
                           f"(SELECT account_id, {share_cols('txn_category', SHARE_VALUES['txn_category'], 'txn_category_pct_amount_')} FROM txn GROUP BY account_id)")
    q["spend_share_events"] = (f"SELECT account_id, {share_round('category', EVENT_TYPES)} FROM "
                               f"(SELECT account_id, {share_cols('category', EVENT_TYPES)} FROM evt GROUP BY account_id)")
    variables = [v for v in SHARE_VALUES if not v.endswith("_decile")] + ["city"]
    entries = " UNION ALL ".join(
        f"SELECT account_id, '{v}' AS variable, CAST({v} AS VARCHAR) AS value, CAST(sum(amount) AS DOUBLE) AS s FROM txn GROUP BY account_id, {v}" for v in variables)
    shares = f"(SELECT *, s / nullif(sum(s) OVER (PARTITION BY account_id, variable), 0) AS share FROM ({entries}))"
    q["share_entries"] = f"SELECT account_id, variable, value, {r('share')} FROM {shares}"
    q["level_dictionary"] = ("SELECT variable, value, row_number() OVER (ORDER BY variable, value NULLS FIRST) - 1 AS index "
                             f"FROM (SELECT DISTINCT variable, value FROM ({entries}))")
    q["sparse_vectors"] = (f"SELECT account_id, (SELECT count(*) FROM (SELECT DISTINCT variable, value FROM ({entries}))) AS size, count(*) AS n_levels, "
                           f"{r('sum(share)', 'sum_shares')} FROM {shares} WHERE share <> 0 GROUP BY account_id")
    q["share_of_total"] = (f"SELECT account_id, category, {r('s / sum(s) OVER (PARTITION BY account_id)', 'share')} FROM "
                           f"(SELECT account_id, category, {d('sum(amount)')} AS s FROM txn GROUP BY ALL)")
    q["diversity_index"] = (f"SELECT account_id, {r('index_city')}, {r('index_country')}, {r('index_category')} "
                            "FROM div_city JOIN div_country USING (account_id) JOIN div_category USING (account_id)")
    q["diversity_index_events"] = (f"SELECT account_id, {r('sum(pow(n, 2)) / pow(sum(n), 2)', 'index_category')} "
                                   f"FROM (SELECT account_id, category, {d('count(*)')} AS n FROM evt GROUP BY ALL) GROUP BY account_id")
    q["favorite_city"] = "SELECT account_id, favorite_city FROM favc"
    q["favorite_city_quarter"] = "SELECT account_id, q, favorite_city FROM favq"
    q["favorite_sic_group"] = "SELECT account_id, favorite_sic_group FROM favsic"
    q["favorite_category"] = "SELECT account_id, favorite_category FROM favcat_x"
    q["pool_rare"] = "SELECT account_id, favorite_city, favorite_city_code FROM favc_pool"
    q["city_moves"] = "SELECT account_id, " + ", ".join(f'"{c}"' for c in MOVES) + " FROM moves"
    q["gap_days"] = "SELECT account_id, txn_date, gap_days FROM gaps"
    q["days_between_summary"] = rounded("gapsum", ["account_id"], GAP)
    q["days_between_summary_events"] = rounded("egapsum", ["account_id"], GAP)
    for c in ("city", "category", "country"):
        q[f"frequency_ntile_{c}"] = f"SELECT {c}, {c}_decile FROM dec_{c}"
    q["bucket_lookup"] = f"SELECT account_id, \"at\", {r('amount')}, city, category, country, city_decile, category_decile, country_decile FROM txd"

    # Encoding.
    q["value_ntile"] = (f"SELECT account_id, {r('last_credit_ratio')}, CASE WHEN last_credit_ratio IS NOT NULL THEN CAST(ntile(10) OVER ("
                        "PARTITION BY last_credit_ratio IS NULL ORDER BY last_credit_ratio, account_id) AS INTEGER) END AS last_credit_ratio_ntile FROM suma")
    q["group_mean_target"] = (f"SELECT last_credit_ratio_ntile, {r('avg(default_flag)', 'in_sample_mean')} FROM ("
                              "SELECT account_id, CAST(ntile(10) OVER (ORDER BY last_credit_ratio, account_id) AS INTEGER) AS last_credit_ratio_ntile "
                              "FROM suma WHERE last_credit_ratio IS NOT NULL) JOIN acc USING (account_id) WHERE default_flag IS NOT NULL GROUP BY 1")
    q["inner_join_labels"] = f"SELECT account_id, default_flag, {r('last_credit_ratio')} FROM suma JOIN acc USING (account_id) WHERE default_flag IS NOT NULL"
    q["stratified_folds"] = "SELECT account_id, default_flag, fold FROM folds"
    q["stratified_split"] = "SELECT account_id, default_flag, CAST(place <= label_size * 0.9 AS INTEGER) AS in_train FROM place"
    q["oof_target_encode"] = f"SELECT account_id, favorite_city_code, {r('city_mean_default')} FROM citymean"
    q["one_hot"] = ("SELECT account_id, " + ", ".join(f"CAST(favorite_category IS NOT DISTINCT FROM '{v}' AS INTEGER) AS \"favorite_category_{v}\"" for v in TYPES[1:])
                    + ", " + ", ".join(f"CAST(favorite_sic_group IS NOT DISTINCT FROM '{v}' AS INTEGER) AS \"favorite_sic_group_{v}\"" for v in BRANDS[1:])
                    + " FROM favcat JOIN favsic USING (account_id)")
    scaled = ["mean_total_balance", "mean_cash_balance", "sum_credit_ratio"]
    q["zscore_wide_columns"] = ("SELECT account_id, " + ", ".join(
        r(f"CASE WHEN max({c}) OVER () - min({c}) OVER () > 1 THEN ({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER () ELSE {c} END", c)
        for c in scaled + ["mean_cash_ratio"]) + " FROM suma")

    # Audits and metrics.
    q["missing_audit"] = ("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM swide" for c in WIDE_NAMES) + ") WHERE n_missing > 0")
    q["nonfinite_audit"] = ("SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL OR isnan({c}) OR isinf({c})) AS n_nonfinite FROM psum" for c in PSUM)
        + ") WHERE n_nonfinite > 0")
    q["drop_higher_moments"] = rounded("psum", ["account_id"], [c for c in PSUM if not c.startswith(("kurtosis", "skewness"))])
    q["column_range"] = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {r(f'max({c}) - min({c})', 'value_range')} FROM psum" for c in PSUM)
    q["histogram"] = (f"SELECT CAST(CASE WHEN t < -0.5 THEN 0 WHEN t >= 0.5 THEN {BINS + 1} ELSE floor((t + 0.5) * {BINS}) + 1 END AS BIGINT) AS bin, "
                      "count(*) AS n_rows FROM (SELECT round(trend_pct_paid, 6) AS t FROM tpaid WHERE trend_pct_paid IS NOT NULL) GROUP BY 1")
    score = "SELECT default_flag AS y, last_credit_ratio AS s FROM suma JOIN acc USING (account_id) WHERE default_flag IS NOT NULL AND last_credit_ratio IS NOT NULL"
    q["auc_score"] = (f"SELECT sum(y) :: BIGINT AS n_pos, sum(1 - y) :: BIGINT AS n_neg, "
                      f"{r('(sum(rk) FILTER (WHERE y = 1) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * sum(1 - y))', 'auc')} FROM ("
                      f"SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk FROM ({score}))").replace(
        "sum(y) :: BIGINT", "CAST(sum(y) AS BIGINT)").replace("sum(1 - y) :: BIGINT", "CAST(sum(1 - y) AS BIGINT)")
    q["auc_score_tied"] = q["auc_score"].replace(
        "last_credit_ratio AS s", "last_delq_cycle AS s").replace("last_credit_ratio IS NOT NULL", "last_delq_cycle IS NOT NULL")
    q["class_metrics"] = (f"SELECT tp AS true_pos, fn AS false_neg, fp AS false_pos, tn AS true_neg, {r('tp / nullif(tp + fn, 0)', 'sensitivity')}, "
                          f"{r('tn / nullif(tn + fp, 0)', 'specificity')}, {r('(tp + tn) / nullif(tp + fn + fp + tn, 0)', 'accuracy')} FROM ("
                          "SELECT count(*) FILTER (WHERE y = 1 AND s >= 0.5) AS tp, count(*) FILTER (WHERE y = 1 AND s < 0.5) AS fn, "
                          f"count(*) FILTER (WHERE y = 0 AND s >= 0.5) AS fp, count(*) FILTER (WHERE y = 0 AND s < 0.5) AS tn FROM ({score}))")
    q["top_k"] = f"SELECT account_id, {r('sum_amount')} FROM txa ORDER BY sum_amount DESC, account_id LIMIT 20"
    q["sort"] = "SELECT account_id, statement_id, statement_date FROM enr ORDER BY account_id, statement_date, statement_id"

    q["drop_unusable_columns"] = rounded("paysum", ["account_id", "count_payments", "last_payment_date", "n_not_reversed",
                                                    "has_payment_data", "count_monthly_payments"],
                                         [c for c in PAYSUM if not c.startswith(("kurtosis", "skewness"))])

    # Design columns.
    filled = ["count_monthly_payments", *PMONTH]
    q["design_vector"] = ("SELECT account_id, default_flag, " + ", ".join(
        r(f"coalesce({c}, avg({c}) OVER ())", f"{c}_filled") + f", CAST({c} IS NULL AS DOUBLE) AS {c}_missing" for c in filled)
        + " FROM acc LEFT JOIN pmonth USING (account_id)")
    known = "(SELECT l.*, CASE WHEN default_flag IS NULL THEN 0 ELSE fold END AS part FROM (SELECT account_id, default_flag, " \
            f"CAST((place - 1) % {FOLDS} + 1 AS INTEGER) AS fold FROM place) l)"
    q["design_vector_by_fold"] = ("SELECT account_id, default_flag, fold, " + ", ".join(
        f"round(coalesce({c}, CASE WHEN part = 0 THEN (SELECT avg({c}) FROM acc JOIN pmonth USING (account_id) WHERE default_flag IS NOT NULL) ELSE coalesce({c}_other, 0) END) + {NUDGE}, 6) + 0.0 AS {c}_filled"
        for c in filled) + " FROM (SELECT k.account_id, k.default_flag, k.fold, k.part, " + ", ".join(
        f"p.{c}, CASE WHEN k.part > 0 THEN (sum(p.{c}) FILTER (k.part > 0) OVER () - coalesce(sum(p.{c}) OVER (PARTITION BY k.part), 0)) "
        f"/ nullif(count(p.{c}) FILTER (k.part > 0) OVER () - count(p.{c}) OVER (PARTITION BY k.part), 0) END AS {c}_other" for c in filled)
        + f" FROM {known} k LEFT JOIN pmonth p USING (account_id))")
    labelled = f"(SELECT account_id, default_flag, CAST((place - 1) % {FOLDS} + 1 AS INTEGER) AS fold FROM place WHERE default_flag IS NOT NULL)"
    q["oof_predict_audit"] = f"SELECT account_id, default_flag, fold, true AS in_range FROM {labelled}"
    q["round_areas"] = (f"SELECT fold, CAST(k AS INTEGER) AS round, count(*) FILTER (default_flag = 1) AS n_pos, "
                        f"count(*) FILTER (default_flag = 0) AS n_neg, true AS is_area FROM {labelled}, range(1, {ROUNDS + 1}) AS x(k) GROUP BY 1, 2")
    q["final_scores_audit"] = ("SELECT account_id, CAST(10 AS BIGINT) AS n_members, true AS in_range, true AS is_mean "
                               "FROM acc WHERE default_flag IS NULL")
    index = ("(SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS {c}_index FROM {t} GROUP BY {c})")
    q["index_categories"] = (
        "SELECT account_id, coalesce(favorite_category_index, (SELECT CAST(count(DISTINCT favorite_category) AS DOUBLE) FROM favcat)) AS favorite_category_index, "
        "coalesce(favorite_sic_group_index, (SELECT CAST(count(DISTINCT favorite_sic_group) AS DOUBLE) FROM favsic)) AS favorite_sic_group_index "
        f"FROM acc LEFT JOIN favcat USING (account_id) LEFT JOIN {index.format(c='favorite_category', t='favcat')} USING (favorite_category) "
        f"LEFT JOIN favsic USING (account_id) LEFT JOIN {index.format(c='favorite_sic_group', t='favsic')} USING (favorite_sic_group)")

    # The feature table.
    q["account_ratios"] = rounded("feat", ["account_id"], list(RATIOS))
    q["recency_features"] = rounded("feat", ["account_id"] + list(RECENCY_INTS), list(RECENCY))
    q["history_flags"] = rounded("feat", ["account_id"] + FLAGS, [])
    q["assemble_features"] = rounded("feat", FEATURE_OTHERS, ASSEMBLED_DOUBLES)
    q["feature_table"] = "SELECT * FROM fin"
    return {name: build(sql) for name, sql in q.items()}
