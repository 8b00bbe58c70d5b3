"""Registered queries: every operator run over the given tables, with its DuckDB counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracles
from ledgerfeat.functions import columns as cols
from ledgerfeat.functions.scalar import not_in
from ledgerfeat.functions.stats import sample_kurtosis, sample_skewness
from ledgerfeat.operators import audit, encode, payments, sparse, statements, summaries, transactions, trends
from ledgerfeat.plans import features, final, scoring, search
from ledgerfeat.session import account_stage, ensure_checkpoint_dir, file_stage, pin
from ledgerfeat.sources import orders
from ledgerfeat.sources.readers import stack_tables

try:  # the corpus operators can be left out of an installation
    import corpus_pipeline
    from ledgerfeat.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "ledgerfeat.llm"):
        raise
    corpus_pipeline = corpus_queries = None

_ledgers: dict[tuple, orders.Ledger] = {}


def folder_state(spark: SparkSession, folder: str) -> tuple:
    """Session, folder, and the names, sizes and times of the folder's files: results for older files are not used again."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, folders = [], [path]
    while folders:
        for s in system.listStatus(folders.pop()):
            if s.isDirectory():
                folders.append(s.getPath())
            else:
                found.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return spark.sparkContext.applicationId, folder, tuple(sorted(found))


def ledger(spark: SparkSession, folder: str) -> orders.Ledger:
    """The four views, with the accounts to split found once per session and state of the folder."""
    key = folder_state(spark, folder)
    if key not in _ledgers:
        _ledgers[key] = orders.load_orders(spark, folder).with_hot_accounts()
    return _ledgers[key]


def plan(spark: SparkSession, folder: str, **options) -> features.FeaturePlan:
    return features.FeaturePlan(ledger(spark, folder), **options)


def rounded(df: DataFrame) -> DataFrame:
    """Numbers as doubles with six decimals, for comparison between engines."""
    return df.selectExpr(*[
        f"round(CAST(`{f.name}` AS DOUBLE) + {oracles.NUDGE}D, 6) + 0.0D AS `{f.name}`"
        if isinstance(f.dataType, (T.DoubleType, T.DecimalType)) else f"`{f.name}`"
        for f in df.schema.fields
    ])


Query = Callable[[SparkSession, str], DataFrame]


def on_ledger(build: Callable[[orders.Ledger], DataFrame]) -> Query:
    return lambda spark, folder: rounded(build(ledger(spark, folder)))


def on_plan(build: Callable[[features.FeaturePlan], DataFrame], **options) -> Query:
    return lambda spark, folder: rounded(build(plan(spark, folder, **options)))


def on_staged_plan(build: Callable[[features.FeaturePlan], DataFrame]) -> Query:
    return lambda spark, folder: rounded(build(features.FeaturePlan.staged(ledger(spark, folder))))


def on_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(build(orders.event_spend_view(spark, folder)))


# Reading, projection and cleaning ------------------------------------------------------------

def union_by_name(l: orders.Ledger) -> DataFrame:
    labelled, unlabelled = encode.split_by_label_presence(l.accounts)
    return stack_tables(labelled, unlabelled.drop("default_flag"))


def recode_label(l: orders.Ledger) -> DataFrame:
    return scoring.recode_label(l.accounts.select("account_id", "default_flag"))


def unpivot_long(p: features.FeaturePlan) -> DataFrame:
    ratios = ["credit_ratio", "cash_ratio", "cash_on_credit_ratio"]
    return p.enriched.select("account_id", "statement_id", *ratios).unpivot(
        ["account_id", "statement_id"], ratios, "measure", "value")


def clean_queries() -> dict[str, Query]:
    return {
        "union_by_name": on_ledger(union_by_name),
        "select_rename_drop": on_ledger(lambda l: l.statements.select("account_id", "statement_id", "total_balance", "period")
                                        .withColumnRenamed("total_balance", "owed").drop("period")),
        "select_by_pattern": on_ledger(lambda l: cols.select_by_pattern(
            l.statements, keep=["account_id", "statement_id"], contains=["BALANCE"])),
        "select_by_type": on_ledger(lambda l: cols.select_by_type(l.statements, T.DateType, keep=["account_id"])),
        "dates_to_numeric": on_ledger(lambda l: cols.dates_to_numeric(
            l.statements.select("account_id", "statement_id", "statement_date", "period"))),
        "exclude_categories": on_ledger(lambda l: l.transactions.filter(not_in("category", ["ECONOMY", "SMALL"])).select(
            "account_id", F.to_date("at").alias("txn_date"), "category", "amount")),
        "drop_null_payments": on_ledger(lambda l: l.payments),
        "distinct_statement_days": on_ledger(lambda l: l.statements.select("account_id", "statement_date").distinct()),
        "fill_null": on_ledger(lambda l: cols.fill_null(l.accounts.select("account_id", "default_flag"), ["default_flag"])),
        "recode_label": on_ledger(recode_label),
        "correct_balance": on_ledger(lambda l: statements.correct_balance(l.statements).select(
            "account_id", "statement_id", "total_balance", "raw_total_balance")),
        "ratio_features": on_ledger(lambda l: statements.correct_balance(l.statements).select(
            "account_id", "statement_id", *[e.alias(n) for n, e in statements.ratio_features(
                "total_balance", "cash_balance", "credit_limit").items()])),
        "positive_bills": on_ledger(lambda l: payments.positive_bills(statements.correct_balance(l.statements)).select(
            "account_id", "statement_id", "statement_date", "total_balance")),
        "split_by_label_presence": on_ledger(lambda l: encode.split_by_label_presence(
            l.accounts.select("account_id", "default_flag"))[0]),
    }


# Statements ----------------------------------------------------------------------------------

def moments(l: orders.Ledger) -> DataFrame:
    return l.transactions.groupBy("account_id").agg(
        sample_skewness("amount").alias("skewness_amount"), sample_kurtosis("amount").alias("kurtosis_amount"))


def annual_columns(*prefixes: str) -> Query:
    return on_plan(lambda p: cols.select_by_pattern(
        summaries.summary_annual(p.enriched, p.ledger.hot_statements), keep=["account_id"], starts_with=prefixes))


def series_facts(p: features.FeaturePlan) -> DataFrame:
    """What the blocks of the statement series hold."""
    series = statements.statement_series(p.enriched)
    total = F.aggregate("credit_ratio", F.lit(None).cast("double"), lambda a, x: F.coalesce(a + x, a, x))
    return series.select(
        "account_id", "block", F.col("ranks")[0].alias("first_rank"), F.size("ranks").cast("long").alias("n_ranks"),
        total.alias("sum_credit_ratio"), F.col("total_balance")[0].alias("first_total_balance"),
        F.element_at("total_balance", -1).alias("last_total_balance"))


def quarter_ratio_low(p: features.FeaturePlan) -> DataFrame:
    wide = summaries.summary_quarter(p.enriched, p.ledger.hot_statements)
    return wide.select("account_id", summaries.quarter_ratio(min_denominator=0.2).alias("credit_ratio_q4_on_q1"))


def statement_queries() -> dict[str, Query]:
    def enriched(*names: str) -> Query:
        return on_plan(lambda p: p.enriched.select("account_id", "statement_id", *names))
    return {
        "rank_from_last": enriched("rank_from_last"),
        "period_bucket": enriched("q", "h"),
        "next_and_last_date": enriched("next_statement_date", "last_statement_date", "is_last_statement"),
        "statement_enriched": on_plan(lambda p: p.enriched),
        "quarter_limits": on_plan(lambda p: statements.quarter_limits(p.enriched)),
        "balance_delta": enriched("balance_delta"),
        "statement_wide": on_plan(lambda p: p.wide_statements),
        "statement_series": on_plan(series_facts),
        "unpivot_long": on_plan(unpivot_long),
        "summary_quarter": on_plan(lambda p: summaries.summary_quarter(p.enriched, p.ledger.hot_statements)),
        "summary_semester": on_plan(lambda p: summaries.summary_semester(p.enriched, p.ledger.hot_statements)),
        "summary_annual": on_plan(lambda p: summaries.summary_annual(p.enriched, p.ledger.hot_statements)),
        "moments": on_ledger(moments),
        "last_first_value": on_plan(lambda p: p.enriched.groupBy("account_id").agg(*summaries.last_first_values())),
        "new_extreme_flags": annual_columns("at_new_"),
        "annual_delta": annual_columns("annual_delta_", "last_on_max_", "last_credit_ratio_x"),
        "quarter_ratio": on_plan(lambda p: summaries.summary_quarter(p.enriched, p.ledger.hot_statements).select(
            "account_id", summaries.quarter_ratio().alias("credit_ratio_Q4_on_Q1"))),
        "quarter_ratio_low": on_plan(quarter_ratio_low),
        **{f"trend_{m}": on_plan(lambda p, m=m: trends.trend_ratios(p.enriched).select("account_id", f"trend_{m}"))
           for m in ("credit_ratio", "cash_ratio", "cash_on_credit_ratio")},
        "trend_pct_paid": on_plan(lambda p: trends.trend_pct_paid(p.paid)),
        **{f"trend_{m}": on_plan(lambda p, m=m: trends.trend_delays(p.outcomes).select("account_id", f"trend_{m}"))
           for m in ("full_delay", "next_delay")},
    }


# Payments ------------------------------------------------------------------------------------

def payment_queries() -> dict[str, Query]:
    return {
        "running_paid": on_ledger(lambda l: payments.running_paid(l.payments)),
        "pct_paid": on_plan(lambda p: p.paid),
        "pct_paid_summary": on_plan(lambda p: p.paid_summary),
        "payments_after_statement": on_plan(lambda p: payments.payments_after(
            payments.positive_bills(p.enriched), p.ledger.payments, p.ledger.hot_statements)),
        "asof_next_payment": on_plan(lambda p: p.outcomes.select("account_id", "statement_id", "next_payment_date")),
        "first_full_payment": on_plan(lambda p: p.outcomes.select("account_id", "statement_id", "full_payment_date")),
        "bill_outcomes": on_plan(lambda p: p.outcomes),
        "bills_outcome_summary": on_plan(lambda p: payments.bills_outcome_summary(p.outcomes)),
        "full_payers": on_plan(lambda p: payments.full_payers(p.outcomes)),
        "month_total": on_ledger(lambda l: payments.month_totals(l.payments)),
        "payments_monthly": on_ledger(lambda l: payments.payments_monthly(l.payments)),
        "payments_monthly_even": on_ledger(lambda l: payments.payments_monthly(l.payments, per_payment=False)),
        "payments_monthly_events": on_events(lambda e: payments.payments_monthly(e.withColumnRenamed("at", "paid_at"))),
        "payments_summary": on_ledger(lambda l: payments.payments_summary(l.payments)),
    }


# Transactions --------------------------------------------------------------------------------

def all_shares(rows: DataFrame, variable: str, prefix: str | None = None) -> DataFrame:
    """Spending shares with a column for every value in the rows."""
    profile = transactions.category_profile(rows, [variable])
    return transactions.spend_share(profile, variable, transactions.distinct_values(profile, "value"), prefix)


def spend_share(variable: str) -> Query:
    def build(l: orders.Ledger) -> DataFrame:
        rows = l.transactions
        if variable.endswith("_decile"):
            rows = transactions.bucket_lookup(rows, [variable.removesuffix("_decile")])
        return all_shares(rows, variable)
    return on_ledger(build)


def category_share(l: orders.Ledger) -> DataFrame:
    profile = transactions.category_profile(l.transactions, ["txn_category"])
    return transactions.category_share(profile, transactions.distinct_values(profile, "value"))


#: Variables whose levels are numbered, however many there are.
LEVEL_COLUMNS = [v for v in transactions.SHARE_COLUMNS if not v.endswith("_decile")]


def levels_of(l: orders.Ledger) -> DataFrame:
    return transactions.category_profile(l.transactions, [*LEVEL_COLUMNS, "city"], hot=l.hot_transactions, parts=l.tasks())


def sparse_totals(l: orders.Ledger) -> DataFrame:
    """Size, entries and sum of the sparse vector of every account, one part of spending per variable."""
    profile = file_stage(levels_of(l))
    dictionary = file_stage(sparse.level_dictionary(profile))
    vectors = sparse.sparse_vectors(sparse.numbered(sparse.share_entries(profile), dictionary), dictionary.count())
    return sparse.vector_totals(vectors)


def favorite(variable: str, name: str, **options) -> Query:
    return on_ledger(lambda l: transactions.favorite_value(
        transactions.category_profile(l.transactions, [variable]), variable, name, **options))


def transaction_queries() -> dict[str, Query]:
    return {
        "transactions_in_quarters": on_plan(lambda p: p.placed),
        "transactions_annual": on_ledger(lambda l: transactions.transactions_annual(l.transactions, l.hot_transactions)),
        "transactions_quarter": on_plan(lambda p: transactions.transactions_quarter(p.placed, p.ledger.hot_transactions)),
        "distinct_counts": on_ledger(lambda l: transactions.distinct_counts(
            transactions.category_profile(l.transactions, transactions.DISTINCT_COLUMNS))),
        **{f"spend_share_{v}": spend_share(v) for v in transactions.SHARE_COLUMNS},
        "category_share": on_ledger(category_share),
        "spend_share_events": on_events(lambda e: all_shares(e, "category")),
        "share_entries": on_ledger(lambda l: sparse.share_entries(levels_of(l))),
        "level_dictionary": on_ledger(lambda l: sparse.level_dictionary(levels_of(l))),
        "sparse_vectors": on_ledger(sparse_totals),
        "share_of_total": on_ledger(lambda l: transactions.share_of_total(
            transactions.category_profile(l.transactions, ["category"]), "category")),
        "diversity_index": on_ledger(lambda l: transactions.diversity_index(
            transactions.category_profile(l.transactions, transactions.DIVERSITY_COLUMNS))),
        "diversity_index_events": on_events(lambda e: transactions.diversity_index(
            transactions.category_profile(e, ["category"]), ["category"])),
        "favorite_city": on_plan(lambda p: p.favorite_city.select("account_id", "favorite_city")),
        "favorite_city_quarter": on_plan(lambda p: transactions.favorite_value(
            transactions.category_profile(p.placed, ["city"], ("account_id", "q")), "city", "favorite_city",
            by=("account_id", "q"), numeric=True)),
        "favorite_sic_group": favorite("sic_group", "favorite_sic_group"),
        "favorite_category": favorite("category", "favorite_category", exclude=["ECONOMY", "SMALL"]),
        "pool_rare": on_plan(lambda p: p.favorite_city),
        "city_moves": on_plan(lambda p: p.moves),
        "gap_days": on_ledger(lambda l: transactions.gap_days(l.transactions)),
        "days_between_summary": on_ledger(lambda l: transactions.days_between_summary(l.transactions)),
        "days_between_summary_events": on_events(transactions.days_between_summary),
        **{f"frequency_ntile_{c}": on_ledger(lambda l, c=c: transactions.frequency_ntile(l.transactions, c))
           for c in transactions.DECILE_COLUMNS},
        "bucket_lookup": on_ledger(lambda l: transactions.bucket_lookup(l.transactions).select(
            "account_id", "at", "amount", "city", "category", "country", "city_decile", "category_decile", "country_decile")),
    }


# Encoding, audits and metrics ----------------------------------------------------------------

def last_ratio(p: features.FeaturePlan) -> DataFrame:
    return p.enriched.groupBy("account_id").agg(*summaries.last_first_values(["credit_ratio"])).select(
        "account_id", "last_credit_ratio")


def labelled_ratio(p: features.FeaturePlan, measure: str = "credit_ratio") -> DataFrame:
    values = p.enriched.groupBy("account_id").agg(*summaries.last_first_values([measure]))
    train, _ = encode.split_by_label_presence(p.ledger.accounts.select("account_id", "default_flag"))
    return train.join(values.select("account_id", f"last_{measure}"), "account_id")


def favorites(p: features.FeaturePlan) -> DataFrame:
    profile = transactions.category_profile(p.ledger.transactions, ["category", "sic_group"])
    return transactions.favorite_value(
        profile, "category", "favorite_category", exclude=transactions.EXCLUDED_CATEGORIES
    ).join(transactions.favorite_value(profile, "sic_group", "favorite_sic_group"), "account_id")


def zscored(p: features.FeaturePlan) -> DataFrame:
    names = ["mean_total_balance", "mean_cash_balance", "sum_credit_ratio", "mean_cash_ratio"]
    facts = p.enriched.groupBy("account_id").agg(*[
        F.expr(f"CAST({f}({m}) AS DOUBLE) AS {n}") for n, f, m in [
            (names[0], "avg", "CAST(total_balance AS DOUBLE)"), (names[1], "avg", "CAST(cash_balance AS DOUBLE)"),
            (names[2], "sum", "credit_ratio"), (names[3], "avg", "cash_ratio")]])
    return encode.zscore_wide_columns(pin(facts), names)


def assembled(p: features.FeaturePlan) -> DataFrame:
    return features.assemble_features(p)


def with_families(*names: str) -> Callable[[features.FeaturePlan], DataFrame]:
    """Accounts joined to some families only."""
    def build(p: features.FeaturePlan) -> DataFrame:
        found = p.families()
        return features.join_families(p.ledger.accounts, [found[n]() for n in names])
    return build


def encoding_queries() -> dict[str, Query]:
    labels = ("account_id", "default_flag")
    return {
        "value_ntile": on_plan(lambda p: encode.value_ntile(last_ratio(p), "last_credit_ratio")),
        "group_mean_target": on_plan(lambda p: encode.group_mean_target(
            encode.value_ntile(last_ratio(p), "last_credit_ratio").join(p.ledger.accounts.select(*labels), "account_id"),
            "last_credit_ratio_ntile", "default_flag")),
        "inner_join_labels": on_plan(labelled_ratio),
        "stratified_folds": on_ledger(lambda l: encode.stratified_folds(l.accounts.select(*labels), "default_flag", 50)),
        "stratified_split": on_ledger(lambda l: encode.stratified_split(l.accounts.select(*labels), "default_flag", 0.9)),
        "oof_target_encode": on_plan(lambda p: p.encoded_city),
        "one_hot": on_plan(lambda p: encode.one_hot(
            favorites(p), ["favorite_category", "favorite_sic_group"])),
        "zscore_wide_columns": on_plan(zscored),
        "missing_audit": on_plan(lambda p: audit.missing_audit(p.wide_statements)),
        "nonfinite_audit": on_plan(lambda p: audit.nonfinite_audit(p.paid_summary.drop("account_id"))),
        "drop_higher_moments": on_plan(lambda p: cols.drop_higher_moments(p.paid_summary)),
        "drop_unusable_columns": on_plan(lambda p: audit.drop_unusable_columns(
            payments.payments_summary(p.ledger.payments), keep=["account_id"])),
        "column_range": on_plan(lambda p: audit.column_range(p.paid_summary.drop("account_id"))),
        "histogram": on_plan(lambda p: audit.histogram(
            # Rounded first: slopes of zero carry a sign in their last bits, and zero is an edge.
            trends.trend_pct_paid(p.paid).withColumn("trend_pct_paid", F.round("trend_pct_paid", 6)),
            "trend_pct_paid", -0.5, 0.5, 20)),
        "auc_score": on_plan(lambda p: audit.auc_score(labelled_ratio(p), "default_flag", "last_credit_ratio")),
        "auc_score_tied": on_plan(lambda p: audit.auc_score(
            labelled_ratio(p, "delq_cycle"), "default_flag", "last_delq_cycle")),
        "class_metrics": on_plan(lambda p: audit.class_metrics(
            labelled_ratio(p), "default_flag", "last_credit_ratio", 0.5)),
        "top_k": on_ledger(lambda l: l.transactions.groupBy("account_id").agg(
            F.sum("amount").cast("double").alias("sum_amount")).orderBy(F.desc("sum_amount"), "account_id").limit(20)),
        "sort": on_ledger(lambda l: l.statements.select("account_id", "statement_id", "statement_date").orderBy(
            "account_id", "statement_date", "statement_id")),
        "account_ratios": on_plan(lambda p: with_families("payments", "transactions", "statements")(p).select(
            "account_id", *[e.alias(n) for n, e in features.account_ratios().items()])),
        "recency_features": on_plan(lambda p: with_families("payments", "transactions", "statements")(p).select(
            "account_id", *[e.alias(n) for n, e in features.recency_features().items()])),
        "history_flags": on_plan(lambda p: with_families("payments", "transactions", "statements", "bills", "full_payers")(p)
                                 .withColumns(features.history_flags()).select("account_id", *features.history_flags())),
        "assemble_features": on_staged_plan(assembled),
        "feature_table": on_staged_plan(lambda p: features.finish_features(assembled(p))),
    }


# Models --------------------------------------------------------------------------------------

# Folds, sets, rounds and patience of the registered runs; the library's defaults are those of a full run.
RUN_FOLDS = oracles.FOLDS
RUN_SETS = 6
RUN_ROUNDS = oracles.ROUNDS
RUN_PATIENCE = 6
RUN_PARAMS = scoring.BoostParams(eta=0.1, max_depth=3, min_child_weight=3, subsample=0.5, columns=0.5, rounds=RUN_ROUNDS)

# The reference's own runs: folds and most rounds of the search for the best round, folds of its cross-validation.
BEST_FOLDS, BEST_ROUNDS = 9, scoring.FINAL_PARAMS.rounds
CV_FOLDS = 5

_designs: dict[tuple, tuple[DataFrame, DataFrame, dict[str, bool]]] = {}


def design(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, dict[str, bool]]:
    """Account features, their vectors with folds and split, and the columns used; built once per state of the folder."""
    key = folder_state(spark, folder)
    if key not in _designs:
        p = features.FeaturePlan.staged(ledger(spark, folder))
        keep = account_stage(spark, p.tasks)
        # Only keys and labels go through the order of the folds.
        labels = p.ledger.accounts.select("account_id", "default_flag")
        folds = encode.stratified_split(encode.stratified_folds(labels, "default_flag", RUN_FOLDS), "default_flag", 0.9)
        table = keep(features.finish_features(assembled(p)).join(p.stage_family(folds.drop("default_flag")), "account_id"))
        p.drop_families()
        used = scoring.known_columns(table, [c for c in scoring.feature_names(table) if c not in ("fold", "in_train")])
        _designs[key] = (table, keep(scoring.design_vector(table, used)), used)
    return _designs[key]


def on_design(build: Callable[[DataFrame, DataFrame, dict[str, bool]], DataFrame]) -> Query:
    """A model query: features, vectors and column list of the folder."""
    return lambda spark, folder: build(*design(spark, folder))


def both_parts(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    return encode.split_by_label_presence(vectors)


def refolded(table: DataFrame, used: dict[str, bool], folds: int) -> DataFrame:
    """Vectors of the labelled accounts with other folds than the design's, gaps filled by these folds."""
    labelled = both_parts(table)[0]
    labels = labelled.groupBy("account_id").agg(F.min("default_flag").alias("default_flag"))  # rows of an account share its fold
    placed = pin(encode.stratified_folds(labels, "default_flag", folds).drop("default_flag"))
    return file_stage(scoring.design_vector(labelled.drop("fold").join(placed, "account_id"), used))


def gbt_scores(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    train, test = both_parts(vectors)
    return scoring.score(scoring.train_gbt(RUN_PARAMS).fit(scoring.for_fits(train)), test)


def gbt_categorical_scores(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    # Gaps are filled by means of the labelled accounts: a column without a value there has none, nor anything to split on.
    known = scoring.known_columns(both_parts(table)[0], list(used))
    used = {c: gaps for c, gaps in used.items() if c in known}
    train, test = both_parts(scoring.with_missing_flags(table, used))
    names = [f.name for f in table.schema.fields if isinstance(f.dataType, T.StringType)]
    levels = table.agg(*[F.count_distinct(n).alias(n) for n in names]).first()
    trees = scoring.train_gbt_categorical(used, names, max(levels) + 1, RUN_PARAMS)
    return scoring.score(trees.fit(scoring.for_fits(train)), test)


def logistic_scores(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    train, test = both_parts(vectors)
    return scoring.score(scoring.train_logistic_l1().fit(train), test)


def mlp_scores(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    """Net on the standardised top features and the principal components, out of fold."""
    names = scoring.source_columns(scoring.top_features(importance(table, vectors, used)))
    inputs = scoring.net_inputs(table, vectors, names)
    train, _ = both_parts(pin(inputs))
    net = scoring.train_mlp(len(names) + scoring.COMPONENTS, vector="net_inputs")
    return scoring.oof_predict(net, train, RUN_FOLDS)[0]


def oof_scores(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    return scoring.oof_predict(scoring.train_gbt(RUN_PARAMS), both_parts(vectors)[0], RUN_FOLDS)[0]


def oof_audit(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    """Accounts and folds that the out-of-fold scores cover, and whether all are shares."""
    return oof_scores(table, vectors, used).select(
        "account_id", "default_flag", "fold", F.col("default_score").between(0.0, 1.0).alias("in_range"))


def oof_auc(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    return audit.auc_score(oof_scores(table, vectors, used), "default_flag", "default_score")


def best_rounds(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    train = refolded(table, used, BEST_FOLDS)
    rounds = scoring.best_iteration(replace(RUN_PARAMS, rounds=BEST_ROUNDS), train, BEST_FOLDS, scoring.PATIENCE)
    return train.groupBy().agg(F.count("*").alias("train_rows")).withColumn("best_iteration", F.lit(rounds))


def searched(sets: list[scoring.BoostParams]) -> Query:
    return on_design(lambda table, vectors, used: search.search(
        both_parts(vectors)[0], sets, RUN_FOLDS, patience=RUN_PATIENCE, parallelism=8)[0])


def response(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    results, _ = search.search(both_parts(vectors)[0], search.random_params(RUN_SETS, RUN_ROUNDS), RUN_FOLDS, find_rounds=False, parallelism=8)
    return search.search_response(results, "eta", *search.ETA_RANGE)


def importance(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    model = scoring.train_gbt(RUN_PARAMS).fit(scoring.for_fits(both_parts(vectors)[0]))
    return scoring.feature_importance(model, scoring.design_names(used))


def top_feature_table(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    """Standardised values of the features with the highest importance."""
    names = scoring.source_columns(scoring.top_features(importance(table, vectors, used)))
    return encode.zscore_wide_columns(table.select("account_id", *names), names)


def l1_coefficients(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    model = scoring.train_logistic_l1().fit(both_parts(vectors)[0])
    return scoring.coefficients(model, scoring.design_names(used))


def curve(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    train = both_parts(vectors)[0]
    fitted, held_out = train.filter("in_train = 1"), train.filter("in_train = 0")
    model = scoring.train_gbt(RUN_PARAMS).fit(scoring.for_fits(fitted))
    return scoring.learning_curve(model, {"train": fitted, "hold_out": held_out})


def area_by_round(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    """Area under the curve after every round on the training rows and the hold-out rows."""
    train = both_parts(vectors)[0]
    fitted, held_out = train.filter("in_train = 1"), train.filter("in_train = 0")
    return scoring.area_curve(scoring.train_gbt(RUN_PARAMS).fit(scoring.for_fits(fitted)), {"train": fitted, "hold_out": held_out})


def fold_sizes(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    """Defaults and others behind the areas of every fold and round."""
    return scoring.round_curve(both_parts(vectors)[0], RUN_PARAMS, RUN_FOLDS).select(
        F.col("fold").cast("int").alias("fold"), F.col("round").cast("int").alias("round"), "n_pos", "n_neg",
        F.col("auc").between(0.0, 1.0).alias("is_area"))


_runs: dict[tuple, final.Run] = {}


def final_run(spark: SparkSession, folder: str) -> final.Run:
    """The whole scoring job on the folder, once per state of it: search, best set, ten copies, published mean."""
    key = folder_state(spark, folder)
    if key not in _runs:
        root = f"{ensure_checkpoint_dir(spark)}/final"
        _runs[key] = final.final_scores(design(spark, folder)[1], root, search.random_params(RUN_SETS, RUN_ROUNDS), RUN_FOLDS,
                                        patience=RUN_PATIENCE, parallelism=8)
    return _runs[key]


def cv_metric(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    train = refolded(table, used, CV_FOLDS)
    areas = scoring.cross_validate(scoring.train_gbt(scoring.CATEGORICAL_PARAMS), train, CV_FOLDS)
    return train.groupBy().agg(F.count("*").alias("train_rows")).withColumn("mean_auc", F.lit(float(areas[0])))


def ensemble(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    train, test = both_parts(vectors)
    return scoring.ensemble_mean(train, test, RUN_PARAMS, copies=10)


def stacked(table: DataFrame, vectors: DataFrame, used: dict[str, bool]) -> DataFrame:
    train = both_parts(vectors)[0]
    trees, _ = scoring.oof_predict(scoring.train_gbt(RUN_PARAMS), train, RUN_FOLDS)
    linear, _ = scoring.oof_predict(scoring.train_logistic_l1(), train, RUN_FOLDS)
    return scoring.stack_features(table.filter("default_flag IS NOT NULL").select("account_id", "default_flag"),
                                  {"score_gbt": trees, "score_logistic": linear})


def indexed(p: features.FeaturePlan) -> DataFrame:
    names = ["favorite_category", "favorite_sic_group"]
    table = pin(p.ledger.accounts.select("account_id").join(favorites(p), "account_id", "left"))
    return scoring.index_categories(names).fit(table).transform(table).select("account_id", *[f"{n}_index" for n in names])


def vector_values(p: features.FeaturePlan) -> DataFrame:
    """Imputed payment statistics with their missing flags, read back from the assembled vector."""
    facts = pin(p.ledger.accounts.select("account_id", "default_flag").join(
        payments.payments_monthly(p.ledger.payments), "account_id", "left"))
    used = scoring.known_columns(facts, scoring.feature_names(facts))
    values = scoring.vector_to_array("features")
    return scoring.design_vector(facts, used).select(
        "account_id", "default_flag", *[values[i].alias(n) for i, n in enumerate(scoring.design_names(used))])


def filled_by_fold(p: features.FeaturePlan) -> DataFrame:
    """Payment statistics with gaps filled by the means of the other folds."""
    facts = p.ledger.accounts.select("account_id", "default_flag").join(payments.payments_monthly(p.ledger.payments), "account_id", "left")
    facts = pin(encode.stratified_folds(facts, "default_flag", RUN_FOLDS))
    names = [c for c in scoring.feature_names(facts) if c != "fold"]
    return scoring.fill_by_fold(facts, names).select("account_id", "default_flag", "fold", *[f"{c}_filled" for c in names])


def model_queries() -> dict[str, Query]:
    return {
        "design_vector": on_plan(vector_values),
        "design_vector_by_fold": on_plan(filled_by_fold),
        "index_categories": on_plan(indexed),
        "pca_features": on_design(lambda table, vectors, used: scoring.pca_features(vectors)),
        "train_gbt": on_design(gbt_scores),
        "train_gbt_categorical": on_design(gbt_categorical_scores),
        "train_logistic_l1": on_design(logistic_scores),
        "train_mlp": on_design(mlp_scores),
        "oof_predict": on_design(oof_scores),
        "oof_predict_audit": on_design(oof_audit),
        "oof_auc": on_design(oof_auc),
        "best_iteration": on_design(best_rounds),
        "random_search": searched(search.random_params(RUN_SETS, RUN_ROUNDS)),
        "grid_search": searched(search.grid_params(RUN_ROUNDS)),
        "search_response": on_design(response),
        "cross_validate": on_design(cv_metric),
        "feature_importance": on_design(importance),
        "top_features": on_design(top_feature_table),
        "coefficients": on_design(l1_coefficients),
        "learning_curve": on_design(curve),
        "learning_curve_auc": on_design(area_by_round),
        "round_areas": on_design(fold_sizes),
        "final_scores": lambda spark, folder: final.published(final_run(spark, folder)),
        "final_scores_audit": lambda spark, folder: final.audit_run(final_run(spark, folder)),
        "ensemble_mean": on_design(ensemble),
        "stack_features": on_design(stacked),
    }


def queries() -> dict[str, Query]:
    return {**clean_queries(), **statement_queries(), **payment_queries(), **transaction_queries(),
            **encoding_queries(), **model_queries(), **corpus()}


def corpus() -> dict[str, Query]:
    if corpus_queries is None:
        return {}
    return {**corpus_queries.queries(), "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = oracles.oracle_sql()
    if corpus_queries is not None:
        found |= corpus_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL is not None:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Share of every statement paid before the next one."""
    return queries()["pct_paid"](spark, "/root/testdata/sf0.001")
