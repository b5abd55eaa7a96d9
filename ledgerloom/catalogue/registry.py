"""The registered queries over the sample tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date, timedelta
from functools import reduce
from typing import Any

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.catalogue.proxy import PARTS, best_threshold, proxy_scores, with_proxy_score
from ledgerloom.catalogue.views import CUTOFF, PANEL_CUTOFFS, WEEKLY_CUTOFFS, SampleWarehouse
from ledgerloom.operators import (
    attribution,
    daily,
    ensembles,
    metrics,
    models,
    payments,
    quality,
    reasons,
    snapshots,
    splits,
    threshold,
    tiers,
    tweedie,
    value,
)
from ledgerloom.plans import feature_store as features
from ledgerloom.plans import jobs, reporting, retention, revenue
from ledgerloom.schemas import BASE_TABLES, NUMERIC_FEATURES, RISK_SCORES, TABLES, Table
from ledgerloom.session import materialise, scratch_path, tuned
from ledgerloom.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Callable[[SampleWarehouse], DataFrame]) -> Callable[[SampleWarehouse], DataFrame]:
    """Register a function of the sample warehouse under its own name."""
    QUERIES[build.__name__] = lambda spark, folder: build(SampleWarehouse(tuned(spark), folder))
    return build


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for the comparison with the SQL twin."""
    return df.select(*(
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else f.name
        for f in df.schema.fields
    ))


def rounded(df: DataFrame, *names: str, digits: int = 4) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def store(w: SampleWarehouse, cutoffs=CUTOFF) -> DataFrame:
    """The feature store; the look-back span also bounds the scans below the views of the facts."""
    days = snapshots.cutoff_days(cutoffs)
    since = days[0] - timedelta(days=snapshots.LONG_WINDOW)
    built = features.feature_store(
        w.accounts,
        w.plans,
        w.transactions_between(since, days[-1]),
        w.balances_between(since, days[-1]),
        w.telemetry_between(since, days[-1]),
        cutoffs,
    )
    return rounded(built, "balance_volatility_30d")


@query
def fixture_dim_accounts(w):
    return plain(w.accounts)


@query
def fixture_subscriptions(w):
    return plain(w.subscriptions)


@query
def fixture_transactions(w):
    return plain(w.transactions)


@query
def fixture_balances(w):
    return plain(w.balances)


@query
def fixture_telemetry(w):
    return w.telemetry


@query
def mrr_waterfall(w):
    return revenue.mrr_waterfall(w.subscriptions)


@query
def mrr_waterfall_compact(w):
    return revenue.mrr_waterfall_compact(w.subscriptions)


@query
def mrr_waterfall_chart(w):
    return revenue.mrr_waterfall_compact(w.subscriptions, signed=True)


@query
def mrr_waterfall_head(w):
    """The first ten months, as a preview."""
    return revenue.mrr_waterfall(w.subscriptions).limit(10)


@query
def mrr_transitions(w):
    return revenue.mrr_transitions(w.subscriptions)


@query
def mrr_change_types(w):
    return revenue.mrr_change_types(w.subscriptions)


@query
def cohort_retention_nrr(w):
    return retention.cohort_retention(w.accounts, w.subscriptions)


@query
def cohort_logo_retention(w):
    return retention.cohort_logo_retention(w.accounts, w.subscriptions)


@query
def cohort_retention_matrix(w):
    return retention.cohort_retention_matrix(w.accounts, w.subscriptions)


@query
def active_accounts_at_cutoff(w):
    return snapshots.active_accounts(w.accounts, w.plans, CUTOFF).drop("cutoff_date")


def look_back() -> tuple[date, date]:
    """First and last day that the features of the cutoff read."""
    until = date.fromisoformat(CUTOFF)
    return until - timedelta(days=snapshots.LONG_WINDOW), until


@query
def transaction_features(w):
    return snapshots.transaction_features(w.transactions_between(*look_back()), CUTOFF)


@query
def balance_features(w):
    return rounded(snapshots.balance_features(w.balances_between(*look_back()), CUTOFF), "balance_volatility_30d")


@query
def telemetry_features(w):
    return snapshots.telemetry_features(w.telemetry_between(*look_back()), CUTOFF)


@query
def feature_store(w):
    return store(w)


@query
def feature_store_panel(w):
    return store(w, PANEL_CUTOFFS)


@query
def feature_store_weekly(w):
    """A training panel of 26 weekly cutoffs."""
    return store(w, WEEKLY_CUTOFFS)


@query
def payment_rail_summary(w):
    return reporting.payment_rail_summary(w.transactions)


@query
def failure_reason_tags(w):
    return payments.with_failure_reason(w.transactions).select(
        "account_id", "transaction_date", "payment_method", "failed_tx_count", "primary_failure_reason"
    )


@query
def balance_history(w):
    return plain(reporting.balance_history(w.balances))


@query
def transaction_history(w):
    return plain(reporting.transaction_history(w.transactions))


@query
def account_history(w):
    """Balances of the one account a user looks up."""
    return plain(reporting.balance_history(w.balances, "ACC-000000007"))


# Buckets of the sample warehouse; a large one takes some thousands.
BUCKETS = 8
_folders: dict[tuple[str, str], str] = {}
_written: set[tuple[str, str]] = set()


def stored(w: SampleWarehouse, *names: str) -> str:
    """The bucketed warehouse of the sample; each table is written once a session, when the first query reads it.

    A daily table is the fact folded to account-days.
    """
    key = (w.spark.sparkContext.applicationId, w.folder)
    folder = _folders.setdefault(key, scratch_path(w.spark, "stored"))
    tables = w.contract_tables()
    for name in names:
        if (folder, name) in _written:
            continue
        if name in tables:
            sinks.write_parquet(tables[name], folder, TABLES[name], BUCKETS)
        else:
            table = next(t for t in daily.DAILY_TABLES if t.name == name)
            fact = tables["fact_" + name.removeprefix("daily_")]
            sinks.write_parquet(daily.folded(fact, table), folder, table, BUCKETS)
        _written.add((folder, name))
    return folder


@query
def account_balance_history(w):
    facts = readers.table(w.spark, stored(w, "fact_daily_balances"), "fact_daily_balances")
    return plain(reporting.balance_history(facts, "ACC-000000007"))


@query
def account_transaction_history(w):
    facts = readers.table(w.spark, stored(w, "fact_transactions"), "fact_transactions")
    return plain(reporting.transaction_history(facts, "ACC-000000007"))


@query
def colocated_feature_store(w):
    """The feature store over account-days in buckets of accounts: no fact is shuffled."""
    folder = stored(w, "dim_plans", "dim_accounts", *(t.name for t in daily.DAILY_TABLES))
    since, until = look_back()
    fact = lambda table: readers.read_parquet(w.spark, folder, table, since, until)
    built = features.feature_store(
        readers.table(w.spark, folder, "dim_accounts"),
        readers.table(w.spark, folder, "dim_plans"),
        fact(daily.DAILY_TRANSACTIONS),
        fact(daily.DAILY_BALANCES),
        fact(daily.DAILY_TELEMETRY),
        CUTOFF,
    )
    return rounded(built, "balance_volatility_30d")


@query
def account_demographics(w):
    return reporting.account_demographics(w.accounts, w.plans)


@query
def overall_churn(w):
    return reporting.overall_churn(w.accounts)


@query
def churn_rate_by_segment(w):
    return reporting.churn_rate_by(w.accounts, "industry", "company_size")


@query
def churn_rate_bootstrap(w):
    return reporting.bootstrap_churn_rate(w.accounts, "industry", "company_size")


@query
def feature_label_correlation(w):
    return reporting.feature_label_correlation(materialise(store(w), "features"))


@query
def one_hot_categories(w):
    return reporting.one_hot_categories(snapshots.active_accounts(w.accounts, w.plans, CUTOFF))


def labelled(w: SampleWarehouse) -> DataFrame:
    """Accounts with the churn label only, without the fact aggregates."""
    return snapshots.active_accounts(w.accounts, w.plans, CUTOFF)


@query
def hash_split(w):
    return splits.random_split(labelled(w)).select("account_id", "churn_next_60d", "is_test")


@query
def stratified_split(w):
    return splits.stratified_split(labelled(w), "churn_next_60d").select("account_id", "churn_next_60d", "is_test")


@query
def split_label_stats(w):
    return splits.label_stats(splits.stratified_split(labelled(w), "churn_next_60d"), "churn_next_60d")


def valued(w: SampleWarehouse) -> DataFrame:
    return value.with_twelve_month_value(store(w))


@query
def clv_label(w):
    return valued(w).select("account_id", "value_12m")


@query
def clv_split_medians(w):
    cents = F.round(F.col("value_12m") * 100).cast("long").alias("cents")
    split = splits.random_split(valued(w)).select("is_test", cents)
    return splits.exact_median(split, "is_test", "cents").select("is_test", (F.col("median") / 100).alias("median_value_12m"))


@query
def median_of_any_numbers(w):
    """Doubles, and whole numbers over the full 64 bits."""
    serial = F.substring("account_id", 5, 9).cast("long")
    rows = materialise(splits.random_split(valued(w)).select(
        "is_test",
        (F.col("value_12m") / 3 - 5000).alias("double"),
        ((serial * 7919 % 2000003 - 1000001) * F.lit(9223354444668)).alias("long"),
    ), "numbers")
    found = lambda kind, scale, digits: splits.exact_median(rows, "is_test", kind).select(
        "is_test", F.lit(kind).alias("kind"), F.round(F.col("median") / scale, digits).alias("median")
    )
    return found("double", 1.0, 6).unionByName(found("long", 1e12, 3))


def scored(w: SampleWarehouse) -> DataFrame:
    return with_proxy_score(store(w))


@query
def proxy_probabilities(w):
    return scored(w).select("account_id", "churn_probability")


@query
def threshold_curve(w):
    return threshold.threshold_curve(scored(w))


@query
def optimal_threshold(w):
    return threshold.optimal_threshold(scored(w))


@query
def threshold_value_added(w):
    return threshold.threshold_value_added(scored(w))


@query
def hard_predictions(w):
    p = F.col("churn_probability")
    return scored(w).select("account_id", threshold.hard_prediction(p, 0.25).alias("predicted_churn"))


@query
def classification_metrics(w):
    return metrics.classification_metrics(scored(w))


@query
def classification_metrics_exact(w):
    """The same on a score that nothing rounds, with few ties."""
    spread = F.substring("account_id", 5, 9).cast("long") % 9973
    return metrics.classification_metrics(scored(w).withColumn("fine", F.col("churn_probability") / 3 + spread / 1e9), probability="fine")


@query
def regression_metrics(w):
    """A steady-pace estimate (no velocity) against the twelve-month value."""
    cents = "decimal(18,2)"
    payments_year = F.col("tx_volume_90d").cast(cents) * F.col("take_rate_pct").cast("decimal(6,4)") * 4
    estimate = (F.col("current_mrr").cast("decimal(10,2)") * 12 + payments_year).cast("double")
    return metrics.regression_metrics(valued(w).withColumn("estimate", estimate), "value_12m", "estimate")


def served(w: SampleWarehouse) -> DataFrame:
    """Proxy scores in the serving layout."""
    return proxy_scores(scored(w))


@query
def risk_tiers(w):
    return served(w).select("account_id", "churn_probability", "risk_tier")


@query
def risk_tiers_at_optimum(w):
    """The scored features are written once and read twice: for the optimum and for the tiers."""
    rows = materialise(scored(w), "scored")
    return proxy_scores(rows, best_threshold(rows)).select("account_id", "churn_probability", "risk_tier")


@query
def tier_distribution(w):
    return reporting.tier_distribution(served(w))


def enriched(w: SampleWarehouse) -> DataFrame:
    return reporting.scored_accounts_enriched(served(w), w.accounts, w.plans)


@query
def at_risk_summary(w):
    return reporting.at_risk_summary(enriched(w))


@query
def executive_kpis(w):
    return reporting.executive_kpis(enriched(w))


@query
def scored_accounts_enriched(w):
    return enriched(w)


@query
def critical_accounts(w):
    return tiers.in_tier(enriched(w), "Critical")


@query
def rescue_list(w):
    return reporting.rescue_list(enriched(w))


@query
def reason_codes_additive(w):
    """Reason codes of every account from the additive score's contributions."""
    drivers = reasons.top_drivers(F.col("contributions"), PARTS)
    codes = reasons.reason_codes(drivers)
    return scored(w).select("account_id", *(c.alias(name) for name, c in codes.items()))


@query
def dq_primary_keys(w):
    return quality.primary_keys(w.contract_tables())


@query
def dq_foreign_keys(w):
    return quality.foreign_keys(w.contract_tables())


@query
def dq_not_null(w):
    return quality.column_checks(w.contract_tables(), ["not_null"])


@query
def dq_domains(w):
    return quality.column_checks(w.contract_tables(), ["domain"])


@query
def dq_lengths(w):
    return quality.column_checks(w.contract_tables(), ["text_length", "decimal_range"])


@query
def dq_columns_one_scan(w):
    """Every column check of a table in one scan of it."""
    return quality.column_checks(w.contract_tables())


@query
def dq_decimal_scale(w):
    return quality.column_checks(w.contract_tables() | {RISK_SCORES.name: served(w)}, [quality.SCALE_CHECK])


@query
def dq_ranges(w):
    return quality.minimum_values(w.contract_tables())


@query
def dq_row_counts(w):
    return quality.row_counts(w.contract_tables())


@query
def dq_feature_matrix(w):
    return quality.feature_matrix(store(w), labelled(w), NUMERIC_FEATURES)


@query
def dq_serving_columns(w):
    return quality.column_checks({RISK_SCORES.name: served(w)})


@query
def dq_serving_keys(w):
    return quality.primary_keys({RISK_SCORES.name: served(w)})


@query
def dq_serving_references(w):
    return quality.foreign_keys({RISK_SCORES.name: served(w)}, {"dim_accounts": w.accounts})


@query
def dq_scores(w):
    return quality.scores(served(w))


# Sources and sinks.


def ingested(w: SampleWarehouse, tables: Iterable[Table] = BASE_TABLES, compression: str = "none") -> tuple[DataFrame, str]:
    """Tables written as CSV, loaded into a Parquet warehouse: (row counts, warehouse folder)."""
    csv_folder, warehouse = scratch_path(w.spark, "csv"), scratch_path(w.spark, "warehouse")
    given = w.contract_tables()
    sinks.write_base_csv({t.name: given[t.name] for t in tables}, csv_folder, compression)
    return sinks.ingest_csv(w.spark, csv_folder, warehouse, tables=tables), warehouse


@query
def csv_round_trip(w):
    """Rows written per table, beside the rows and amounts read back."""
    counts, warehouse = ingested(w, compression="gzip")
    tables = readers.load_tables(w.spark, warehouse)
    money = {
        "dim_plans": "monthly_fee",
        "dim_accounts": "initial_deposit_usd",
        "fact_subscriptions": "mrr_amount",
        "fact_transactions": "gross_payment_volume_usd",
        "fact_daily_balances": "closing_balance_usd",
    }
    sums = [
        tables[t.name].select(
            F.lit(t.name).alias("table_name"),
            (F.col(money[t.name]) if t.name in money else F.col("api_call_count")).cast("decimal(18,2)").alias("v"),
        )
        for t in BASE_TABLES
    ]
    read_back = reduce(DataFrame.unionByName, sums).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("rows_read"), F.sum("v").cast("double").alias("total")
    )
    return counts.join(read_back, "table_name")


@query
def warehouse_feature_store(w):
    """The feature store over the Parquet warehouse, whose month folders are pruned to the look-back."""
    _, folder = ingested(w, [t for t in BASE_TABLES if t.name != "fact_subscriptions"])  # the features read no billing
    since, until = look_back()
    fact = lambda name: readers.read_parquet(w.spark, folder, TABLES[name], since, until)
    built = features.feature_store(
        readers.table(w.spark, folder, "dim_accounts"),
        readers.table(w.spark, folder, "dim_plans"),
        fact("fact_transactions"),
        fact("fact_daily_balances"),
        fact("fact_telemetry"),
        CUTOFF,
    )
    return rounded(built, "balance_volatility_30d")


@query
def rescue_list_export(w):
    """The rescue list written as CSV and read back."""
    listed, path = rescue_list(w), scratch_path(w.spark, "rescue")
    sinks.write_csv(listed, path)
    return w.spark.read.schema(listed.schema).option("header", True).csv(path)


@query
def serving_table(w):
    """The scores written to the serving table and read back."""
    folder = scratch_path(w.spark, "serving")
    sinks.write_scores(served(w), RISK_SCORES, folder)
    return plain(readers.table(w.spark, folder, RISK_SCORES.name))


# Models. One training per session and folder serves all queries that need a model.

# The settings of real training: up to 500 and 400 rounds of small steps, a patience of 30.
CHURN = models.ChurnSettings()
TWEEDIE = tweedie.TweedieSettings()


def fit_tweedie(train: DataFrame):
    return models.fit_tweedie_value_model(train, settings=TWEEDIE)


_trained: dict[tuple, Any] = {}


def snapshot_of(w: SampleWarehouse) -> DataFrame:
    """The features all models are trained on, written once a session."""
    key = ("features", w.spark.sparkContext.applicationId, w.folder)
    if key not in _trained:
        _trained[key] = materialise(store(w), "features")
    return _trained[key]


def trained(w: SampleWarehouse) -> tuple[DataFrame, jobs.ChurnTraining]:
    snapshot, key = snapshot_of(w), ("churn", w.spark.sparkContext.applicationId, w.folder)
    if key not in _trained:
        _trained[key] = jobs.train_churn(snapshot, CHURN)
    return snapshot, _trained[key]


def trained_value(w: SampleWarehouse, fit=fit_tweedie) -> jobs.ValueTraining:
    key = (fit.__name__, w.spark.sparkContext.applicationId, w.folder)
    if key not in _trained:
        _trained[key] = jobs.train_value(snapshot_of(w), fit=fit)
    return _trained[key]


@query
def feature_matrix(w):
    """What the models' encoder makes of the features, long form: (account_id, slot, value)."""
    features = store(w)
    encoder = Pipeline(stages=models.feature_stages()).fit(features)
    return attribution.long_form(encoder.transform(features))


@query
def churn_predictions(w):
    """Probabilities of a saved and reloaded model."""
    snapshot, training = trained(w)
    path = scratch_path(w.spark, "churn-model")
    models.save_model(training.model, path)
    return models.churn_predictions(models.load_model(path), snapshot).select(
        "account_id", "churn_probability", "churn_next_60d"
    )


@query
def churn_model_metadata(w):
    """Hold-out metrics and the best threshold, written as JSON and read back."""
    path = scratch_path(w.spark, "churn-metadata")
    models.save_metadata(trained(w)[1].metadata, path)
    return w.spark.read.schema(models.METADATA_SCHEMA).json(path)


@query
def model_threshold_curve(w):
    return threshold.threshold_curve(trained(w)[1].tested)


@query
def clv_predictions(w):
    """The forecast of every account."""
    rows = value.with_twelve_month_value(snapshot_of(w))
    return models.value_predictions(trained_value(w).model, rows).select("account_id", "value_12m", "predicted_value")


@query
def clv_model_metrics(w):
    """The value models on the same hold-out."""
    fits = {"tweedie": models.fit_value_model, "boosted": models.fit_boosted_value_model, "boosted_tweedie": fit_tweedie}
    rows = [
        metrics.regression_metrics(trained_value(w, fit).tested, "value_12m", "predicted_value").select(
            F.lit(name).alias("model"), "*"
        )
        for name, fit in fits.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def contributed(w: SampleWarehouse) -> tuple[DataFrame, list[str]]:
    snapshot, training = trained(w)
    assembled = models.churn_predictions(training.model, snapshot)
    rows = assembled.select("account_id", models.FEATURES)
    return attribution.with_contributions(rows, training.leaves), models.feature_names(assembled)


@query
def local_attribution(w):
    rows, names = contributed(w)
    return attribution.local_attribution(rows, names)


@query
def reason_codes(w):
    rows, names = contributed(w)
    codes = reasons.reason_codes(reasons.top_drivers(F.col("contributions"), names))
    return rows.select("account_id", *(c.alias(name) for name, c in codes.items()))


@query
def global_attribution(w):
    """The ranking written as JSON and read back."""
    snapshot, training = trained(w)
    ranking, path = jobs.feature_ranking(snapshot, training.model, training.leaves), scratch_path(w.spark, "ranking")
    sinks.write_json(ranking, path)
    return w.spark.read.schema(ranking.schema).json(path).orderBy(F.desc("mean_abs_contribution"), "feature")


@query
def batch_risk_scores(w):
    """Both models over the snapshot, at the threshold the saved metadata carries."""
    snapshot, training = trained(w)
    path = scratch_path(w.spark, "churn-metadata")
    models.save_metadata(training.metadata, path)
    threshold_kept = models.load_threshold(w.spark, path)
    value_model = trained_value(w).model
    return jobs.batch_scores(snapshot, training.model, value_model, threshold_kept, f"{CUTOFF} 00:00:00", training.leaves)


def beside(rows: DataFrame, others: DataFrame) -> DataFrame:
    """Two tables of all accounts joined. Spark takes their size from the compressed files below them and would broadcast a table
    that has grown far beyond that."""
    return rows.join(others.hint("merge"), "account_id")


@query
def model_score_checks(w):
    """What must hold of every account that the models score, whatever they have learned."""
    snapshot, training = trained(w)
    cut = training.metadata.first().optimal_threshold
    assembled = models.churn_predictions(training.model, snapshot)
    rows = assembled.select(
        "account_id",
        "current_plan_id",
        F.col("churn_probability").alias("p"),
        vector_to_array("rawPrediction")[1].alias("margin"),
        models.FEATURES,
    )
    explained = attribution.with_contributions(rows, training.leaves)
    total = F.aggregate("contributions", F.lit(attribution.base_margin(training.leaves)), lambda a, x: a + x)
    texts = reasons.reason_codes(reasons.top_drivers(F.col("contributions"), models.feature_names(assembled)))
    risky = F.col("risk_tier").isin("Critical", "High")
    expected = (
        F.when((F.col("p") >= 0.65) | ((F.col("p") >= cut) & (F.col("current_plan_id") == 3)), "Critical")
        .when(F.col("p") >= cut, "High").when(F.col("p") >= 0.15, "Medium").otherwise("Low")
    )
    return beside(explained, batch_risk_scores(w)).select(
        "account_id",
        "current_plan_id",
        F.col("p").between(0.0, 1.0).alias("in_range"),
        (F.abs(F.bround("p", 4) - F.col("churn_probability")) < 1e-9).alias("served_as_predicted"),
        (F.abs(total - F.col("margin")) < 1e-9).alias("contributions_add_up"),
        (F.abs(1 / (1 + F.exp(-2 * F.col("margin"))) - F.col("p")) < 1e-9).alias("margin_gives_probability"),
        (F.col("risk_tier") == expected).alias("tier_follows"),
        F.when(risky, F.col("primary_churn_driver") == texts["primary_churn_driver"])
        .otherwise(F.col("primary_churn_driver") == "Stable Usage Patterns").alias("reason_follows"),
        (F.col("predicted_12m_clv_usd") >= 50).alias("value_at_least_floor"),
    )


@query
def model_serving_kpis(w):
    """The models' scores written to the serving table, read back, checked and summed up."""
    folder = scratch_path(w.spark, "model-serving")
    sinks.write_scores(batch_risk_scores(w), RISK_SCORES, folder)
    read = readers.table(w.spark, folder, RISK_SCORES.name)
    enriched_rows = reporting.scored_accounts_enriched(plain(read), w.accounts, w.plans)
    kpis = reporting.executive_kpis(enriched_rows).select("total_mrr", "total_accounts", "critical_accounts", "at_risk_accounts")
    tiers_found = reporting.tier_distribution(read).agg(F.sum("account_count").alias("in_tiers"))
    bad = quality.column_checks({RISK_SCORES.name: read}).agg(F.sum("violations").alias("violations"))
    found = kpis.withColumns({"in_tiers": tiers_found.scalar(), "violations": bad.scalar()})
    return found.select(
        "total_mrr", "total_accounts", "in_tiers", "violations",
        (F.col("critical_accounts") <= F.col("at_risk_accounts")).alias("critical_are_at_risk"),
    )


def fixed_trees() -> list[attribution.Leaf]:
    """A small hand-made ensemble over the features, with intervals, a repeated feature and category sets."""
    at = {name: k for k, name in enumerate(TREE_FEATURES)}

    def leaf(worth, *conditions):
        return attribution.Leaf(worth, tuple(attribution.Condition(at[name], share, **rest) for name, share, rest in conditions))

    return [
        leaf(1.0, ("tenure_days", 0.6, {"high": 500.0}), ("failed_tx_rate_30d", 0.5, {"high": 0.05})),
        leaf(-2.0, ("tenure_days", 0.6, {"high": 500.0}), ("failed_tx_rate_30d", 0.5, {"low": 0.05})),
        leaf(4.0, ("tenure_days", 0.1, {"low": 500.0, "high": 900.0})),
        leaf(8.0, ("tenure_days", 0.3, {"low": 900.0}), ("current_plan_id", 0.25, {"categories": frozenset({2.0})})),
        leaf(16.0, ("tenure_days", 0.3, {"low": 900.0}), ("current_plan_id", 0.75, {"categories": frozenset({1.0, 3.0})})),
        leaf(0.5, ("failed_tx_rate_30d", 0.4, {"low": 0.02}), ("current_plan_id", 0.5, {"categories": frozenset({1.0})}),
             ("logins_30d", 0.7, {"high": 2.0})),
    ]


TREE_FEATURES = ("tenure_days", "failed_tx_rate_30d", "current_plan_id", "logins_30d")


def tree_vector() -> Column:
    return array_to_vector(F.array(*(F.col(name).cast("double") for name in TREE_FEATURES)))


# A tree as nested tuples: (feature, cut or left categories, left, right), or a leaf's value.
STOPPING_TREES = (
    ("tenure_days", 700.0, 0.4, -0.5),
    ("current_plan_id", [1.0, 3.0], ("logins_30d", 1.0, 0.3, 0.1), -0.2),
    ("failed_tx_rate_30d", 0.05, -0.25, 0.35),
    ("tenure_days", 1500.0, -0.3, 0.6),
    ("logins_30d", 0.0, 0.2, -0.1),
)


def tree_table(tree) -> dict[str, list]:
    """A nested tree as the columns that prefix measures take."""
    columns: dict[str, list] = {name: [] for name in ("feature", "cut", "goes_left", "left", "right", "value")}

    def add(node) -> int:
        place = len(columns["feature"])
        inner = isinstance(node, tuple)
        own = (TREE_FEATURES.index(node[0]) if inner else -1, 0.0, None, -1, -1, 0.0 if inner else node)
        for column, x in zip(columns.values(), own):
            column.append(x)
        if inner:
            columns["goes_left" if isinstance(node[1], list) else "cut"][place] = node[1]
            columns["left"][place], columns["right"][place] = add(node[2]), add(node[3])
        return place

    add(tree)
    return columns


@query
def churn_stopping_curve(w):
    """Loss and area under ROC of every prefix of known trees, and where a patience of two rounds ends."""
    rows = store(w).select(tree_vector().alias(models.FEATURES), "churn_next_60d")
    counts = ensembles.prefix_counts(rows, [tree_table(t) for t in STOPPING_TREES], models.FEATURES, "churn_next_60d")
    curve = ensembles.stopping_curve(ensembles.prefix_measures(counts), 2)
    return rounded(curve, "log_loss", "roc_auc", digits=9)


@query
def tweedie_fixed_rounds(w):
    """Two rounds on known leaves, their values from folded sums, put together as a model that is saved and loaded."""
    names = ("current_plan_id", "tx_count_90d", "tenure_days")
    vector = array_to_vector(F.array(*(F.col(name).cast("double") for name in names)))
    rows = materialise(valued(w).select("account_id", "value_12m", *names, vector.alias(models.FEATURES)), "valued")
    plan, count, tenure = (F.col(name) for name in names)
    leaves = (F.when(plan == 1, 0).when(count <= 50, 1).otherwise(2), F.when(tenure <= 1000, 0).otherwise(1))
    nested = ((0, 1.5, None, (1, 50.0, None, None)), (2, 1000.0, None, None))
    base = rows.agg(F.ln(F.avg("value_12m"))).first()[0]
    settings, margin, trees = tweedie.TweedieSettings(learning_rate=0.3), F.lit(base), []
    for number, (leaf, shape) in enumerate(zip(leaves, nested)):
        sums = tweedie.leaf_sums(rows, leaf, F.col("value_12m"), margin, settings.power, F.lit(False).alias("held_back"))
        found = {row.leaf: row.step for row in tweedie.stepped(sums, settings).collect()}
        steps = [found.get(k, 0.0) for k in range(3 - number)]
        margin = margin + F.element_at(F.lit(steps), leaf + 1)
        own = [base + s for s in steps] if number == 0 else steps
        trees.append((ensembles.tree_notes(w.spark), ensembles.nested_nodes(shape, own)))
    estimator = GBTRegressor(featuresCol=models.FEATURES, predictionCol=models.LOG_MEAN)
    model = ensembles.boosted_regression(w.spark, estimator, trees, len(names))
    loaded = GBTRegressionModel.load(ensembles.saved(model, w.spark))
    return loaded.transform(rows).select("account_id", F.round(F.exp(models.LOG_MEAN), 4).alias("predicted_value"))


@query
def model_reload_checks(w):
    """Both models saved and loaded: every account scores as before."""
    snapshot, training = trained(w)
    fitted = {"p": training.model, "v": trained_value(w).model}
    score = {
        "p": lambda m: models.churn_predictions(m, snapshot).select("account_id", F.col("churn_probability").alias("x")),
        "v": lambda m: models.value_predictions(m, snapshot).select("account_id", F.col("predicted_value").alias("x")),
    }
    same = []
    for name, model in fitted.items():
        path = scratch_path(w.spark, "model")
        models.save_model(model, path)
        before, after = score[name](model), score[name](models.load_model(path))
        pairs = before.join(after.withColumnRenamed("x", "y"), "account_id")
        same.append(pairs.select("account_id", (F.col("x") == F.col("y")).alias(name)))
    return same[0].join(same[1], "account_id").select("account_id", F.col("p").alias("same_probability"), F.col("v").alias("same_value"))


@query
def metadata_round_trip(w):
    """The notes on a model, here on the fixed score, written as JSON and read back."""
    path = scratch_path(w.spark, "metadata")
    models.save_metadata(models.metadata_of(scored(w), "fixed score", len(PARTS), list(PARTS)), path)
    read = w.spark.read.schema(models.METADATA_SCHEMA).json(path)
    money = "financial_optimization."
    return read.select(
        "model_type", "best_iteration", "optimal_threshold", "metrics.*",
        *(money + n for n in ("max_net_savings_test_set_usd", "default_0_5_savings_usd", "value_added_usd")),
    )


@query
def global_attribution_fixed_trees(w):
    """The ranking over known trees, written as JSON and read back."""
    rows = store(w).select("account_id", tree_vector().alias(models.FEATURES))
    ranking, path = attribution.global_attribution(rows, fixed_trees(), TREE_FEATURES), scratch_path(w.spark, "ranking")
    sinks.write_json(ranking, path)
    return rounded(w.spark.read.schema(ranking.schema).json(path), "mean_abs_contribution", digits=9)


@query
def attribution_fixed_trees(w):
    """The attribution code over the feature store with known trees, so that SQL can work out the definition."""
    rows = store(w).select("account_id", tree_vector().alias(models.FEATURES))
    contributed_rows = attribution.with_contributions(rows, fixed_trees())
    long = attribution.local_attribution(contributed_rows, TREE_FEATURES)
    return rounded(long, "contribution", digits=9)
