"""Point-in-time building blocks: who is active at a cutoff, and look-back aggregates per account.

Every function takes one cutoff or a list of cutoffs. The date bounds are literals, so they reach the Parquet scan. Aggregation
runs map-side first, so an account with very many rows brings one partial row per task into the shuffle. With several cutoffs the
facts are folded once, whatever their number (``panels``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.dates import as_date
from ledgerloom.functions.numbers import DOLLARS, cents_sql
from ledgerloom.operators.panels import panel_sums

LONG_WINDOW = 90
SHORT_WINDOW = 30
LABEL_HORIZON = 60

Cutoffs = str | date | Sequence[str | date]

# The short prefix of each payment rail in feature names.
RAIL_PREFIXES = {"card": "Credit Card", "ach": "ACH Direct Debit", "wire": "Wire Transfer"}


def cutoff_days(cutoffs: Cutoffs) -> list[date]:
    many = [cutoffs] if isinstance(cutoffs, (str, date)) else list(cutoffs)
    return sorted({date.fromisoformat(c) if isinstance(c, str) else c for c in many})


def snapshot_key(days: list[date]) -> list[str]:
    return ["account_id"] if len(days) == 1 else ["account_id", "cutoff_date"]


def _expand(df: DataFrame, days: list[date], holds) -> DataFrame:
    """One row per cutoff for which ``holds(cutoff)`` is true."""
    if len(days) == 1:
        return df.where(holds(as_date(days[0]))).withColumn("cutoff_date", as_date(days[0]))
    # Plain conditions stay in generated code, which a higher-order filter of the list would leave.
    candidates = F.array(*(F.when(holds(as_date(d)), as_date(d)) for d in days))
    return df.withColumn("cutoff_date", F.explode(candidates)).where("cutoff_date IS NOT NULL")


def in_lookback(facts: DataFrame, day: str, cutoff: date, window: int = LONG_WINDOW) -> DataFrame:
    """Rows dated within ``window`` days up to and including the cutoff."""
    return facts.where(f"{day} BETWEEN DATE'{cutoff - timedelta(days=window)}' AND DATE'{cutoff}'")


def _prepared(facts: DataFrame, day: str, cutoff: date, *columns: str) -> DataFrame:
    """Look-back rows with the columns asked for, and whether they fall into the short window."""
    rows = in_lookback(facts, day, cutoff).withColumn("cutoff_date", as_date(cutoff))
    return rows.selectExpr("account_id", *columns, f"{day} >= date_sub(cutoff_date, {SHORT_WINDOW}) AS recent")


def active_accounts(
    accounts: DataFrame, plans: DataFrame, cutoffs: Cutoffs, horizon: int = LABEL_HORIZON
) -> DataFrame:
    """Accounts signed up by the cutoff and not yet churned, with tenure, plan terms and the label."""
    days = cutoff_days(cutoffs)
    active = _expand(
        accounts.where(F.col("signup_date") <= as_date(days[-1])),
        days,
        lambda c: (F.col("signup_date") <= c) & (F.col("churn_date").isNull() | (F.col("churn_date") > c)),
    )
    terms = plans.selectExpr("plan_id AS current_plan_id", "monthly_fee", "take_rate_pct")
    return active.join(terms, "current_plan_id").selectExpr(
        "account_id",
        "cutoff_date",
        "industry",
        "company_size",
        "country",
        "current_plan_id",
        "double(monthly_fee) AS current_mrr",
        "double(take_rate_pct) AS take_rate_pct",
        "signup_date",
        "double(initial_deposit_usd) AS initial_deposit_usd",
        "churn_date",
        "datediff(cutoff_date, signup_date) AS tenure_days",
        f"if(churn_date > cutoff_date AND churn_date <= date_add(cutoff_date, {horizon}), 1, 0) AS churn_next_60d",
    )


BOTH, SHORT = (SHORT_WINDOW, LONG_WINDOW), (SHORT_WINDOW,)


def _panel(facts: DataFrame, day: str, days: list[date], sums: dict, columns: Sequence[str], **more) -> DataFrame:
    return panel_sums(facts, day, days, BOTH, sums, **more).selectExpr("account_id", "cutoff_date", *columns)


def transaction_features(transactions: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """Volumes, counts, failures and fees per account, overall and per payment rail."""
    days = cutoff_days(cutoffs)
    amounts = {
        "volume": cents_sql("gross_payment_volume_usd"), "total": "total_tx_count", "failed": "failed_tx_count",
        "fees": cents_sql("fees_collected_usd"),
    }
    overall = (
        ("volume", "tx_volume", DOLLARS), ("total", "tx_count", ""), ("failed", "failed_tx_count", ""), ("fees", "fees_collected", DOLLARS),
    )
    on_rails = [
        (prefix, rail, column, name, unit)
        for prefix, rail in RAIL_PREFIXES.items()
        for column, name, unit in (("volume", "vol", DOLLARS), ("failed", "failed", ""), ("total", "total", ""))
    ]
    if len(days) > 1:
        sums = {column: (amounts[column], BOTH) for column, *_ in overall}
        for prefix, rail, column, *_ in on_rails:
            sums[f"{prefix}_{column}"] = f"if(payment_method = '{rail}', {amounts[column]}, 0)", SHORT
        columns = [f"{column}_{w} {unit} AS {name}_{w}d" for column, name, unit in overall for w in BOTH]
        columns += [f"{prefix}_{column}_30 {unit} AS {prefix}_{name}_30d" for prefix, _, column, name, unit in on_rails]
        return _panel(transactions, "transaction_date", days, sums, columns)
    prepared = _prepared(
        transactions, "transaction_date", days[0], "payment_method", *(f"{e} AS {column}" for column, e in amounts.items())
    )
    sums = []
    for column, name, unit in overall:
        sums.append(f"sum(if(recent, {column}, 0)) {unit} AS {name}_30d")
        sums.append(f"sum({column}) {unit} AS {name}_90d")
    for prefix, rail, column, name, unit in on_rails:
        sums.append(f"sum(if(recent AND payment_method = '{rail}', {column}, 0)) {unit} AS {prefix}_{name}_30d")
    return prepared.groupBy("account_id").agg(*map(F.expr, sums))


def balance_features(balances: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """Balance on the cutoff day, 30- and 90-day means, and the 30-day sample deviation."""
    days = cutoff_days(cutoffs)
    cents = cents_sql("closing_balance_usd")
    mean = f"{{}} {DOLLARS} / nullif({{}}, 0)"
    if len(days) > 1:
        wide = f"CAST({cents} AS DECIMAL(19,0))"
        sums = {
            "known": ("if(closing_balance_usd IS NULL, 0L, 1L)", BOTH), "total": (cents, BOTH), "squares": (f"{wide} * {wide}", SHORT),
        }
        spread = "CAST(known_30 AS DECIMAL(19,0)) * squares_30 - CAST(total_30 AS DECIMAL(19,0)) * CAST(total_30 AS DECIMAL(19,0))"
        columns = [
            f"balance {DOLLARS} AS current_balance_usd",
            mean.format("total_30", "known_30") + " AS avg_balance_30d",
            f"if(known_30 > 1, sqrt(double({spread}) / (double(known_30) * (known_30 - 1))) {DOLLARS}, NULL) AS balance_volatility_30d",
            mean.format("total_90", "known_90") + " AS avg_balance_90d",
        ]
        return _panel(balances, "balance_date", days, sums, columns, on_cutoff={"balance": cents})
    prepared = _prepared(balances, "balance_date", days[0], f"{cents} AS balance", "balance_date = cutoff_date AS at_cutoff")
    sums = [
        f"max(if(at_cutoff, balance, NULL)) {DOLLARS} AS current_balance_usd",
        mean.format("sum(if(recent, balance, NULL))", "count(if(recent, balance, NULL))") + " AS avg_balance_30d",
        f"stddev_samp(if(recent, balance {DOLLARS}, NULL)) AS balance_volatility_30d",
        mean.format("sum(balance)", "count(balance)") + " AS avg_balance_90d",
    ]
    return prepared.groupBy("account_id").agg(*map(F.expr, sums))


def telemetry_features(telemetry: DataFrame, cutoffs: Cutoffs) -> DataFrame:
    """Usage counts and days since the last API call and the last login."""
    days = cutoff_days(cutoffs)
    amounts = {"calls": "api_call_count", "logins": "dashboard_logins", "exports": "exports_count"}
    if len(days) > 1:
        sums = {"calls": (amounts["calls"], BOTH), "logins": (amounts["logins"], BOTH), "exports": (amounts["exports"], SHORT)}
        age = f"if(datediff(cutoff_date, {{0}}) <= {LONG_WINDOW}, datediff(cutoff_date, {{0}}), NULL)"
        columns = [
            "calls_30 AS api_calls_30d", "logins_30 AS logins_30d", "exports_30 AS exports_30d",
            "calls_90 AS api_calls_90d", "logins_90 AS logins_90d",
            age.format("last_call") + " AS days_since_last_api_call", age.format("last_login") + " AS days_since_last_login",
        ]
        last_days = {"last_call": "api_call_count > 0", "last_login": "dashboard_logins > 0"}
        return _panel(telemetry, "log_date", days, sums, columns, last_days=last_days)
    prepared = _prepared(
        telemetry, "log_date", days[0], *(f"{e} AS {name}" for name, e in amounts.items()), "datediff(cutoff_date, log_date) AS age"
    )
    sums = [
        "sum(if(recent, calls, 0)) AS api_calls_30d",
        "sum(if(recent, logins, 0)) AS logins_30d",
        "sum(if(recent, exports, 0)) AS exports_30d",
        "sum(calls) AS api_calls_90d",
        "sum(logins) AS logins_90d",
        "min(if(calls > 0, age, NULL)) AS days_since_last_api_call",
        "min(if(logins > 0, age, NULL)) AS days_since_last_login",
    ]
    return prepared.groupBy("account_id").agg(*map(F.expr, sums))
