"""Small frames in the contract's types, and plan helpers."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

SUBSCRIPTIONS = "account_id string, billing_month date, plan_id int, mrr_amount decimal(18,2), billing_status string"
PLANS = "plan_id int, plan_name string, monthly_fee decimal(10,2), take_rate_pct decimal(6,4)"
ACCOUNTS = (
    "account_id string, company_name string, industry string, company_size string, country string, "
    "initial_plan_id int, current_plan_id int, signup_date date, initial_deposit_usd decimal(18,2), "
    "churn_date date, is_churned int"
)
TRANSACTIONS = (
    "account_id string, transaction_date date, payment_method string, total_tx_count int, "
    "successful_tx_count int, failed_tx_count int, gross_payment_volume_usd decimal(18,2), "
    "fees_collected_usd decimal(18,2)"
)
BALANCES = "account_id string, balance_date date, closing_balance_usd decimal(18,2)"
TELEMETRY = "account_id string, log_date date, api_call_count int, dashboard_logins int, exports_count int"


def money(value):
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.01"))


def day(text):
    return None if text is None else date.fromisoformat(text)


def subscriptions(spark, rows):
    """rows: (account, month as YYYY-MM, amount, status)."""
    return spark.createDataFrame(
        [(a, day(f"{m}-01"), 1, money(v), s) for a, m, v, s in rows], SUBSCRIPTIONS
    )


def plans(spark):
    return spark.createDataFrame(
        [(1, "Starter", money(99), Decimal("0.0190")), (2, "Growth", money(499), Decimal("0.0150")),
         (3, "Enterprise", money(1999), Decimal("0.0110"))],
        PLANS,
    )


def accounts(spark, rows):
    """rows: (account, signup, churn or None, deposit)."""
    return spark.createDataFrame(
        [(a, f"Corp {a}", "HealthTech", "Small (1-20)", "Canada", 1, 1, day(s), money(d), day(c), int(c is not None))
         for a, s, c, d in rows],
        ACCOUNTS,
    )


def transactions(spark, rows):
    """rows: (account, day, rail, total, failed, volume)."""
    return spark.createDataFrame(
        [(a, day(d), r, t, t - f, f, money(v), money(float(v) * 0.019)) for a, d, r, t, f, v in rows], TRANSACTIONS
    )


def balances(spark, rows):
    return spark.createDataFrame([(a, day(d), money(v)) for a, d, v in rows], BALANCES)


def telemetry(spark, rows):
    return spark.createDataFrame([(a, day(d), *counts) for a, d, *counts in rows], TELEMETRY)


def by(df, *key):
    """Collected rows by the value of a key column (or a tuple of several)."""
    return {r[key[0]] if len(key) == 1 else tuple(r[k] for k in key): r for r in df.collect()}


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()
