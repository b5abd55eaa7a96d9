"""The point-in-time feature store: one row per account active at a cutoff."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerloom.functions.numbers import ratio_sql
from ledgerloom.operators.snapshots import (
    LONG_WINDOW,
    RAIL_PREFIXES,
    Cutoffs,
    active_accounts,
    balance_features,
    cutoff_days,
    snapshot_key,
    telemetry_features,
    transaction_features,
)
from ledgerloom.schemas import CATEGORICAL_FEATURES, LABEL, NUMERIC_FEATURES

_ZERO_AMOUNTS = (
    "tx_volume_30d", "tx_volume_90d", "fees_collected_30d", "fees_collected_90d", "balance_volatility_30d",
)
_ZERO_COUNTS = (
    "tx_count_30d", "tx_count_90d", "api_calls_30d", "api_calls_90d", "logins_30d", "logins_90d", "exports_30d",
)
_RECENCIES = ("days_since_last_api_call", "days_since_last_login")
_BALANCES = ("current_balance_usd", "avg_balance_30d", "avg_balance_90d")


def _expressions() -> dict[str, str]:
    """SQL text of every feature that is not taken over as it stands."""
    decay = "round((coalesce(avg_balance_30d, 0.0D) - avg_balance_90d) / avg_balance_90d, 4)"
    found = {
        "tx_volume_velocity_ratio": ratio_sql("tx_volume_30d", "tx_volume_90d / 3.0D", 1.0),
        "telemetry_velocity_ratio": ratio_sql("api_calls_30d", "api_calls_90d / 3.0D", 1.0),
        "failed_tx_rate_30d": ratio_sql("failed_tx_count_30d", "tx_count_30d", 0.0),
        "balance_decay_pct": f"if(avg_balance_90d > 0, {decay}, 0.0D)",
    }
    for rail in RAIL_PREFIXES:
        found[f"{rail}_vol_share_30d"] = ratio_sql(f"{rail}_vol_30d", "tx_volume_30d", 0.0)
        found[f"{rail}_failure_rate_30d"] = ratio_sql(f"{rail}_failed_30d", f"{rail}_total_30d", 0.0)
    found |= {name: f"coalesce({name}, 0.0D)" for name in _ZERO_AMOUNTS}
    found |= {name: f"coalesce({name}, 0L)" for name in _ZERO_COUNTS}
    found |= {name: f"coalesce({name}, {LONG_WINDOW})" for name in _RECENCIES}
    return found | {name: f"coalesce({name}, initial_deposit_usd)" for name in _BALANCES}


def feature_store(
    accounts: DataFrame,
    plans: DataFrame,
    transactions: DataFrame,
    balances: DataFrame,
    telemetry: DataFrame,
    cutoffs: Cutoffs,
    keep_cutoff: bool = False,
) -> DataFrame:
    """37 columns per active account: identity, 32 numeric features, categories and the label.

    The three fact tables are filtered to their look-back at the scan and aggregated to one row per account
    before they are joined, so the joins run at account grain on inputs already partitioned by account.
    With several cutoffs (or ``keep_cutoff``) the result also carries ``cutoff_date``.
    """
    days = cutoff_days(cutoffs)
    key = snapshot_key(days)
    columns = _expressions()
    joined = (
        active_accounts(accounts, plans, days)
        .join(transaction_features(transactions, days), key, "left")
        .join(balance_features(balances, days), key, "left")
        .join(telemetry_features(telemetry, days), key, "left")
    )
    identity = ["account_id"] + (["cutoff_date"] if keep_cutoff or len(days) > 1 else [])
    numeric = [f"{columns.get(name, name)} AS {name}" for name in NUMERIC_FEATURES]
    return joined.selectExpr(*identity, *CATEGORICAL_FEATURES, *numeric, LABEL)
