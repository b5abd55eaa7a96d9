"""The table contracts: one star schema of two dimensions, four facts and one serving table.

Column types are declared, never inferred. Text limits and decimal limits of the contract travel as
field metadata, so the quality checks read them from here as well.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# The allowed values of the coded columns.
BILLING_STATUSES = ("Paid", "Failed", "Churned")
MOVEMENT_TYPES = ("New", "Expansion", "Contraction", "Churn", "Retained")
PAYMENT_METHODS = ("Credit Card", "ACH Direct Debit", "Wire Transfer")
FAILURE_REASONS = (
    "None",
    "Card Expired / Limit Reached",
    "Non-Sufficient Funds (NSF)",
    "Compliance / Routing Error",
)
RISK_TIERS = ("Low", "Medium", "High", "Critical")


@dataclass(frozen=True)
class Table:
    """A table contract: types, key, references, domains and the column that dates its rows."""

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    references: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent column)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    non_negative: tuple[str, ...] = ()
    dated_by: str | None = None

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    @property
    def text_limits(self) -> dict[str, int]:
        return {f.name: f.metadata["max_length"] for f in self.schema.fields if "max_length" in f.metadata}

    @property
    def decimal_limits(self) -> dict[str, tuple[int, int]]:
        return {
            f.name: (f.metadata["precision"], f.metadata["scale"])
            for f in self.schema.fields
            if "precision" in f.metadata
        }


def _text(name: str, limit: int, nullable: bool = False) -> T.StructField:
    return T.StructField(name, T.StringType(), nullable, {"max_length": limit})


def _money(name: str, precision: int, scale: int, held: tuple[int, int] | None = None) -> T.StructField:
    """A decimal column; ``held`` is a wider storage type than the contract's limit."""
    stored = T.DecimalType(*(held or (precision, scale)))
    return T.StructField(name, stored, False, {"precision": precision, "scale": scale})


def _int(name: str, nullable: bool = False) -> T.StructField:
    return T.StructField(name, T.IntegerType(), nullable)


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType(), False)


def _day(name: str, nullable: bool = False) -> T.StructField:
    return T.StructField(name, T.DateType(), nullable)


# The seven table contracts, column by column.
DIM_PLANS = Table(
    "dim_plans",
    T.StructType([
        _int("plan_id"),
        _text("plan_name", 50),
        _money("monthly_fee", 10, 2),
        _money("take_rate_pct", 6, 4),
        _int("included_seats"),
        _int("api_rate_limit_per_min"),
    ]),
    key=("plan_id",),
)

DIM_ACCOUNTS = Table(
    "dim_accounts",
    T.StructType([
        _text("account_id", 20),
        _text("company_name", 100),
        _text("industry", 50),
        _text("company_size", 50),
        _text("country", 50),
        _int("initial_plan_id"),
        _int("current_plan_id"),
        _day("signup_date"),
        _money("initial_deposit_usd", 18, 2),
        _day("churn_date", nullable=True),
        _int("is_churned"),
        _int("latent_archetype", nullable=True),
    ]),
    key=("account_id",),
    references=(
        ("initial_plan_id", "dim_plans", "plan_id"),
        ("current_plan_id", "dim_plans", "plan_id"),
    ),
)

FACT_SUBSCRIPTIONS = Table(
    "fact_subscriptions",
    T.StructType([
        _text("subscription_id", 50),
        _text("account_id", 20),
        _day("billing_month"),
        _int("plan_id"),
        _money("mrr_amount", 10, 2, held=(18, 2)),
        _text("billing_status", 20),
        _text("mrr_change_type", 20),
        _money("mrr_change_amount", 10, 2, held=(18, 2)),
    ]),
    key=("subscription_id",),
    references=(("account_id", "dim_accounts", "account_id"), ("plan_id", "dim_plans", "plan_id")),
    domains={"billing_status": BILLING_STATUSES, "mrr_change_type": MOVEMENT_TYPES},
    non_negative=("mrr_amount",),
    dated_by="billing_month",
)

FACT_TRANSACTIONS = Table(
    "fact_transactions",
    T.StructType([
        _long("transaction_batch_id"),
        _text("account_id", 20),
        _day("transaction_date"),
        _text("payment_method", 30),
        _int("total_tx_count"),
        _int("successful_tx_count"),
        _int("failed_tx_count"),
        _text("primary_failure_reason", 50),
        _money("gross_payment_volume_usd", 18, 2),
        _money("fees_collected_usd", 18, 2),
    ]),
    key=("transaction_batch_id",),
    references=(("account_id", "dim_accounts", "account_id"),),
    domains={"payment_method": PAYMENT_METHODS, "primary_failure_reason": FAILURE_REASONS},
    non_negative=("gross_payment_volume_usd",),
    dated_by="transaction_date",
)

FACT_DAILY_BALANCES = Table(
    "fact_daily_balances",
    T.StructType([
        _text("account_id", 20),
        _day("balance_date"),
        _money("closing_balance_usd", 18, 2),
    ]),
    key=("account_id", "balance_date"),
    references=(("account_id", "dim_accounts", "account_id"),),
    dated_by="balance_date",
)

FACT_TELEMETRY = Table(
    "fact_telemetry",
    T.StructType([
        _long("telemetry_id"),
        _text("account_id", 20),
        _day("log_date"),
        _int("api_call_count"),
        _int("dashboard_logins"),
        _int("exports_count"),
    ]),
    key=("telemetry_id",),
    references=(("account_id", "dim_accounts", "account_id"),),
    dated_by="log_date",
)

RISK_SCORES = Table(
    "analytics_account_risk_scores",
    T.StructType([
        _text("account_id", 20),
        T.StructField("score_timestamp", T.TimestampType(), False),
        _money("churn_probability", 6, 4),
        _text("risk_tier", 20),
        _money("predicted_12m_clv_usd", 18, 2),
        _text("primary_churn_driver", 100),
        _text("secondary_churn_driver", 100),
        _text("recommended_action", 255),
    ]),
    key=("account_id", "score_timestamp"),
    references=(("account_id", "dim_accounts", "account_id"),),
    domains={"risk_tier": RISK_TIERS},
)

BASE_TABLES = (
    DIM_PLANS,
    DIM_ACCOUNTS,
    FACT_SUBSCRIPTIONS,
    FACT_TRANSACTIONS,
    FACT_DAILY_BALANCES,
    FACT_TELEMETRY,
)
TABLES = {t.name: t for t in (*BASE_TABLES, RISK_SCORES)}

# The model's numeric inputs in their contract order, and its categorical inputs.
NUMERIC_FEATURES = (
    "tenure_days",
    "current_plan_id",
    "current_mrr",
    "take_rate_pct",
    "initial_deposit_usd",
    "tx_volume_30d",
    "tx_volume_90d",
    "tx_count_30d",
    "tx_count_90d",
    "fees_collected_30d",
    "fees_collected_90d",
    "tx_volume_velocity_ratio",
    "failed_tx_rate_30d",
    "card_vol_share_30d",
    "ach_vol_share_30d",
    "wire_vol_share_30d",
    "card_failure_rate_30d",
    "ach_failure_rate_30d",
    "wire_failure_rate_30d",
    "current_balance_usd",
    "avg_balance_30d",
    "avg_balance_90d",
    "balance_volatility_30d",
    "balance_decay_pct",
    "api_calls_30d",
    "api_calls_90d",
    "logins_30d",
    "logins_90d",
    "exports_30d",
    "days_since_last_api_call",
    "days_since_last_login",
    "telemetry_velocity_ratio",
)
CATEGORICAL_FEATURES = ("industry", "company_size", "country")
LABEL = "churn_next_60d"
