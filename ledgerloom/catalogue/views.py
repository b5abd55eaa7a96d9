"""The star schema, derived from the sample tables (customer, nation, orders, lineitem, events).

Monthly billing comes from orders, payment batches from line items, daily balances and usage from events.
"""

from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.operators.movements import movement_types, with_churn_status, with_previous_month
from ledgerloom.operators.payments import with_failure_reason, with_fees

CUTOFF = "1996-10-31"
PANEL_CUTOFFS = ("1996-08-31", "1996-09-30", "1996-10-31")
WEEKLY_CUTOFFS = tuple(str(date(1996, 5, 3) + timedelta(weeks=k)) for k in range(26))

# The three subscription plans.
PLANS = (
    (1, "Starter", Decimal("99.00"), Decimal("0.0190"), 5, 120),
    (2, "Growth", Decimal("499.00"), Decimal("0.0150"), 25, 600),
    (3, "Enterprise", Decimal("1999.00"), Decimal("0.0110"), 100, 3000),
)
_EVENTS_START = date(2024, 1, 1)
_BALANCES_START = date(1996, 8, 5)
_BATCH_EPOCH = date(1990, 1, 1)


def _account_id(key: str) -> str:
    return f"concat('ACC-', lpad(string({key}), 9, '0')) AS account_id"


def _amount(total_cents: str, name: str) -> str:
    return f"CAST(CAST({total_cents} AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) AS {name}"


def _plan_of(key: str, name: str) -> str:
    return f"int({key} % 3 + 1) AS {name}"


class SampleWarehouse:
    """The six base tables over one folder of sample tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._sources: dict[str, DataFrame] = {}

    def _read(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    @cached_property
    def plans(self) -> DataFrame:
        """An inline table, whose three rows the optimizer knows and broadcasts by itself."""
        values = ", ".join(
            f"({i}, '{name}', {fee}BD, {rate}BD, {seats}, {limit})" for i, name, fee, rate, seats, limit in PLANS
        )
        names = schemas.DIM_PLANS.schema.names
        typed = (F.col(f.name).cast(f.dataType) for f in schemas.DIM_PLANS.schema.fields)
        return self.spark.sql(f"SELECT * FROM VALUES {values} AS plans({', '.join(names)})").select(*typed)

    @cached_property
    def subscriptions(self) -> DataFrame:
        """Billed amount per account and month; a month of fulfilled orders only counts as churned."""
        return (
            self._read("orders")
            .selectExpr(
                "o_custkey AS customer",
                "trunc(date(o_orderdate), 'MM') AS billing_month",
                "o_orderstatus AS status",
                "CAST(round(o_totalprice * 100) AS BIGINT) AS price",
            )
            .groupBy("customer", "billing_month")
            # Boolean buffers keep this a hash aggregation; text minima would sort every row first.
            .agg(
                F.expr("sum(if(status <> 'F', price, 0L)) AS billed"),
                F.expr("bool_and(status = 'F') AS all_f"),
                F.expr("bool_and(status = 'P') AS all_p"),
            )
            .selectExpr(
                _account_id("customer"),
                "billing_month",
                _plan_of("customer", "plan_id"),
                _amount("billed", "mrr_amount"),
                "CASE WHEN all_f THEN 'Churned' WHEN all_p THEN 'Failed' ELSE 'Paid' END AS billing_status",
            )
        )

    @cached_property
    def accounts(self) -> DataFrame:
        signups = (
            self._read("orders").groupBy("o_custkey").agg(F.expr("min(date(o_orderdate)) AS signup_date"))
        )
        profiles = (
            self._read("customer")
            .join(self._read("nation"), F.expr("c_nationkey = n_nationkey"), "left")
            .join(signups, F.expr("c_custkey = o_custkey"), "left")
            .selectExpr(
                _account_id("c_custkey"),
                "c_name AS company_name",
                "c_mktsegment AS industry",
                "CASE WHEN c_acctbal < 2500 THEN 'Small (1-20)' WHEN c_acctbal < 5000 THEN 'Mid-Market (21-100)' "
                "WHEN c_acctbal < 7500 THEN 'Enterprise (101-500)' ELSE 'Large Enterprise (500+)' END AS company_size",
                "n_name AS country",
                _plan_of("c_custkey", "initial_plan_id"),
                _plan_of("c_custkey", "current_plan_id"),
                "signup_date",
                "CAST(c_acctbal AS DECIMAL(18,2)) AS initial_deposit_usd",
            )
        )
        return with_churn_status(profiles, self.subscriptions)

    @cached_property
    def transactions(self) -> DataFrame:
        return self.transactions_between()

    def transactions_between(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Payment batches per account, day and rail; the bounds are compared on the raw ship time, so they
        reach the scan of the line items."""
        lines = self._read("lineitem")
        if since is not None:
            lines = lines.where(f"l_shipdate >= TIMESTAMP_NTZ'{since}'")
        if until is not None:
            lines = lines.where(f"l_shipdate < TIMESTAMP_NTZ'{until + timedelta(days=1)}'")
        batches = (
            lines.join(self._read("orders"), F.expr("l_orderkey = o_orderkey"))
            .selectExpr(
                "o_custkey AS customer",
                "date(l_shipdate) AS transaction_date",
                "CASE l_returnflag WHEN 'A' THEN 'Credit Card' WHEN 'N' THEN 'ACH Direct Debit' "
                "WHEN 'R' THEN 'Wire Transfer' END AS payment_method",
                "int(l_quantity) AS quantity",
                "if(l_linestatus = 'F', int(floor(l_quantity * l_discount)), 0) AS failed",
                "CAST(round(l_extendedprice * 100) AS BIGINT) AS price",
            )
            .groupBy("customer", "transaction_date", "payment_method")
            .agg(
                F.expr("int(sum(quantity)) AS total_tx_count"),
                F.expr("int(sum(failed)) AS failed_tx_count"),
                F.expr(_amount("sum(price)", "gross_payment_volume_usd")),
            )
            .selectExpr("*", _plan_of("customer", "plan_id"))
        )
        return with_fees(batches, self.plans).selectExpr(
            _account_id("customer"),
            "transaction_date",
            "payment_method",
            "total_tx_count",
            "successful_tx_count",
            "failed_tx_count",
            "gross_payment_volume_usd",
            "fees_collected_usd",
        )

    def _event_days(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Events with their account and a day stretched threefold over the look-back season.

        Bounds on the day are turned into bounds on the raw time, so they reach the scan.
        """
        events = self._read("events")
        if since is not None:
            first = _EVENTS_START + timedelta(days=-(-(since - _BALANCES_START).days // 3))
            events = events.where(f"ts >= TIMESTAMP_NTZ'{first}'")
        if until is not None:
            end = _EVENTS_START + timedelta(days=(until - _BALANCES_START).days // 3 + 1)
            events = events.where(f"ts < TIMESTAMP_NTZ'{end}'")
        return events.selectExpr(
            "user_id * 10 + event_id % 10 AS account_key",
            f"date_add(DATE'{_BALANCES_START}', datediff(date(ts), DATE'{_EVENTS_START}') * 3) AS day",
            "event_id",
            "event_type",
            "value",
        )

    @cached_property
    def balances(self) -> DataFrame:
        return self.balances_between()

    def balances_between(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """The last value of each account and day."""
        return (
            self._event_days(since, until)
            .groupBy("account_key", "day")
            .agg(F.expr("CAST(max_by(value, event_id) AS DECIMAL(18,2)) AS closing_balance_usd"))
            .selectExpr(_account_id("account_key"), "day AS balance_date", "closing_balance_usd")
        )

    @cached_property
    def telemetry(self) -> DataFrame:
        return self.telemetry_between()

    def telemetry_between(self, since: date | None = None, until: date | None = None) -> DataFrame:
        """Counts of event types per account and day."""
        return (
            self._event_days(since, until)
            .groupBy("account_key", "day")
            .agg(
                F.expr("int(count_if(event_type IN ('click', 'view'))) AS api_call_count"),
                F.expr("int(count_if(event_type = 'signup')) AS dashboard_logins"),
                F.expr("int(count_if(event_type = 'purchase')) AS exports_count"),
            )
            .selectExpr(
                _account_id("account_key"), "day AS log_date", "api_call_count", "dashboard_logins", "exports_count"
            )
        )

    def contract_tables(self) -> dict[str, DataFrame]:
        """All six base tables with every column of their contracts, identifiers included."""
        serial = lambda day: F.substring("account_id", 5, 9).cast("long") * 10000 + F.datediff(
            day, F.lit(_BATCH_EPOCH)
        )
        rail = F.array_position(F.array(*map(F.lit, schemas.PAYMENT_METHODS)), F.col("payment_method"))
        tables = {
            "dim_plans": self.plans,
            "dim_accounts": self.accounts.withColumn("latent_archetype", F.lit(None).cast("int")),
            "fact_subscriptions": movement_types(with_previous_month(self.subscriptions)).withColumn(
                "subscription_id",
                F.concat_ws("-", F.lit("SUB"), "account_id", F.date_format("billing_month", "yyyyMM")),
            ),
            "fact_transactions": with_failure_reason(self.transactions).withColumn(
                "transaction_batch_id", serial(F.col("transaction_date")) * 3 + rail - 1
            ),
            "fact_daily_balances": self.balances,
            "fact_telemetry": self.telemetry.withColumn("telemetry_id", serial(F.col("log_date"))),
        }
        return {name: df.select(*schemas.TABLES[name].schema.names) for name, df in tables.items()}
