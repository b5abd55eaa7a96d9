"""Facts folded to one row per account and day (and payment rail), the grain in which the warehouse keeps them beside the accounts.

An account then has at most one row a day, however many batches it sends, so a file that holds all days of an account is bounded. The
look-back features are sums and take these rows as they take the raw ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import FACT_DAILY_BALANCES, FACT_TELEMETRY, FACT_TRANSACTIONS, Table


def _summed(fact: Table, name: str, keys: tuple[str, ...], sums: tuple[str, ...]) -> Table:
    """The contract of the folded table: counts as BIGINT, amounts as decimals of their scale."""
    wide = {c: T.DecimalType(18, 2) if isinstance(fact.schema[c].dataType, T.DecimalType) else T.LongType() for c in sums}
    fields = [fact.schema[k] for k in keys] + [T.StructField(c, wide[c], False) for c in sums]
    return Table(name, T.StructType(fields), key=keys, dated_by=fact.dated_by)


DAILY_TRANSACTIONS = _summed(
    FACT_TRANSACTIONS,
    "daily_transactions",
    ("account_id", "transaction_date", "payment_method"),
    ("total_tx_count", "failed_tx_count", "gross_payment_volume_usd", "fees_collected_usd"),
)
DAILY_TELEMETRY = _summed(
    FACT_TELEMETRY, "daily_telemetry", ("account_id", "log_date"), ("api_call_count", "dashboard_logins", "exports_count")
)
DAILY_BALANCES = FACT_DAILY_BALANCES  # its key is the account and the day already
DAILY_TABLES = (DAILY_TRANSACTIONS, DAILY_BALANCES, DAILY_TELEMETRY)


def folded(fact: DataFrame, daily: Table) -> DataFrame:
    """The fact in the daily grain; folded map-side before its one shuffle."""
    if daily is DAILY_BALANCES:
        return fact.select(*daily.schema.names)
    sums = [f for f in daily.schema.fields if f.name not in daily.key]
    return fact.groupBy(*daily.key).agg(*(F.sum(f.name).cast(f.dataType).alias(f.name) for f in sums))
