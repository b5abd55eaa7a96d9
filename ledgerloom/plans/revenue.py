"""Monthly recurring revenue: waterfall, compact waterfall and account transitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import as_double, cents, dollars, ratio
from ledgerloom.operators.movements import movement_buckets, movement_types, with_previous_month

_BUCKETS = ("new_mrr", "expansion_mrr", "contraction_mrr", "churned_mrr")


def _panel(subscriptions: DataFrame) -> DataFrame:
    return with_previous_month(
        subscriptions.select("account_id", "billing_month", "mrr_amount", "billing_status")
    )


def _monthly(subscriptions: DataFrame) -> DataFrame:
    """Movement sums per month, in cents: one shuffle for the history, a tiny one for the months."""
    in_cents = subscriptions.withColumn("mrr_amount", cents(F.col("mrr_amount")))
    return (
        movement_buckets(_panel(in_cents))
        .groupBy("billing_month")
        .agg(*(F.sum(b).alias(b) for b in _BUCKETS), F.sum("mrr_amount").alias("ending_mrr"))
    )


def mrr_waterfall(subscriptions: DataFrame) -> DataFrame:
    """Starting MRR, four movements, net change, ending MRR and growth rate per month."""
    net = F.col("new_mrr") + F.col("expansion_mrr") - F.col("contraction_mrr") - F.col("churned_mrr")
    sums = _monthly(subscriptions).withColumn("net", net).withColumn("start", F.col("ending_mrr") - F.col("net"))
    return sums.select(
        "billing_month",
        dollars(F.col("start")).alias("starting_mrr"),
        *(dollars(F.col(b)).alias(f"total_{b}") for b in _BUCKETS),
        dollars(F.col("net")).alias("net_new_mrr"),
        dollars(F.col("ending_mrr")).alias("total_ending_mrr"),
        ratio(dollars(F.col("net")) * 100.0, dollars(F.col("start")), 0.0, 2).alias("mrr_growth_rate_pct"),
    ).orderBy("billing_month")


def mrr_waterfall_compact(subscriptions: DataFrame, signed: bool = False) -> DataFrame:
    """The six-column form; ``signed`` turns losses negative for a chart around the axis."""
    sums = _monthly(subscriptions)
    losses = ("contraction_mrr", "churned_mrr")
    columns = [
        dollars(-F.col(b) if signed and b in losses else F.col(b)).alias(b) for b in _BUCKETS
    ]
    return sums.select(
        "billing_month", *columns, dollars(F.col("ending_mrr")).alias("total_mrr")
    ).orderBy("billing_month")


def mrr_transitions(subscriptions: DataFrame) -> DataFrame:
    """One row per account and month with the previous row and the four buckets."""
    return movement_buckets(_panel(subscriptions)).select(
        "account_id",
        "billing_month",
        as_double(F.col("previous_mrr_amount")).alias("previous_mrr_amount"),
        "previous_billing_status",
        as_double(F.col("mrr_amount")).alias("current_mrr_amount"),
        *(as_double(F.col(b)).alias(b) for b in _BUCKETS),
    )


def mrr_change_types(subscriptions: DataFrame) -> DataFrame:
    """One row per account and month with its movement tag and signed amount."""
    return movement_types(_panel(subscriptions)).select(
        "account_id",
        "billing_month",
        "mrr_change_type",
        as_double(F.col("mrr_change_amount")).alias("mrr_change_amount"),
    )
