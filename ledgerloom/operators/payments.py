"""Payment-batch columns derived from counts, rail and plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The failure reason of each payment rail.
RAIL_FAILURE_REASONS = {
    "Credit Card": "Card Expired / Limit Reached",
    "ACH Direct Debit": "Non-Sufficient Funds (NSF)",
    "Wire Transfer": "Compliance / Routing Error",
}


def failure_reason(payment_method: Column, failed_count: Column) -> Column:
    """The rail's reason where a batch has failures, else the text 'None'."""
    reasons = (
        F.when((failed_count > 0) & (payment_method == rail), F.lit(text))
        for rail, text in RAIL_FAILURE_REASONS.items()
    )
    return F.coalesce(*reasons, F.lit("None"))


def with_failure_reason(transactions: DataFrame) -> DataFrame:
    return transactions.withColumn(
        "primary_failure_reason", failure_reason(F.col("payment_method"), F.col("failed_tx_count"))
    )


def with_fees(batches: DataFrame, plans: DataFrame) -> DataFrame:
    """Successful count, and fees = volume x the take rate of the batch's ``plan_id``, to the cent."""
    rates = plans.select("plan_id", "take_rate_pct")
    fees = F.round(F.col("gross_payment_volume_usd") * F.col("take_rate_pct"), 2)
    return (
        batches.join(rates, "plan_id")
        .withColumn("successful_tx_count", F.col("total_tx_count") - F.col("failed_tx_count"))
        .withColumn("fees_collected_usd", fees.cast("decimal(18,2)"))
        .drop("take_rate_pct")
    )
