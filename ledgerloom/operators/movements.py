"""Month-over-month revenue movements of an account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous_month(subscriptions: DataFrame) -> DataFrame:
    """Add the account's previous row: ``previous_mrr_amount`` and ``previous_billing_status``.

    "Previous" is the previous row, not the previous calendar month. The defaults apply only where no
    previous row exists; a NULL amount stays NULL. The input is the monthly panel, one row per account and
    month, so a window holds at most the number of billed months, whatever the size of the account.
    """
    history = Window.partitionBy("account_id").orderBy("billing_month")
    return subscriptions.withColumns({
        "previous_mrr_amount": F.lag("mrr_amount", 1, 0).over(history),
        "previous_billing_status": F.lag("billing_status", 1, "None").over(history),
    })


def _conditions() -> dict[str, Column]:
    previous, current = F.col("previous_mrr_amount"), F.col("mrr_amount")
    return {
        "New": (previous == 0) & (current > 0),
        "Expansion": (previous > 0) & (current > previous),
        "Contraction": (previous > 0) & (current < previous) & (current > 0),
        "Churn": (previous > 0) & ((current == 0) | (F.col("billing_status") == "Churned")),
    }


def movement_buckets(panel: DataFrame) -> DataFrame:
    """Four independent buckets per row; a row may fall into contraction and churn at once."""
    holds = _conditions()
    previous, current = F.col("previous_mrr_amount"), F.col("mrr_amount")

    def bucket(kind: str, amount: Column) -> Column:
        return F.when(holds[kind], amount).otherwise(F.lit(0))

    return panel.withColumns({
        "new_mrr": bucket("New", current),
        "expansion_mrr": bucket("Expansion", current - previous),
        "contraction_mrr": bucket("Contraction", previous - current),
        "churned_mrr": bucket("Churn", previous),
    })


def movement_types(panel: DataFrame) -> DataFrame:
    """One tag per row (first match wins, else Retained) with its signed amount."""
    first_match = F.coalesce(
        *(F.when(condition, F.lit(kind)) for kind, condition in _conditions().items()), F.lit("Retained")
    )
    previous, current = F.col("previous_mrr_amount"), F.col("mrr_amount")
    kind = F.col("mrr_change_type")
    amount = (
        F.when(kind == "New", current)
        .when(kind == "Churn", -previous)
        .when(kind == "Retained", F.lit(0))
        .otherwise(current - previous)
    )
    return panel.withColumn("mrr_change_type", first_match).withColumn(
        "mrr_change_amount", amount.cast("decimal(18,2)")
    )


def churn_months(subscriptions: DataFrame) -> DataFrame:
    """First month with a Churned row, per account that has one."""
    return (
        subscriptions.where(F.col("billing_status") == "Churned")
        .groupBy("account_id")
        .agg(F.min("billing_month").alias("churn_date"))
    )


def with_churn_status(accounts: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Attach ``churn_date`` and the ``is_churned`` flag to the accounts."""
    return accounts.join(churn_months(subscriptions), "account_id", "left").withColumn(
        "is_churned", F.col("churn_date").isNotNull().cast("int")
    )
