"""Batch scores: probability, tier, value, reasons and time of every account, in the serving layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.reasons import reason_codes
from ledgerloom.operators.tiers import at_risk, calm_reasons, risk_tier
from ledgerloom.operators.value import PREDICTION_FLOOR


def score_rows(
    accounts: DataFrame,
    probability: Column,
    value: Column,
    drivers: Column,
    threshold: float | Column,
    scored_at: str,
) -> DataFrame:
    """The serving table's eight columns.

    The tier is decided on the unrounded probability, and served numbers are rounded half to even; accounts that are not at risk
    get the standing texts.
    ``drivers`` names the features behind an at-risk account, largest first.
    """
    rows = accounts.withColumns({
        "churn_probability": probability,
        "risk_tier": risk_tier(probability, F.col("current_plan_id"), threshold),
    })
    risky, codes, calm = at_risk(F.col("risk_tier")), reason_codes(drivers), calm_reasons()
    return rows.select(
        "account_id",
        F.lit(scored_at).cast("timestamp").alias("score_timestamp"),
        F.bround("churn_probability", 4).alias("churn_probability"),
        "risk_tier",
        F.bround(F.greatest(value, F.lit(PREDICTION_FLOOR)), 2).alias("predicted_12m_clv_usd"),
        *(F.when(risky, codes[name]).otherwise(calm[name]).alias(name) for name in codes),
    )
