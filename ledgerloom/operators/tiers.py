"""Operational risk tiers of scored accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CRITICAL_PROBABILITY = 0.65
MEDIUM_PROBABILITY = 0.15
PREMIUM_PLAN = 3
AT_RISK = ("Critical", "High")

# The texts of accounts that are not at risk.
CALM_PRIMARY = "Stable Usage Patterns"
CALM_SECONDARY = "Healthy Financial Metrics"
CALM_ACTION = "Routine automated nurture communications."


def risk_tier(
    probability: Column,
    plan_id: Column,
    threshold: float | Column,
    critical: float = CRITICAL_PROBABILITY,
    medium: float = MEDIUM_PROBABILITY,
    premium_plan: int = PREMIUM_PLAN,
) -> Column:
    """Ordered rules, the first that holds decides. With a threshold below ``medium`` no row is Medium."""
    over = probability >= threshold
    return (
        F.when((probability >= critical) | (over & (plan_id == premium_plan)), "Critical")
        .when(over, "High")
        .when(probability >= medium, "Medium")
        .otherwise("Low")
    )


def at_risk(tier: Column) -> Column:
    return tier.isin(*AT_RISK)


def calm_reasons() -> dict[str, Column]:
    return {
        "primary_churn_driver": F.lit(CALM_PRIMARY),
        "secondary_churn_driver": F.lit(CALM_SECONDARY),
        "recommended_action": F.lit(CALM_ACTION),
    }


def in_tier(scored: DataFrame, *tiers: str) -> DataFrame:
    return scored.where(F.col("risk_tier").isin(*tiers))
