"""Reason codes: the features that push an account's risk up, in words, with an action."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (feature, reason text, recommended action).
REASONS = (
    ("tx_volume_velocity_ratio", "Sharp Drop in Payment Processing Volume",
     "Investigate if merchant is diverting transaction flow to a competing processor."),
    ("failed_tx_rate_30d", "Elevated Payment Failure / Decline Rate",
     "Urgent review with Payment Operations to resolve card/ACH processing declines."),
    ("card_failure_rate_30d", "Card Expired / Limit Decline Spike",
     "Trigger automated card updater and dunning smart retry campaign."),
    ("ach_failure_rate_30d", "ACH Insufficient Funds (NSF) Crisis",
     "Urgent cash flow check-in; merchant operating cash is dangerously low."),
    ("wire_failure_rate_30d", "Wire Transfer Compliance / Routing Failure",
     "Enterprise payment operations review to unlock blocked high-value wires."),
    ("balance_decay_pct", "Significant Cash Flow / Balance Depletion",
     "Schedule financial check-in; discuss flexible credit line or fee restructuring."),
    ("telemetry_velocity_ratio", "Severe Product Disengagement (API / Dashboard)",
     "Trigger Customer Success re-onboarding and executive outreach."),
    ("days_since_last_login", "Extended Portal Inactivity",
     "Send proactive engagement email highlighting under-utilized analytics features."),
    ("balance_volatility_30d", "Erratic Cash Flow Volatility",
     "Review liquidity health and assess risk profile."),
    ("current_mrr", "High Plan Tier Exposure",
     "Ensure dedicated Technical Account Manager touchpoint for enterprise contract."),
)
NO_PRIMARY = "general_behavior"
NO_SECONDARY = "stable_metrics"
DEFAULT_ACTION = "Conduct general Customer Success quarterly business review."
CANDIDATES = 3


def top_drivers(contributions: Column, names: Sequence[str], candidates: int = CANDIDATES) -> Column:
    """Names of the largest contributions, positive ones only, largest first.

    Works within the row on an array of at most one entry per feature; equal contributions keep the order of
    ``names``.
    """
    labels = F.array(*map(F.lit, names))
    pairs = F.transform(contributions, lambda value, i: F.struct((-value).alias("down"), i.alias("at")))
    leading = F.slice(F.sort_array(pairs), 1, candidates)
    positive = F.filter(leading, lambda pair: pair["down"] < 0)
    return F.transform(positive, lambda pair: F.element_at(labels, pair["at"] + 1))


def _dictionary(position: int) -> Column:
    return F.create_map(*(F.lit(entry[i]) for entry in REASONS for i in (0, position)))


def reason_codes(drivers: Column) -> dict[str, Column]:
    """Primary text, secondary text and action for an array of driver names."""
    primary = F.coalesce(F.get(drivers, F.lit(0)), F.lit(NO_PRIMARY))
    secondary = F.coalesce(F.get(drivers, F.lit(1)), F.lit(NO_SECONDARY))
    return {
        "primary_churn_driver": F.coalesce(
            F.try_element_at(_dictionary(1), primary), F.concat(F.lit("Elevated "), primary)
        ),
        "secondary_churn_driver": F.coalesce(
            F.try_element_at(_dictionary(1), secondary), F.concat(F.lit("Fluctuations in "), secondary)
        ),
        "recommended_action": F.coalesce(F.try_element_at(_dictionary(2), primary), F.lit(DEFAULT_ACTION)),
    }
