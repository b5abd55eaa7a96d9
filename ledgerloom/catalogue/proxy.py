"""A fixed additive score over the features, so that everything after a model can be checked in SQL.

It stands in for a model in the checks only; batch scoring uses the trained models.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.catalogue.views import CUTOFF
from ledgerloom.operators.reasons import top_drivers
from ledgerloom.operators.threshold import optimal_threshold
from ledgerloom.operators.value import with_twelve_month_value
from ledgerloom.plans.scoring import score_rows

SCORED_AT = f"{CUTOFF} 00:00:00"
BASE = "0.0500"
THRESHOLD = 0.24
PARTS = ("failed_tx_rate_30d", "tx_volume_velocity_ratio", "days_since_last_login", "tenure_days")


def _dec(text: str) -> Column:
    return F.lit(text).cast("decimal(6,4)")


def _parts() -> dict[str, Column]:
    """Contribution of each feature, in exact decimals."""
    failed = F.col("failed_tx_rate_30d").cast("decimal(6,4)")
    slowdown = 1 - F.least(F.col("tx_volume_velocity_ratio").cast("decimal(18,4)"), F.lit(1).cast("decimal(18,4)"))
    idle = F.col("days_since_last_login").cast("decimal(6,0)")
    youth = F.greatest(365 - F.col("tenure_days"), F.lit(0)).cast("decimal(6,0)")
    amounts = (failed * _dec("1.5"), slowdown * _dec("0.3"), idle * _dec("0.003"), youth * _dec("0.0001"))
    return dict(zip(PARTS, amounts))


def with_proxy_score(features: DataFrame) -> DataFrame:
    """Add ``contributions``, ``churn_probability`` (4 decimals) and ``value_12m``."""
    parts = _parts()
    total = sum(parts.values(), _dec(BASE))
    return with_twelve_month_value(features).withColumns({
        "contributions": F.array(*(p.cast("decimal(18,8)").cast("double") for p in parts.values())),
        "churn_probability": F.round(F.least(total, _dec("1")), 4).cast("double"),
    })


def best_threshold(scored: DataFrame) -> Column:
    """The proxy's own optimum, as a scalar subquery."""
    return optimal_threshold(scored).select("threshold").scalar()


def proxy_scores(scored: DataFrame, threshold: float | Column = THRESHOLD) -> DataFrame:
    """The serving table of the proxy."""
    return score_rows(
        scored,
        F.col("churn_probability"),
        F.col("value_12m"),
        top_drivers(F.col("contributions"), PARTS),
        threshold,
        SCORED_AT,
    )
