"""Twelve-month monetary value of an account."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import clip

LABEL_FLOOR = 100
PREDICTION_FLOOR = 50.0
NOISE_DEVIATION = 0.08


def _hash_normal(key: Column, seed: int) -> Column:
    """A standard normal draw fixed by the key: Box-Muller on two 32-bit hash uniforms."""
    digest = F.md5(F.concat(key, F.lit(str(seed))))
    uniform = lambda start: (F.conv(F.substring(digest, start, 8), 16, 10).cast("double") + 0.5) / 2.0**32
    return F.sqrt(-2.0 * F.ln(uniform(1))) * F.cos(2.0 * math.pi * uniform(9))


def with_twelve_month_value(features: DataFrame, noise_seed: int | None = None) -> DataFrame:
    """Add ``value_12m``: a year of subscription plus a year of payment fees at the recent pace, at least 100.

    Decimal arithmetic keeps it exact to the cent. Noise around the value is off unless a seed is given, and
    is then a function of the account, so every run gives the same label.
    """
    velocity = clip(F.col("tx_volume_velocity_ratio"), 0.1, 2.5).cast("decimal(5,4)")
    rate = (velocity * F.col("take_rate_pct").cast("decimal(6,4)")).cast("decimal(12,8)")
    payments = F.col("tx_volume_90d").cast("decimal(18,2)") * (rate * 4).cast("decimal(13,8)")
    subscription = F.col("current_mrr").cast("decimal(10,2)") * 12
    value = (subscription + payments).cast("decimal(34,10)")
    if noise_seed is None:
        floored = F.greatest(F.round(value, 2), F.lit(LABEL_FLOOR).cast("decimal(34,2)")).cast("double")
    else:
        noisy = value.cast("double") * (1.0 + NOISE_DEVIATION * _hash_normal(F.col("account_id"), noise_seed))
        floored = F.round(F.greatest(noisy, F.lit(float(LABEL_FLOOR))), 2)
    return features.withColumn("value_12m", floored)
