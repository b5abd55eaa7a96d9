"""The cut-off that saves the most money: a sweep over a grid of hundredths in one pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import cents_of_double, dollars

SUCCESS_RATE = 0.40
INTERVENTION_COST = 350.0
FIRST_HUNDREDTH = 5
LAST_HUNDREDTH = 90
DEFAULT_THRESHOLD = 0.50


def hard_prediction(probability: Column, threshold: float | Column) -> Column:
    return (probability >= threshold).cast("int")


def _highest_hundredth_reached(probability: Column) -> Column:
    """The largest k with ``k / 100.0 <= probability``, by comparison of the very doubles of the grid."""
    k = F.floor(probability * 100)
    return F.when((k + 1) / F.lit(100.0) <= probability, k + 1).when(k / F.lit(100.0) > probability, k - 1).otherwise(k)


def _sweep(scored: DataFrame, probability: str, label: str, mrr: str, success_rate: float, cost: float) -> DataFrame:
    """Counts and unrounded net savings per threshold.

    Each row is counted once, at the highest threshold it reaches; running sums from the top of the grid
    then give every threshold. The running window sees the grid's 86 rows only.
    """
    churned = F.col(label) == 1
    reached = (
        scored.where(F.col(probability) >= FIRST_HUNDREDTH / 100)
        .groupBy(F.least(_highest_hundredth_reached(F.col(probability)), F.lit(LAST_HUNDREDTH)).alias("hundredth"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(churned).alias("tp"),
            F.sum(F.when(churned, cents_of_double(F.col(mrr)))).alias("tp_mrr"),
        )
    )
    grid = scored.sparkSession.range(FIRST_HUNDREDTH, LAST_HUNDREDTH + 1).toDF("hundredth")
    from_top = Window.orderBy(F.desc("hundredth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = lambda name: F.coalesce(F.sum(name).over(from_top), F.lit(0))
    net = dollars(F.col("tp_mrr")) * 12.0 * success_rate - F.col("interventions_count") * cost
    return (
        grid.join(reached, "hundredth", "left")
        .select(
            (F.col("hundredth") / F.lit(100.0)).alias("threshold"),
            running("n").alias("interventions_count"),
            running("tp").alias("true_positives"),
            running("tp_mrr").alias("tp_mrr"),
        )
        .withColumn("false_positives", F.col("interventions_count") - F.col("true_positives"))
        .withColumn("net", net)
        .drop("tp_mrr")
    )


def threshold_curve(
    scored: DataFrame,
    probability: str = "churn_probability",
    label: str = "churn_next_60d",
    mrr: str = "current_mrr",
    success_rate: float = SUCCESS_RATE,
    cost: float = INTERVENTION_COST,
) -> DataFrame:
    """Net savings, interventions, true and false positives for every threshold of the grid."""
    return _sweep(scored, probability, label, mrr, success_rate, cost).select(
        "threshold",
        F.round("net", 2).alias("net_savings_usd"),
        "interventions_count",
        "true_positives",
        "false_positives",
    ).orderBy("threshold")


def optimal_threshold(
    scored: DataFrame,
    probability: str = "churn_probability",
    label: str = "churn_next_60d",
    mrr: str = "current_mrr",
    success_rate: float = SUCCESS_RATE,
    cost: float = INTERVENTION_COST,
) -> DataFrame:
    """The threshold with the largest net savings; the lowest one wins a tie."""
    return (
        _sweep(scored, probability, label, mrr, success_rate, cost)
        .orderBy(F.desc("net"), F.asc("threshold"))
        .limit(1)
        .select("threshold", F.round("net", 2).alias("net_savings_usd"), "interventions_count",
                "true_positives", "false_positives")
    )


def threshold_value_added(
    scored: DataFrame,
    probability: str = "churn_probability",
    label: str = "churn_next_60d",
    mrr: str = "current_mrr",
    success_rate: float = SUCCESS_RATE,
    cost: float = INTERVENTION_COST,
) -> DataFrame:
    """One row: the optimum, its net savings, those of the default cut-off, and the difference."""
    near_default = F.abs(F.col("threshold") - DEFAULT_THRESHOLD) < 0.01
    best = F.max(F.struct("net", (-F.col("threshold")).alias("low_first")))
    default = F.min(F.when(near_default, F.struct("threshold", "net")))
    return (
        _sweep(scored, probability, label, mrr, success_rate, cost)
        .agg(best.alias("best"), default.alias("default"))
        .select(
            (-F.col("best.low_first")).alias("optimal_threshold"),
            F.round("best.net", 2).alias("max_net_savings_usd"),
            F.round("default.net", 2).alias("default_0_5_savings_usd"),
            F.round(F.col("best.net") - F.round("default.net", 2), 2).alias("value_added_usd"),
        )
    )
