"""Model quality from counts by score: whatever the number of rows, no step gathers them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialise


def classification_metrics(
    scored: DataFrame, label: str = "churn_next_60d", probability: str = "churn_probability"
) -> DataFrame:
    """One row: ROC-AUC, PR-AUC (trapezoid) and Brier score, on the scores as they are.

    Rows are folded to one point a score. The points are cut into ranges of scores and written; a range's running sums start
    from the totals of the ranges above it, of which there is one row each.
    """
    y, p = F.col(label), F.col(probability)
    points = scored.groupBy(p.alias("score")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(y).alias("positives"),
        F.sum((p - y) * (p - y)).alias("squares"),
    )
    ranges = points.repartitionByRange(F.desc("score")).withColumn("range", F.spark_partition_id())
    ranges = materialise(ranges, "score-ranges")
    totals = ranges.groupBy("range").agg(F.sum("n").alias("n"), F.sum("positives").alias("positives"))
    above = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums_above = totals.select(
        "range",
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n_above"),
        F.coalesce(F.sum("positives").over(above), F.lit(0)).alias("positives_above"),
    )
    down = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    curve = ranges.join(sums_above, "range").select(
        "n",
        "positives",
        "squares",
        (F.col("positives_above") + F.sum("positives").over(down)).alias("tp"),
        (F.col("n_above") + F.sum("n").over(down)).alias("predicted"),
    )
    before = F.col("predicted") - F.col("n")
    precision = F.col("tp") / F.col("predicted")
    previous_precision = F.when(before > 0, (F.col("tp") - F.col("positives")) / before).otherwise(1.0)
    # Twice the area under ROC in units of one positive-negative pair: whole numbers, so exact.
    twice_pairs = (F.col("n") - F.col("positives")).cast("decimal(19,0)") * (2 * F.col("tp") - F.col("positives"))
    step = F.col("positives") * (precision + previous_precision) / 2
    positives, negatives = F.sum("positives"), F.sum(F.col("n") - F.col("positives"))
    both = (positives > 0) & (negatives > 0)
    pairs = positives.cast("double") * negatives
    return curve.agg(
        F.round(F.when(both, F.sum(twice_pairs).cast("double") / (2 * pairs)), 6).alias("roc_auc"),
        F.round(F.when(positives > 0, F.sum(step) / positives), 6).alias("pr_auc"),
        F.round(F.sum("squares") / F.sum("n"), 6).alias("brier_score"),
    )


def regression_metrics(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mean absolute error, root mean squared error and R squared."""
    error = F.col(prediction) - F.col(label)
    unexplained, spread = F.sum(error * error), F.var_pop(label) * F.count(label)
    return scored.agg(
        F.round(F.avg(F.abs(error)), 4).alias("mae"),
        F.round(F.sqrt(F.avg(error * error)), 4).alias("rmse"),
        F.round(F.when(spread > 0, 1 - unexplained / spread), 6).alias("r2"),
    )
