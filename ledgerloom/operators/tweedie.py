"""Boosted trees on the Tweedie deviance with a logarithmic link.

With the forecast exp(F) and variance power p between 1 and 2, the loss of a row is -y exp((1-p)F)/(1-p) + exp((2-p)F)/(2-p). A tree is
fitted to the Newton response -g/h with weight h. Its leaves are then valued anew: the best constant of a leaf is the logarithm of
sum(y exp((1-p)F)) / sum(exp((2-p)F)). The same two sums also give the deviance after the step, so one fold of the rows to leaves serves
both, and a step of at most the best constant can only lower the deviance.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.ensembles import boosted_regression, fitted_trees, with_leaf_values
from ledgerloom.session import discard, materialise

MARGIN = "margin"
# A leaf moves by at most this much on the logarithmic scale, also where all its values are zero.
LARGEST_STEP = 4.0


@dataclass(frozen=True)
class TweedieSettings:
    """``rounds`` is a limit: boosting ends when the deviance of the held-back rows has not fallen for ``patience`` rounds, and the rounds
    up to the best one stay. Margins are written every ``rounds_written`` rounds, which ends their lineage."""

    power: float = 1.5
    rounds: int = 400
    patience: int = 30
    depth: int = 6
    learning_rate: float = 0.05
    min_leaf: int = 20
    max_bins: int = 32
    row_share: float = 1.0
    feature_share: float = 0.8
    seed: int = 42
    rounds_written: int = 10


@dataclass(frozen=True)
class Fitted:
    """A fitted ensemble and the mean deviance of the fitted and the held-back rows after every round that was made."""

    model: GBTRegressionModel
    deviances: Sequence[tuple[float, float | None]]


def _terms(y: Column, margin: Column, power: float) -> tuple[Column, Column]:
    """y exp((1-p)F) and exp((2-p)F)."""
    return y * F.exp(margin * (1.0 - power)), F.exp(margin * (2.0 - power))


def newton_response(y: Column, margin: Column, power: float) -> tuple[Column, Column]:
    """What a tree is fitted to, and the weight of the row."""
    a, b = _terms(y, margin, power)
    weight = (power - 1.0) * a + (2.0 - power) * b
    return (a - b) / weight, weight


def leaf_sums(rows: DataFrame, leaf: Column, y: Column, margin: Column, power: float, *by: Column) -> DataFrame:
    """Rows folded to leaves: (leaf, ..., a, b, n, own), ``own`` being the part of the deviance that no forecast changes."""
    a, b = _terms(y, margin, power)
    own = F.pow(y, 2.0 - power) / ((1.0 - power) * (2.0 - power))
    return rows.groupBy(leaf.alias("leaf"), *by).agg(
        F.sum(a).alias("a"), F.sum(b).alias("b"), F.count(F.lit(1)).alias("n"), F.sum(own).alias("own")
    )


def leaf_step(a: Column, b: Column, learning_rate: float) -> Column:
    """The step of a leaf: a share of its best constant."""
    best = F.when(a > 0, F.ln(a / b)).otherwise(-LARGEST_STEP)
    return learning_rate * F.greatest(F.least(best, F.lit(LARGEST_STEP)), F.lit(-LARGEST_STEP))


def deviance_after(a: Column, b: Column, own: Column, step: Column, power: float) -> Column:
    """The summed deviance of a leaf's rows after a step, from the sums before it."""
    return 2.0 * (own - a * F.exp((1.0 - power) * step) / (1.0 - power) + b * F.exp((2.0 - power) * step) / (2.0 - power))


def stepped(sums: DataFrame, settings: TweedieSettings) -> DataFrame:
    """Leaf sums of both parts (boolean ``held_back``) in one row a leaf: its step, and deviance and rows of each part after it."""
    part = lambda name, held: F.coalesce(F.sum(F.when(F.col("held_back") == held, F.col(name))), F.lit(0)).cast("double")
    folded = sums.groupBy("leaf").agg(*(part(n, h).alias(f"{n}_{h}") for h in (False, True) for n in ("a", "b", "own", "n")))
    step = leaf_step(F.col("a_False"), F.col("b_False"), settings.learning_rate)
    after = lambda h: deviance_after(F.col(f"a_{h}"), F.col(f"b_{h}"), F.col(f"own_{h}"), F.col("step"), settings.power)
    return folded.withColumn("step", step).select(
        "leaf",
        "step",
        after(False).alias("fitted_deviance"),
        F.col("n_False").alias("fitted_rows"),
        after(True).alias("held_deviance"),
        F.col("n_True").alias("held_rows"),
    )


def fit(rows: DataFrame, features: str, target: str, held_back: str, prediction: str, settings: TweedieSettings) -> Fitted:
    """Boost over ``rows``; ``held_back`` (boolean) marks the rows that only decide when to stop.

    The model predicts the logarithm of the mean as column ``prediction``. Each round fits one tree on Spark, folds all rows once to
    at most 2^depth leaves, and brings those few sums to the driver. Targets must not be negative.
    """
    spark = rows.sparkSession
    y, margin = F.col(target).cast("double"), F.col(MARGIN)
    source = rows.select(features, y.alias(target), F.coalesce(held_back, F.lit(False)).alias("held_back"))
    first = source.where("NOT held_back").agg(F.avg(target).alias("mean"), F.min(target).alias("least")).first()
    if first["mean"] is None or first["mean"] <= 0 or first["least"] < 0:
        raise ValueError("a Tweedie fit needs rows with values of zero or more that are not all zero")
    base = math.log(first["mean"])
    state = written = materialise(source.withColumn(MARGIN, F.lit(base)), "tweedie")
    forests, values = [], []
    deviances: list[tuple[float, float | None]] = []
    best, best_round = math.inf, 0
    for number in range(1, settings.rounds + 1):
        response, weight = newton_response(F.col(target), margin, settings.power)
        forest = RandomForestRegressor(
            numTrees=1,
            bootstrap=False,
            featuresCol=features,
            labelCol="_response",
            weightCol="_weight",
            predictionCol="_tree",
            leafCol="_leaf",
            maxDepth=settings.depth,
            maxBins=settings.max_bins,
            minInstancesPerNode=settings.min_leaf,
            subsamplingRate=settings.row_share,
            featureSubsetStrategy=str(settings.feature_share),
            seed=settings.seed + number,
        ).fit(state.where("NOT held_back").withColumns({"_response": response, "_weight": weight}))
        placed = forest.transform(state).withColumn("_leaf", vector_to_array("_leaf")[0].cast("int"))
        sums = leaf_sums(placed, F.col("_leaf"), F.col(target), margin, settings.power, F.col("held_back"))
        leaves = {row["leaf"]: row for row in stepped(sums, settings).collect()}  # at most 2^depth
        steps = [leaves[k]["step"] if k in leaves else 0.0 for k in range((forest.totalNumNodes + 1) // 2)]
        forests.append(forest)
        values.append([base + s for s in steps] if number == 1 else steps)
        totals = {k: sum(row[k] for row in leaves.values()) for k in ("fitted_deviance", "fitted_rows", "held_deviance", "held_rows")}
        own = totals["fitted_deviance"] / totals["fitted_rows"]
        held = totals["held_deviance"] / totals["held_rows"] if totals["held_rows"] else None
        deviances.append((own, held))
        watched = own if held is None else held
        if watched < best:
            best, best_round = watched, number
        if number - best_round >= settings.patience or forest.totalNumNodes == 1:
            break
        state = placed.withColumn(MARGIN, margin + F.element_at(F.lit(steps), F.col("_leaf") + 1)).select(state.columns)
        if number % settings.rounds_written == 0:
            state, old = materialise(state, "tweedie"), written
            written = state
            discard(old)
    discard(written)
    size = source.select(F.size(vector_to_array(features))).first()[0]
    estimator = GBTRegressor(
        featuresCol=features, labelCol=target, predictionCol=prediction, maxIter=settings.rounds, maxDepth=settings.depth,
        stepSize=settings.learning_rate, seed=settings.seed,
    )
    kept = fitted_trees(forests[:best_round], spark)
    trees = [(about, with_leaf_values(nodes, own)) for (about, nodes), own in zip(kept, values)]
    return Fitted(boosted_regression(spark, estimator, trees, size), deviances)
