"""The recurring jobs: train both models, score every account, rank the features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import attribution, models
from ledgerloom.operators.reasons import top_drivers
from ledgerloom.operators.splits import random_split, stratified_split
from ledgerloom.operators.tiers import at_risk, risk_tier
from ledgerloom.operators.value import with_twelve_month_value
from ledgerloom.plans.scoring import score_rows
from ledgerloom.schemas import LABEL
from ledgerloom.session import materialise


@dataclass(frozen=True)
class ChurnTraining:
    model: PipelineModel
    metadata: DataFrame
    tested: DataFrame
    leaves: Sequence[attribution.Leaf]


def train_churn(features: DataFrame, settings: models.ChurnSettings = models.ChurnSettings()) -> ChurnTraining:
    """Stratified hold-out, fit on the rest, metrics and threshold on the hold-out.

    Early stopping watches a third share of accounts, so the reported hold-out stays unseen.
    """
    split = materialise(stratified_split(features, LABEL), "split")
    model = models.fit_churn_model(split.where(~F.col("is_test")), settings)
    tested = models.churn_predictions(model, split.where("is_test"))
    leaves = attribution.read_leaves(features.sparkSession, model)
    return ChurnTraining(model, models.churn_metadata(model, tested), tested, leaves)


@dataclass(frozen=True)
class ValueTraining:
    model: PipelineModel
    tested: DataFrame


def train_value(features: DataFrame, noise_seed: int | None = None, fit=models.fit_tweedie_value_model) -> ValueTraining:
    """Random hold-out, fit on the rest; ``tested`` holds label and forecast of the hold-out.

    ``fit`` is ``models.fit_tweedie_value_model``, ``fit_value_model`` or ``fit_boosted_value_model``; the hold-out is the same.
    """
    split = materialise(random_split(with_twelve_month_value(features, noise_seed)), "valued")
    model = fit(split.where(~F.col("is_test")))
    tested = models.value_predictions(model, split.where("is_test"))
    return ValueTraining(model, tested.select("account_id", "value_12m", "predicted_value"))


def batch_scores(
    features: DataFrame,
    churn_model: PipelineModel,
    value_model: PipelineModel,
    threshold: float,
    scored_at: str,
    leaves: Sequence[attribution.Leaf] | None = None,
) -> DataFrame:
    """The serving rows of every account in ``features``.

    Both models, the tiers and the attribution of the at-risk accounts run in one pass without a shuffle.
    """
    valued = models.value_predictions(value_model, features)
    churn = models.churn_predictions(churn_model, valued)
    names = models.feature_names(churn)
    leaves = leaves if leaves is not None else attribution.read_leaves(features.sparkSession, churn_model)
    tier = risk_tier(F.col("churn_probability"), F.col("current_plan_id"), threshold)
    rows = churn.select("account_id", "current_plan_id", "churn_probability", "predicted_value", models.FEATURES)
    explained = attribution.with_contributions(rows, leaves, at_risk(tier))
    return score_rows(
        explained,
        F.col("churn_probability"),
        F.col("predicted_value"),
        top_drivers(F.col("contributions"), names),
        threshold,
        scored_at,
    )


def feature_ranking(
    features: DataFrame, churn_model: PipelineModel, leaves: Sequence[attribution.Leaf] | None = None
) -> DataFrame:
    """Mean absolute attribution per feature over a snapshot."""
    assembled = models.churn_predictions(churn_model, features)
    leaves = leaves if leaves is not None else attribution.read_leaves(features.sparkSession, churn_model)
    return attribution.global_attribution(assembled, leaves, models.feature_names(assembled))
