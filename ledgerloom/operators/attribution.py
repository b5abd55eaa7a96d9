"""Exact additive attribution of a boosted-tree classifier's margin to its features.

Path-dependent Shapley values: a feature outside a coalition is averaged out by the share of training rows that
took each branch. Every leaf contributes on its own. On the path to a leaf, feature j either lets the row pass
(one) or not (zero), and would let a random row pass with probability r_j, the product of the row shares of its
branches. With d distinct features on the path, the leaf's share of feature i is

    leaf * (pass_i - r_i) * sum_k  k! (d-1-k)! / d!  *  e_k

where e_k sums, over the coalitions of k other features, pass inside the coalition times r outside it: the
coefficients of the polynomial  prod_{j != i} (r_j + pass_j t).
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.models import FEATURES, feature_names
from ledgerloom.session import scratch_path


@dataclass(frozen=True)
class Condition:
    """What the path to a leaf demands of one feature: a half-open interval, or a set of categories."""

    feature: int
    share: float
    low: float = -math.inf
    high: float = math.inf
    categories: frozenset[float] | None = None

    def met(self, value: float) -> bool:
        if self.categories is not None:
            return value in self.categories
        return self.low < value <= self.high


@dataclass(frozen=True)
class Leaf:
    value: float
    conditions: tuple[Condition, ...]


def read_leaves(spark: SparkSession, model: PipelineModel) -> list[Leaf]:
    """Leaves with their path conditions, from the saved form of the classifier (the pipeline's last stage).

    The result is bounded by rounds x 2^depth and is what the tasks receive. Read it once for each model.
    """
    path = scratch_path(spark, "trees")
    model.stages[-1].write().save(path)
    weights = dict(spark.read.parquet(f"{path}/treesMetadata").select("_1", "_3").collect())
    node_rows = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect()
    trees: dict[int, dict[int, object]] = defaultdict(dict)
    for row in node_rows:
        trees[row["treeID"]][row["id"]] = row
    leaves: list[Leaf] = []
    for tree, nodes in trees.items():
        _walk(nodes, 0, {}, weights[tree], leaves)
    return leaves


def _narrow(old: Condition | None, split, goes_left: bool, share: float) -> Condition:
    """The demand on a split's feature after one more branch."""
    feature = split["featureIndex"]
    old = old or Condition(feature, 1.0)
    listed = split["leftCategoriesOrThreshold"]
    if split["numCategories"] == -1:
        cut = listed[0]
        low, high = (old.low, min(old.high, cut)) if goes_left else (max(old.low, cut), old.high)
        return Condition(feature, old.share * share, low, high)
    left = frozenset(listed)
    every = frozenset(float(c) for c in range(split["numCategories"]))
    allowed = left if goes_left else every - left
    if old.categories is not None:
        allowed &= old.categories
    return Condition(feature, old.share * share, categories=allowed)


def _walk(nodes: dict, node: int, path: dict[int, Condition], weight: float, leaves: list[Leaf]) -> None:
    row = nodes[node]
    if row["leftChild"] < 0:
        leaves.append(Leaf(weight * row["prediction"], tuple(path.values())))
        return
    feature = row["split"]["featureIndex"]
    for child, goes_left in ((row["leftChild"], True), (row["rightChild"], False)):
        share = nodes[child]["rawCount"] / row["rawCount"]
        narrowed = _narrow(path.get(feature), row["split"], goes_left, share)
        _walk(nodes, child, path | {feature: narrowed}, weight, leaves)


def base_margin(leaves: Sequence[Leaf]) -> float:
    """The margin with every feature averaged out."""
    return sum(leaf.value * math.prod(c.share for c in leaf.conditions) for leaf in leaves)


def _plain_form(leaves: Sequence[Leaf]) -> list[tuple]:
    """Leaves as numbers and lists only: ([(feature, share, low, high, categories)], value).

    Tasks get this form, rounds x 2^depth leaves of at most ``depth`` conditions, so that executors need numpy and pandas
    but not this package.
    """
    return [
        (
            [(c.feature, c.share, c.low, c.high, None if c.categories is None else sorted(c.categories))
             for c in leaf.conditions],
            leaf.value,
        )
        for leaf in leaves
    ]


def _block_function():
    """The function that explains a block of rows; made inside a function, so it travels by value."""

    def pattern_values(passes, shares):
        """For patterns of met conditions (one row each) what every condition contributes to a leaf of value 1."""
        d = len(shares)
        orders = [math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)]
        values = np.empty_like(passes)
        for i in range(d):
            # coefficients[k]: sum over coalitions of k other features.
            coefficients = [np.ones(len(passes))]
            for j in range(d):
                if j != i:
                    stay = [c * shares[j] for c in coefficients] + [0.0]
                    join = [0.0] + [c * passes[:, j] for c in coefficients]
                    coefficients = [a + b for a, b in zip(stay, join)]
            values[:, i] = (passes[:, i] - shares[i]) * sum(w * c for w, c in zip(orders, coefficients))
        return values

    def block_values(x, plain):
        result = np.zeros_like(x, dtype=float)
        for conditions, value in plain:
            pattern = np.zeros(len(x), dtype=np.int64)
            for j, (feature, _, low, high, categories) in enumerate(conditions):
                values = x[:, feature]
                met = (values > low) & (values <= high) if categories is None else np.isin(values, categories)
                pattern |= met.astype(np.int64) << j
            # Only the patterns that occur in the block are worked out, so memory follows the block.
            kinds, place = np.unique(pattern, return_inverse=True)
            passes = ((kinds[:, None] >> np.arange(len(conditions))) & 1).astype(float)
            table = value * pattern_values(passes, [share for _, share, *_ in conditions])
            for (feature, *_), shares in zip(conditions, table.T):
                result[:, feature] += shares[place]
        return result

    return block_values


def shapley_values(x: np.ndarray, leaves: Sequence[Leaf]) -> np.ndarray:
    """Contributions of a block of rows: same shape as ``x``."""
    return _block_function()(x, _plain_form(leaves))


def _array(vector: str) -> Column:
    return vector_to_array(F.col(vector))


def with_contributions(
    assembled: DataFrame, leaves: Sequence[Leaf], wanted: Column | None = None, vector: str = FEATURES
) -> DataFrame:
    """Replace the vector by the array ``contributions`` (one entry per slot), NULL for rows not ``wanted``.

    A narrow step: rows stay where they are, and only wanted rows send their vector to Python.
    """
    values = _array(vector) if wanted is None else F.when(wanted, _array(vector))
    prepared = assembled.withColumn("contributions", values).drop(vector)
    shared = assembled.sparkSession.sparkContext.broadcast(_plain_form(leaves))
    block_values = _block_function()

    def explain(batches):
        for batch in batches:
            hit = batch["contributions"].notna()
            explained = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            if hit.any():
                block = block_values(np.stack(batch.loc[hit, "contributions"].to_numpy()), shared.value)
                explained.loc[hit] = pd.Series(list(block), index=batch.index[hit])
            yield batch.assign(contributions=explained)

    return prepared.mapInPandas(explain, prepared.schema)


def long_form(assembled: DataFrame, vector: str = FEATURES) -> DataFrame:
    """The assembled vector by slot name: (account_id, slot, value)."""
    labels = F.array(*map(F.lit, feature_names(assembled, vector)))
    slots = assembled.select("account_id", F.posexplode(_array(vector)).alias("at", "value"))
    return slots.select("account_id", F.element_at(labels, F.col("at") + 1).alias("slot"), "value")


def local_attribution(contributed: DataFrame, names: Sequence[str]) -> DataFrame:
    """Long form: (account_id, feature, contribution)."""
    labels = F.array(*map(F.lit, names))
    return contributed.select("account_id", F.posexplode("contributions").alias("at", "contribution")).select(
        "account_id", F.element_at(labels, F.col("at") + 1).alias("feature"), "contribution"
    )


def global_attribution(
    assembled: DataFrame, leaves: Sequence[Leaf], names: Sequence[str], vector: str = FEATURES
) -> DataFrame:
    """Mean absolute contribution per feature, largest first.

    Each batch is summed where it is computed, so a batch sends one number per feature into the shuffle.
    """
    shared = assembled.sparkSession.sparkContext.broadcast(_plain_form(leaves))
    labels = list(names)
    block_values = _block_function()

    def fold(batches):
        for batch in batches:
            if len(batch):
                block = np.abs(block_values(np.stack(batch["x"].to_numpy()), shared.value))
                yield pd.DataFrame({"feature": labels, "total": block.sum(axis=0), "n": len(batch)})

    sums = assembled.select(_array(vector).alias("x")).mapInPandas(fold, "feature string, total double, n long")
    return (
        sums.groupBy("feature")
        .agg((F.sum("total") / F.sum("n")).alias("mean_abs_contribution"))
        .orderBy(F.desc("mean_abs_contribution"), "feature")
    )
