"""Boosted ensembles in Spark's saved form: keep the first rounds, put single trees together, measure every prefix.

Everything here is bounded by rounds x 2^depth tree nodes, and so is what the driver and the tasks hold of a model.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressionModel, GBTRegressor, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path

# Scores are told apart in this many steps where the area under ROC is taken for every prefix at once.
SCORE_STEPS = 2000
NODE_SCHEMA = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
    "gain: double, leftChild: int, rightChild: int, "
    "split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
TREE_SCHEMA = "_1 int, _2 string, _3 double"


def saved(model: Any, spark: SparkSession, name: str = "ensemble") -> str:
    """The folder of the saved form of a model or estimator."""
    path = scratch_path(spark, name)
    model.write().save(path)
    return path


def _notes(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/metadata").first()[0])


def _write(spark: SparkSession, notes: dict, trees: DataFrame, nodes: DataFrame) -> str:
    """A folder in the saved form of an ensemble."""
    path = scratch_path(spark, "ensemble")
    spark.createDataFrame([(json.dumps(notes),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    trees.write.parquet(f"{path}/treesMetadata")
    nodes.write.parquet(f"{path}/data")
    return path


def first_rounds(model: GBTClassificationModel, rounds: int, spark: SparkSession) -> GBTClassificationModel:
    """The same ensemble with its first rounds only."""
    if rounds >= model.getNumTrees:
        return model
    path = saved(model, spark)
    trees = spark.read.parquet(f"{path}/treesMetadata").where(F.col("_1") < rounds)
    nodes = spark.read.parquet(f"{path}/data").where(F.col("treeID") < rounds)
    return GBTClassificationModel.load(_write(spark, _notes(spark, path) | {"numTrees": rounds}, trees, nodes))


def fitted_trees(forests: Sequence[RandomForestRegressionModel], spark: SparkSession) -> list[tuple[str, list[dict]]]:
    """The notes and nodes of fitted forests of one tree each, in the order of their leaves' numbers.

    They are saved together: a save takes several small jobs, as long as fitting a tree of a small table.
    """
    own = [forest.trees[0]._java_obj for forest in forests]
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    array = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(own))
    weights = gateway.new_array(jvm.double, len(own))
    for k, tree in enumerate(own):
        array[k], weights[k] = tree, 1.0
    path = saved(GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel("trees", array, weights)), spark, "trees")
    notes = dict(spark.read.parquet(f"{path}/treesMetadata").select("_1", "_2").collect())
    rows = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/data").collect()
    found: list[tuple[str, list[dict]]] = [(notes[k], []) for k in range(len(own))]
    for row in rows:
        found[row.treeID][1].append(row.nodeData.asDict(recursive=True))
    return [(about, sorted(nodes, key=lambda node: node["id"])) for about, nodes in found]


def with_leaf_values(nodes: Sequence[dict], values: Sequence[float]) -> list[dict]:
    """The nodes with other values at the leaves; leaves are numbered in the order of their ids."""
    own = iter(values)
    return [node | {"prediction": next(own)} if node["leftChild"] < 0 else node for node in nodes]


def tree_notes(spark: SparkSession) -> str:
    """The notes of a regression tree that was not fitted."""
    notes = _notes(spark, saved(DecisionTreeRegressor(), spark, "tree"))
    return json.dumps(notes | {"class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel"})


def nested_nodes(shape: tuple, values: Sequence[float]) -> list[dict]:
    """The nodes of a known tree: (feature, cut, left, right) nested, None for a leaf; values from left to right."""
    nodes: list[dict] = []
    own = iter(values)

    def add(node: tuple | None) -> int:
        place = len(nodes)
        split = {"featureIndex": -1, "leftCategoriesOrThreshold": [], "numCategories": -1}
        found = {"id": place, "prediction": 0.0, "impurity": 0.0, "impurityStats": [1.0, 0.0, 0.0], "rawCount": 1, "gain": -1.0}
        nodes.append(found | {"leftChild": -1, "rightChild": -1, "split": split})
        if node is None:
            nodes[place]["prediction"] = next(own)
        else:
            feature, cut, left, right = node
            nodes[place] |= {"gain": 0.0, "split": split | {"featureIndex": feature, "leftCategoriesOrThreshold": [cut]}}
            nodes[place] |= {"leftChild": add(left), "rightChild": add(right)}
        return place

    add(shape)
    return nodes


def boosted_regression(
    spark: SparkSession, estimator: GBTRegressor, trees: Sequence[tuple[str, list[dict]]], features: int
) -> GBTRegressionModel:
    """Spark's boosted regression model whose prediction is the sum of the given trees; parameters come from the estimator."""
    notes = _notes(spark, saved(estimator, spark)) | {
        "class": "org.apache.spark.ml.regression.GBTRegressionModel",
        "numFeatures": features,
        "numTrees": len(trees),
    }
    listed = spark.createDataFrame([(k, about, 1.0) for k, (about, _) in enumerate(trees)], TREE_SCHEMA)
    nodes = spark.createDataFrame([(k, node) for k, (_, own) in enumerate(trees) for node in own], NODE_SCHEMA)
    return GBTRegressionModel.load(_write(spark, notes, listed, nodes))


def tree_tables(model: Any, spark: SparkSession) -> list[dict[str, list]]:
    """Each tree as columns over its nodes, its weight worked into the values.

    ``feature`` is -1 at a leaf; ``goes_left`` holds the categories of a categorical split, None for a cut.
    """
    path = saved(model, spark)
    weights = dict(spark.read.parquet(f"{path}/treesMetadata").select("_1", "_3").collect())
    rows = spark.read.schema(NODE_SCHEMA).parquet(f"{path}/data").orderBy("treeID", "nodeData.id").collect()
    tables: list[dict[str, list]] = [
        {name: [] for name in ("feature", "cut", "goes_left", "left", "right", "value")} for _ in weights
    ]
    for tree, node in rows:
        own, split = tables[tree], node.split
        listed = split.leftCategoriesOrThreshold
        by_cut = split.numCategories == -1
        own["feature"].append(split.featureIndex if node.leftChild >= 0 else -1)
        own["cut"].append(listed[0] if by_cut and listed else 0.0)
        own["goes_left"].append(None if by_cut else list(listed))
        own["left"].append(node.leftChild)
        own["right"].append(node.rightChild)
        own["value"].append(weights[tree] * node.prediction)
    return tables


def _tree_function():
    """The function that scores a block of rows by one tree; made inside a function, so it travels by value."""

    def tree_values(x, tree):
        node = np.zeros(len(x), np.int64)
        feature, left, right = (np.array(tree[name]) for name in ("feature", "left", "right"))
        cut, value = np.array(tree["cut"]), np.array(tree["value"])
        sets = {k: found for k, found in enumerate(tree["goes_left"]) if found is not None}
        open_rows = np.flatnonzero(feature[node] >= 0)
        while len(open_rows):
            at = node[open_rows]
            own = x[open_rows, feature[at]]
            go = own <= cut[at]
            for k, categories in sets.items():
                here = at == k
                go[here] = np.isin(own[here], categories)
            node[open_rows] = np.where(go, left[at], right[at])
            open_rows = open_rows[feature[node[open_rows]] >= 0]
        return value[node]

    return tree_values


def prefix_counts(rows: DataFrame, trees: Sequence[dict[str, list]], vector: str, label: str) -> DataFrame:
    """For every prefix of a classifier's trees and every score step: (round, step, n, positives, loss).

    One pass over the rows. A task keeps fixed tables of rounds x SCORE_STEPS sums and sends those that are not zero. ``loss`` is
    the summed logarithmic loss, where trees predict half the log-odds, as Spark's classifier does.
    """
    shared = rows.sparkSession.sparkContext.broadcast(list(trees))
    tree_values, steps = _tree_function(), SCORE_STEPS

    def fold(batches):
        sums = np.zeros((3, len(shared.value), steps + 1))
        for batch in batches:
            if not len(batch):
                continue
            x, y = np.stack(batch["x"].to_numpy()), batch["y"].to_numpy(dtype=float)
            margin = np.zeros(len(x))
            for k, tree in enumerate(shared.value):
                margin += tree_values(x, tree)
                loss = np.logaddexp(0.0, np.where(y > 0, -2.0, 2.0) * margin)
                step = np.floor(steps / (1.0 + np.exp(-2.0 * margin))).astype(np.int64)
                for table, weights in zip(sums, (None, y, loss)):
                    table[k] += np.bincount(step, weights, minlength=steps + 1)
        k, step = np.nonzero(sums[0])
        n, positives, loss = sums[:, k, step]
        yield pd.DataFrame(
            {"round": k + 1, "step": step, "n": n.astype(np.int64), "positives": positives.astype(np.int64), "loss": loss}
        )

    needed = rows.select(vector_to_array(vector).alias("x"), F.col(label).cast("double").alias("y"))
    partial = needed.mapInPandas(fold, "round int, step int, n long, positives long, loss double")
    return partial.groupBy("round", "step").agg(*(F.sum(c).alias(c) for c in ("n", "positives", "loss")))


def prefix_measures(counts: DataFrame) -> DataFrame:
    """Mean logarithmic loss and area under ROC of each prefix: (round, log_loss, roc_auc).

    Windows hold the score steps of one round, a fixed number.
    """
    down = Window.partitionBy("round").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Twice the pairs of a positive and a lower negative, ties as one half.
    pairs = (F.col("n") - F.col("positives")) * (2 * F.sum("positives").over(down) - F.col("positives"))
    positives, negatives = F.sum("positives").cast("double"), F.sum(F.col("n") - F.col("positives"))
    return (
        counts.withColumn("pairs", pairs.cast("double"))
        .groupBy("round")
        .agg(
            (F.sum("loss") / F.sum("n")).alias("log_loss"),
            F.when((positives > 0) & (negatives > 0), F.sum("pairs") / (2 * positives * negatives)).alias("roc_auc"),
        )
    )


def stopping_curve(measures: DataFrame, patience: int) -> DataFrame:
    """Adds to each round how many rounds ago either measure was best so far, and whether boosting has ended there.

    Returns (round, log_loss, roc_auc, best_loss_round, best_auc_round, stopped). A measure without a value is never best. The rows are
    the rounds of one model.
    """
    so_far = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def first_best(column: str, sign: int) -> Column:
        value = F.when(F.col(column).isNotNull(), F.struct((sign * F.col(column)).alias("v"), (-F.col("round")).alias("r")))
        return F.coalesce(-F.max(value).over(so_far)["r"], F.lit(0))

    found = measures.withColumns({"best_loss_round": first_best("log_loss", -1), "best_auc_round": first_best("roc_auc", 1)})
    # A measure that never has a value (one class only) cannot stop anything.
    late = lambda best: (F.col(best) > 0) & (F.col("round") - F.col(best) >= patience)
    return found.withColumn("stopped", late("best_auc_round") | late("best_loss_round"))


def best_round(curve: DataFrame, patience: int) -> tuple[int, bool]:
    """The round to keep, and whether patience has run out by the last one.

    At the first round where a measure has not improved for ``patience`` rounds, its best round counts (the area under ROC first). Without
    such a round it is the best one of the area under ROC, or of the loss if that has no value.
    """
    rows = curve.orderBy("round").collect()  # one a round
    for row in rows:
        if row.stopped:
            late = row.best_auc_round and row.round - row.best_auc_round >= patience
            return (row.best_auc_round if late else row.best_loss_round), True
    return (rows[-1].best_auc_round or rows[-1].best_loss_round), False
