import itertools
import math

import numpy as np
import pytest

from ledgerloom.operators import attribution
from ledgerloom.operators.attribution import Condition, Leaf
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F


def _expectation(leaves, x, known):
    """Margin with the features outside ``known`` averaged out."""
    total = 0.0
    for leaf in leaves:
        part = leaf.value
        for c in leaf.conditions:
            part *= float(c.met(x[c.feature])) if c.feature in known else c.share
        total += part
    return total


def _shapley(leaves, x):
    n = len(x)
    result = np.zeros(n)
    for i in range(n):
        others = [j for j in range(n) if j != i]
        for size in range(n):
            weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
            for group in itertools.combinations(others, size):
                result[i] += weight * (_expectation(leaves, x, {*group, i}) - _expectation(leaves, x, set(group)))
    return result


def test_closed_form_equals_the_definition():
    # x0 <= 1 ? (x1 <= 5 ? 1 : 2) : (x0 <= 3 ? 4 : (x2 in {1} ? 8 : 16))
    leaves = [
        Leaf(1.0, (Condition(0, 0.6, high=1.0), Condition(1, 0.5, high=5.0))),
        Leaf(2.0, (Condition(0, 0.6, high=1.0), Condition(1, 0.5, low=5.0))),
        Leaf(4.0, (Condition(0, 0.4 * 0.25, low=1.0, high=3.0),)),
        Leaf(8.0, (Condition(0, 0.4 * 0.75, low=3.0), Condition(2, 0.2, categories=frozenset({1.0})))),
        Leaf(16.0, (Condition(0, 0.4 * 0.75, low=3.0), Condition(2, 0.8, categories=frozenset({0.0})))),
    ]
    rows = np.array([[0.0, 4.0, 1.0], [1.0, 6.0, 0.0], [2.0, 5.0, 1.0], [9.0, 0.0, 0.0], [3.5, 7.0, 1.0]])
    found = attribution.shapley_values(rows, leaves)
    for row, values in zip(rows, found):
        assert values == pytest.approx(_shapley(leaves, row), abs=1e-12)
        assert values.sum() + attribution.base_margin(leaves) == pytest.approx(
            _expectation(leaves, row, {0, 1, 2}), abs=1e-12)


def test_deep_paths_need_no_pattern_table():
    rng = np.random.default_rng(0)
    leaves = [
        Leaf(float(rng.normal()), tuple(Condition(j, float(rng.uniform(0.1, 0.9)), high=float(rng.uniform(-1, 1))) for j in range(10)))
        for _ in range(3)
    ]
    rows = rng.uniform(-1, 1, (4, 10))
    for row, values in zip(rows, attribution.shapley_values(rows, leaves)):
        assert values == pytest.approx(_shapley(leaves, row), abs=1e-12)
    sent = attribution._plain_form(leaves)
    assert sum(len(conditions) + 1 for conditions, _ in sent) == 3 * 11


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("account_id"),
        (F.rand(1) * 10).alias("a"), (F.rand(2) * 10).alias("b"), F.concat(F.lit("c"), F.col("id") % 3).alias("c"),
    ).withColumn("y", ((F.col("a") > 7) | ((F.col("b") < 3) & (F.col("c") == "c1"))).cast("double"))
    stages = []
    rows = df
    for stage in (
        StringIndexer(inputCol="c", outputCol="ci", stringOrderType="alphabetDesc"),
        OneHotEncoder(inputCols=["ci"], outputCols=["cv"]),
        VectorAssembler(inputCols=["a", "b", "cv"], outputCol="features"),
    ):
        stages.append(stage.fit(rows) if hasattr(stage, "fit") else stage)
        rows = stages[-1].transform(rows)
    gbt = GBTClassifier(featuresCol="features", labelCol="y", maxIter=4, maxDepth=3, stepSize=0.3, seed=3).fit(rows)
    return PipelineModel(stages=[*stages, gbt]), rows


def test_contributions_add_up_to_the_models_margin(spark, fitted):
    model, rows = fitted
    leaves = attribution.read_leaves(spark, model)
    scored = model.stages[-1].transform(rows).select(
        "account_id", vector_to_array("rawPrediction")[1].alias("margin"), "features")
    base = attribution.base_margin(leaves)
    found = attribution.with_contributions(scored, leaves).collect()
    assert len(found) == 500 and any(c.categories is not None for leaf in leaves for c in leaf.conditions)
    vectors = {r.account_id: r.x for r in rows.select("account_id", vector_to_array("features").alias("x")).collect()}
    for at, r in enumerate(found):
        assert base + sum(r.contributions) == pytest.approx(r.margin, abs=1e-9)
        if at < 10:
            assert list(r.contributions) == pytest.approx(list(_shapley(leaves, np.array(vectors[r.account_id]))), abs=1e-9)


def test_only_wanted_rows_are_explained(spark, fitted):
    model, rows = fitted
    leaves = attribution.read_leaves(spark, model)
    some = attribution.with_contributions(rows.select("account_id", "a", "features"), leaves, F.col("a") > 7)
    counts = some.groupBy((F.col("a") > 7).alias("hot"), F.col("contributions").isNull().alias("none")).count()
    assert {(r.hot, r.none) for r in counts.collect()} == {(True, False), (False, True)}
    assert some.count() == 500


def test_global_ranking_is_the_mean_of_the_local_values(spark, fitted):
    model, rows = fitted
    leaves = attribution.read_leaves(spark, model)
    names = ["a", "b", "c2", "c1"]
    local = attribution.local_attribution(
        attribution.with_contributions(rows.select("account_id", "features"), leaves), names)
    means = {r.feature: r.m for r in local.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("m")).collect()}
    ranking = attribution.global_attribution(rows, leaves, names).collect()
    assert {r.feature: r.mean_abs_contribution for r in ranking} == pytest.approx(means)
    assert ranking[0].feature == "a"
    values = [r.mean_abs_contribution for r in ranking]
    assert values == sorted(values, reverse=True)


def test_tasks_do_not_need_the_package(tmp_path):
    """Executors have numpy and pandas; the package lives on the driver only, away from their path."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent
    script = tmp_path / "away.py"
    script.write_text(f"""
import sys
sys.path.insert(0, {str(repo)!r})
from ledgerloom.session import build_session
from ledgerloom.operators.attribution import Condition, Leaf, global_attribution, with_contributions
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F
spark = build_session("away", "local[2]", **{{"spark.ui.enabled": "false"}})
rows = spark.range(100).select(F.col("id").alias("account_id"), array_to_vector(F.array(F.rand(1), F.rand(2))).alias("features"))
leaves = [Leaf(1.0, (Condition(0, 0.5, high=0.5), Condition(1, 0.5, high=0.5)))]
assert with_contributions(rows, leaves).count() == 100
assert global_attribution(rows, leaves, ["a", "b"]).count() == 2
print("explained")
""")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "explained" in done.stdout, done.stderr[-2000:]
