import random

import numpy as np
import pytest

from ledgerloom.operators import threshold as t
from ledgerloom.operators.tiers import risk_tier
from pyspark.sql import functions as F

SCORED = "churn_probability double, churn_next_60d int, current_mrr double"


def _brute_force(rows, success=0.40, cost=350.0):
    curve = []
    for k in range(5, 91):
        cut = k / 100.0
        hit = [(y, m) for p, y, m in rows if p >= cut]
        tp = sum(y for y, _ in hit)
        net = sum(m * 12 * success for y, m in hit if y) - len(hit) * cost
        curve.append((cut, net, len(hit), tp, len(hit) - tp))
    return curve


@pytest.mark.parametrize("seed", [1, 2])
def test_one_pass_sweep_equals_the_loop(spark, seed):
    rng = random.Random(seed)
    exact = [k / 100.0 for k in range(0, 101)]  # scores on the grid itself, where rounding would bite
    near = [np.nextafter(k / 100.0, side) for k in range(5, 91) for side in (0.0, 1.0)]
    free = [rng.random() for _ in range(400)]
    rows = [(float(p), rng.randint(0, 1), rng.choice([99.0, 499.0, 1999.0])) for p in exact + near + free]
    found = t.threshold_curve(spark.createDataFrame(rows, SCORED)).collect()
    expected = _brute_force(rows)
    assert len(found) == 86
    for row, (cut, net, n, tp, fp) in zip(found, expected):
        assert (row.threshold, row.interventions_count, row.true_positives, row.false_positives) == (cut, n, tp, fp)
        assert row.net_savings_usd == pytest.approx(net, abs=0.006)
    best = max(expected, key=lambda e: (round(e[1], 6), -e[0]))
    assert t.optimal_threshold(spark.createDataFrame(rows, SCORED)).first().threshold == best[0]


def test_lowest_threshold_wins_a_tie(spark):
    scored = spark.createDataFrame([(0.70, 1, 1999.0)], SCORED)
    row = t.threshold_value_added(scored).first()
    assert row.optimal_threshold == 0.05
    assert row.max_net_savings_usd == row.default_0_5_savings_usd and row.value_added_usd == 0


def test_nobody_reaches_the_grid(spark):
    curve = t.threshold_curve(spark.createDataFrame([(0.01, 1, 99.0)], SCORED)).collect()
    assert len(curve) == 86 and all(r.interventions_count == 0 and r.net_savings_usd == 0 for r in curve)


def test_tier_rules_in_order(spark):
    cases = [(0.65, 1, "Critical"), (0.30, 3, "Critical"), (0.30, 1, "High"), (0.29, 3, "Medium"),
             (0.15, 1, "Medium"), (0.1499, 1, "Low")]
    df = spark.createDataFrame(cases, "p double, plan int, expected string")
    for row in df.withColumn("tier", risk_tier(F.col("p"), F.col("plan"), 0.30)).collect():
        assert row.tier == row.expected
    low_cut = df.select(risk_tier(F.col("p"), F.lit(1), 0.11).alias("tier"))
    assert {r.tier for r in low_cut.collect()} == {"Critical", "High"}  # Medium cannot be reached


def test_hard_prediction(spark):
    df = spark.createDataFrame([(0.5,), (0.49,)], "p double")
    assert [r[0] for r in df.select(t.hard_prediction(F.col("p"), 0.5)).collect()] == [1, 0]
