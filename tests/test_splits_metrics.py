import random
import statistics

import pytest

from ledgerloom.operators import metrics, splits
from ledgerloom.operators.value import with_twelve_month_value
from pyspark.sql import functions as F


def _accounts(spark, n, positive_every=10):
    return spark.range(n).select(
        F.concat(F.lit("ACC-"), F.col("id")).alias("account_id"),
        (F.col("id") % positive_every == 0).cast("int").alias("y"),
    )


def test_split_repeats_and_has_its_share(spark):
    df = _accounts(spark, 8000)
    first = {r.account_id: r.is_test for r in splits.random_split(df).collect()}
    again = {r.account_id: r.is_test for r in splits.random_split(df.repartition(7)).collect()}
    assert first == again
    assert 0.23 < sum(first.values()) / len(first) < 0.27
    other = {r.account_id: r.is_test for r in splits.random_split(df, seed=7).collect()}
    assert other != first


def test_stratified_split_gives_each_class_its_share(spark):
    split = splits.stratified_split(_accounts(spark, 4000, 40), "y")
    shares = {r.y: r.s for r in split.groupBy("y").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()}
    assert shares[0] == pytest.approx(0.25, abs=0.002) and shares[1] == pytest.approx(0.25, abs=0.011)
    assert split.count() == 4000


def test_label_stats(spark):
    df = spark.createDataFrame([(True, 1), (True, 0), (True, 0), (False, 0)], "is_test boolean, y int")
    rows = {r.is_test: r for r in splits.label_stats(df, "y").collect()}
    assert rows[True].positive_weight == 2.0 and rows[True].churn_rate == pytest.approx(1 / 3)
    assert rows[False].positive_weight == 1.0


@pytest.mark.parametrize("n", [1, 2, 9, 500, 501])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [rng.choice([rng.randint(0, 3), rng.randint(-10**7, 10**10)]) for _ in range(n)]
    rows = [(True, v) for v in values] + [(False, 5)] * 3 + [(False, None), (None, 1)]
    df = spark.createDataFrame(rows, "g boolean, v long")
    found = {r.g: r.median for r in splits.exact_median(df, "g", "v").collect()}
    assert found == {True: statistics.median(values), False: 5}


def _auc(rows):
    pairs = [(p, q) for p, y in rows if y for q, z in rows if not z]
    return sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in pairs) / len(pairs)


def _pr_auc(rows):
    points = [(0.0, 1.0)]
    positives = sum(y for _, y in rows)
    for cut in sorted({p for p, _ in rows}, reverse=True):
        hit = [y for p, y in rows if p >= cut]
        points.append((sum(hit) / positives, sum(hit) / len(hit)))
    return sum((r1 - r0) * (p1 + p0) / 2 for (r0, p0), (r1, p1) in zip(points, points[1:]))


def test_classification_metrics_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(300)]
    df = spark.createDataFrame(rows, "p double, y int")
    found = metrics.classification_metrics(df, "y", "p").first()
    assert found.roc_auc == pytest.approx(_auc(rows), abs=1e-6)
    assert found.pr_auc == pytest.approx(_pr_auc(rows), abs=1e-6)
    assert found.brier_score == pytest.approx(statistics.fmean((p - y) ** 2 for p, y in rows), abs=1e-6)


def test_one_class_has_no_auc(spark):
    found = metrics.classification_metrics(spark.createDataFrame([(0.2, 0), (0.4, 0)], "p double, y int"), "y", "p").first()
    assert found.roc_auc is None and found.pr_auc is None and found.brier_score == pytest.approx(0.1)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "y double, f double")
    found = metrics.regression_metrics(df, "y", "f").first()
    assert (found.mae, found.rmse, found.r2) == (0.6667, 0.8165, 0.75)
    flat = metrics.regression_metrics(spark.createDataFrame([(1.0, 2.0)], "y double, f double"), "y", "f").first()
    assert flat.r2 is None


def test_value_label(spark):
    rows = [("a", 99.0, 1000.0, 0.019, 5.0), ("b", 499.0, 100.0, 0.015, 0.0), ("c", 1.0, 0.0, 0.011, 1.0)]
    df = spark.createDataFrame(
        rows, "account_id string, current_mrr double, tx_volume_90d double, take_rate_pct double, "
        "tx_volume_velocity_ratio double")
    found = {r.account_id: r.value_12m for r in with_twelve_month_value(df).collect()}
    assert found == {"a": 99 * 12 + 1000 * 4 * 2.5 * 0.019, "b": 499 * 12 + 0.6, "c": 100.0}
    noisy = with_twelve_month_value(df, noise_seed=1)
    assert noisy.collect() == with_twelve_month_value(df.repartition(3), noise_seed=1).orderBy("account_id").collect()
    big = spark.range(4000).select(
        F.col("id").cast("string").alias("account_id"), F.lit(1000.0).alias("current_mrr"),
        F.lit(0.0).alias("tx_volume_90d"), F.lit(0.01).alias("take_rate_pct"), F.lit(1.0).alias("tx_volume_velocity_ratio"))
    stats = with_twelve_month_value(big, noise_seed=5).agg(F.avg("value_12m").alias("m"), F.stddev("value_12m").alias("s")).first()
    assert stats.m / 12000 == pytest.approx(1.0, abs=0.01) and stats.s / 12000 == pytest.approx(0.08, abs=0.006)


def test_classification_metrics_of_scores_that_differ_late(spark):
    """Scores that four decimals would tie, cut into several ranges."""
    import random

    rng = random.Random(4)
    rows = [(0.5 + rng.randrange(4000) / 1e8, int(rng.random() < 0.3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "p double, y int").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = metrics.classification_metrics(df, "y", "p").first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    positives = sorted(p for p, y in rows if y)
    negatives = sorted(p for p, y in rows if not y)
    from bisect import bisect_left, bisect_right

    wins = sum(bisect_left(negatives, p) + (bisect_right(negatives, p) - bisect_left(negatives, p)) / 2 for p in positives)
    assert found.roc_auc == round(wins / (len(positives) * len(negatives)), 6)


@pytest.mark.parametrize("values", [
    [1.5, -2.25, 1e300, -1e300, 0.0, -0.0, 5e-324, 3.0],
    [float("inf"), 1.0, 2.0], [-1.0], [-3.5, -3.5, 7.0, 7.0], [1.0 + k * 2**-52 for k in range(11)],
    [2**63 - 1, -(2**63), 5], [2**63 - 1, -(2**63), 2**62, -(2**62), 0, 1], [-5, -4, -3, -3], [10**15 + k for k in range(7)],
])
def test_exact_median_of_any_numbers(spark, values):
    kind = "double" if isinstance(values[0], float) else "long"
    rows = [(True, v) for v in values] + [(False, values[0]), (None, values[0]), (True, None)]
    df = spark.createDataFrame(rows, f"g boolean, v {kind}").repartition(3)
    found = {r.g: r["median"] for r in splits.exact_median(df, "g", "v").collect()}
    assert found == {True: float(statistics.median(values)), False: float(values[0])}


def test_median_windows_stay_small(spark, monkeypatch):
    """Of 200,000 spread values no window sees more than one row for each value of 16 bits."""
    df = spark.range(200_000).selectExpr("id % 2 = 0 AS g", "xxhash64(id) AS v")
    found = {r.g: r["median"] for r in splits.exact_median(df, "g", "v").collect()}
    for g in (True, False):
        values = sorted(r.v for r in df.where(f"g = {g}").select("v").collect())
        assert found[g] == (values[49_999] + values[50_000]) / 2
    assert splits.exact_median(df.limit(0), "g", "v").count() == 0


def test_bootstrap_repeats_itself_and_covers_the_rate(spark):
    from ledgerloom.plans import reporting

    accounts = spark.range(4000).selectExpr("concat('ACC-', id) AS account_id", "int(id % 5 = 0) AS is_churned", "concat('s', id % 2) AS size",
                                            "if(id % 100 = 0, NULL, 'x') AS land")
    build = lambda parts: sorted(map(tuple, reporting.bootstrap_churn_rate(accounts.repartition(parts), "size", "land").collect()), key=repr)
    first = build(2)
    assert first == build(7) and len(first) == 4
    for _, value, n, rate, low, high in first:
        assert low <= rate <= high
        if n > 1000:
            half = 1.96 * (rate * (1 - rate) / n) ** 0.5
            assert abs(low - (rate - half)) < 0.3 * half and abs(high - (rate + half)) < 0.3 * half


def test_rows_alike_are_held_back_together(spark):
    """Copies follow the smallest key, also where a column is null; rows without copies lie where their own key puts them."""
    rows = [(f"K{k:03d}", k // 3 if k < 90 else k, None if k % 2 == 0 and k >= 90 else 0.5) for k in range(300)]
    df = spark.createDataFrame(rows, "account_id string, x int, y double")
    side = {r.account_id: r.held_back for r in splits.with_held_back(df, ["x", "y"], 0.3, 43).collect()}
    own = {r.account_id: r.b < 3000 for r in df.select("account_id", splits.hash_bucket(F.col("account_id"), 43).alias("b")).collect()}
    assert side == {key: own[f"K{x * 3:03d}" if x < 30 else key] for key, x, _ in rows}
    assert len({side[key] for key, *_ in rows[:90]}) == 2 and side != own
    assert splits.with_held_back(df, ["x"], 0.0, 43).where("held_back").isEmpty()


def test_one_large_group_of_copies_is_folded_before_the_shuffle(spark):
    df = spark.range(1000).select(F.concat(F.lit("K"), "id").alias("account_id"), F.floor(F.col("id") / 1000).alias("x"))
    placed = splits.with_held_back(df, ["x"], 0.3, 43)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Window" not in plan
    assert placed.select("held_back").distinct().count() == 1 and placed.count() == 1000
