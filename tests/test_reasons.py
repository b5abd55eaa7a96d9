from ledgerloom.operators.reasons import DEFAULT_ACTION, reason_codes, top_drivers
from pyspark.sql import functions as F

NAMES = ["balance_decay_pct", "tenure_days", "current_mrr", "logins_30d"]


def _explained(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c array<double>")
    df = df.withColumn("drivers", top_drivers(F.col("c"), NAMES))
    return df.select("drivers", *(c.alias(n) for n, c in reason_codes(F.col("drivers")).items())).collect()


def test_largest_positive_contributions_name_the_reasons(spark):
    row, = _explained(spark, [[0.1, 0.5, -0.9, 0.3]])
    assert row.drivers == ["tenure_days", "logins_30d", "balance_decay_pct"]
    assert row.primary_churn_driver == "Elevated tenure_days"
    assert row.secondary_churn_driver == "Fluctuations in logins_30d"
    assert row.recommended_action == DEFAULT_ACTION


def test_dictionary_texts(spark):
    row, = _explained(spark, [[0.2, -1.0, 0.1, -1.0]])
    assert row.primary_churn_driver == "Significant Cash Flow / Balance Depletion"
    assert row.secondary_churn_driver == "High Plan Tier Exposure"
    assert row.recommended_action.startswith("Schedule financial check-in")


def test_fallbacks_and_ties(spark):
    none, one, tie = _explained(spark, [[-0.1, 0.0, -0.2, -0.3], [0.0, 0.0, 0.0, 0.4], [0.3, 0.3, 0.3, 0.3]])
    assert none.drivers == []
    assert none.primary_churn_driver == "Elevated general_behavior"
    assert none.secondary_churn_driver == "Fluctuations in stable_metrics"
    assert none.recommended_action == DEFAULT_ACTION
    assert one.secondary_churn_driver == "Fluctuations in stable_metrics"
    assert tie.drivers == NAMES[:3]
