from frames import accounts, by, day, subscriptions

from ledgerloom.functions.dates import months_crossed
from ledgerloom.plans import retention
from pyspark.sql import functions as F


def _data(spark):
    who = accounts(spark, [
        ("a", "2024-01-31", None, 1), ("b", "2024-01-05", None, 1), ("late", "2024-02-10", None, 1),
    ])
    subs = subscriptions(spark, [
        ("a", "2024-01", 100, "Paid"), ("a", "2024-02", 150, "Paid"), ("a", "2024-03", 10, "Failed"),
        ("b", "2024-01", 100, "Paid"), ("b", "2024-02", 0, "Paid"),
        ("late", "2024-03", 70, "Paid"),
    ])
    return who, subs


def test_month_boundaries_count(spark):
    row = spark.range(1).select(
        months_crossed(F.lit(day("2024-01-31")), F.lit(day("2024-02-01"))).alias("next"),
        months_crossed(F.lit(day("2023-11-01")), F.lit(day("2024-02-29"))).alias("over_year"),
        months_crossed(F.lit(day("2024-03-01")), F.lit(day("2024-01-31"))).alias("back"),
    ).first()
    assert tuple(row) == (1, 3, -2)


def test_paid_month_zero_is_the_base(spark):
    rows = by(retention.cohort_retention(*_data(spark)), "cohort_month", "month_number")
    assert set(rows) == {(day("2024-01-01"), 0), (day("2024-01-01"), 1)}  # February paid nothing in month 0
    base, later = rows[(day("2024-01-01"), 0)], rows[(day("2024-01-01"), 1)]
    assert (base.cohort_total_accounts, base.logo_retention_pct, base.net_revenue_retention_pct) == (2, 100, 100)
    assert (later.active_accounts, later.logo_retention_pct, later.net_revenue_retention_pct) == (1, 50, 75)


def test_logo_shares_are_of_all_signups(spark):
    rows = by(retention.cohort_logo_retention(*_data(spark)), "cohort_month", "month_idx")
    assert {k: r.retention_pct for k, r in rows.items()} == {
        ("2024-01-01", 0): 100.0, ("2024-01-01", 1): 50.0, ("2024-02-01", 1): 100.0,
    }
    wide = by(retention.cohort_retention_matrix(*_data(spark)), "cohort_month")
    assert (wide["2024-01-01"].month_0, wide["2024-01-01"].month_1, wide["2024-01-01"].month_2) == (100, 50, None)
    assert wide["2024-02-01"].month_0 is None


def test_months_after_the_limit_are_left_out(spark):
    who = accounts(spark, [("a", "2023-01-05", None, 1)])
    subs = subscriptions(spark, [("a", "2024-01", 5, "Paid"), ("a", "2024-02", 5, "Paid")])
    assert [r.month_idx for r in retention.cohort_logo_retention(who, subs).collect()] == [12]


def test_repeated_months_count_an_account_once(spark):
    who = accounts(spark, [("a", "2024-01-05", None, 1)])
    subs = subscriptions(spark, [("a", "2024-01", 5, "Paid"), ("a", "2024-01", 7, "Paid")])
    row = retention.cohort_retention(who, subs).first()
    assert (row.active_accounts, row.retained_mrr) == (1, 12)


def test_the_panel_is_shuffled_once(spark):
    """After the join by account, the fold per account and month needs no exchange of its own."""
    from frames import plan_of

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(retention.cohort_retention(*_data(spark))).split("== Physical Plan ==")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning(account_id") == 2  # the panel and the accounts
    assert plan.count("Exchange hashpartitioning(") == 4  # and the small cohort sums, twice
